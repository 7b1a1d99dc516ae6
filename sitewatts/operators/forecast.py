"""Per-site daily-kWh forecast (UDF3 fit, UDF4 score), D13.

Model per site: ordinary least squares trend of daily kWh on the day index
(days since the site's first date) plus the mean residual of each ISO
weekday. A site with fewer than 2 days forecasts its mean. Days whose total is NaN,
infinite or from 1e12 kWh on are left out of the fit.

Models are registered by name: ``save_model`` writes one Parquet folder per version, with
the window of days it was fitted on and its formula, and never changes it again;
``load_model`` reads the last or a given version, from any session.

Fit is one ``groupBy("site_id")``: the sufficient statistics (n, Σx, Σy,
Σxy, Σx², and per-weekday n, Σx, Σy) are whole numbers in decimals of 38
digits, so the fit is exact up to the final divisions, independent of row order
and safe for totals of any size. All models live in
one table, one row per site. Scoring explodes the horizon per model row: no
join, no shuffle.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewatts.functions.exact import MOST_KWH

WEEKDAYS = range(1, 8)  # ISO: 1 = Monday ... 7 = Sunday


def iso_weekday(day_number: Column) -> Column:
    """ISO weekday from days since 1970-01-01 (a Thursday)."""
    return F.pmod(day_number + F.lit(3), F.lit(7)) + F.lit(1)


def fit_forecast(gold: DataFrame) -> DataFrame:
    """One model row per site (UDF3).

    Columns: site_id, first_date, last_date, n_days, slope_kwh_per_day,
    intercept_kwh (at first_date), weekday_resid_kwh (array of 7, Monday first;
    0.0 for weekdays the site never had).
    """
    day = "CAST(unix_date(reading_date) AS DECIMAL(10,0))"
    dow = "(pmod(unix_date(reading_date) + 3, 7) + 1)"
    y = "CAST(floor(total_kwh * 100 + 0.5) AS DECIMAL(20,0))"  # exact cents of the 2-dp total
    aggs = [
        f"count({y}) AS n",
        "min(reading_date) AS first_date",
        "max(reading_date) AS last_date",
        f"sum({day}) AS sx",
        f"sum({y}) AS sy",
        f"sum({day} * {y}) AS sxy",
        f"sum({day} * {day}) AS sxx",
    ]
    for d in WEEKDAYS:
        aggs += [
            f"count_if({dow} = {d}) AS n{d}",
            f"sum(CASE WHEN {dow} = {d} THEN {day} END) AS sx{d}",
            f"sum(CASE WHEN {dow} = {d} THEN {y} END) AS sy{d}",
        ]
    stats = gold.filter(f"abs(total_kwh) < {MOST_KWH!r}D").groupBy("site_id").agg(*[F.expr(a) for a in aggs])
    # x = days since the site's first date, shifted exactly in integers
    rel = stats.selectExpr(
        "*",
        "CAST(unix_date(first_date) AS DECIMAL(10,0)) AS f",
    ).selectExpr("*", "sx - n * f AS rx", "sxx - 2 * f * sx + n * f * f AS rxx", "sxy - f * sy AS rxy")
    fitted = rel.selectExpr(
        "*",
        "CASE WHEN n >= 2 AND n * rxx - rx * rx <> 0 "
        "THEN CAST(n * rxy - rx * sy AS DOUBLE) / CAST(n * rxx - rx * rx AS DOUBLE) ELSE 0.0D END AS slope_c",
    ).selectExpr("*", "(CAST(sy AS DOUBLE) - slope_c * CAST(rx AS DOUBLE)) / CAST(n AS DOUBLE) AS intercept_c")
    resid = [
        f"CASE WHEN n{d} > 0 THEN ((CAST(sy{d} AS DOUBLE) - intercept_c * CAST(n{d} AS DOUBLE)) "
        f"- slope_c * CAST(sx{d} - n{d} * f AS DOUBLE)) / CAST(n{d} AS DOUBLE) / 100.0D ELSE 0.0D END"
        for d in WEEKDAYS
    ]
    return fitted.selectExpr(
        "site_id",
        "first_date",
        "last_date",
        "n AS n_days",
        "slope_c / 100.0D AS slope_kwh_per_day",
        "intercept_c / 100.0D AS intercept_kwh",
        f"array({', '.join(resid)}) AS weekday_resid_kwh",
    )


def model_rows(model: DataFrame) -> DataFrame:
    """The model table flattened to one row per (site, ISO weekday)."""
    return model.select(
        "site_id",
        "n_days",
        "slope_kwh_per_day",
        "intercept_kwh",
        F.posexplode("weekday_resid_kwh").alias("pos", "weekday_resid_kwh"),
    ).select(
        "site_id",
        (F.col("pos") + 1).alias("iso_weekday"),
        "n_days",
        "slope_kwh_per_day",
        "intercept_kwh",
        "weekday_resid_kwh",
    )


def forecast(model: DataFrame, horizon_days: int, site_ids: list[str] | None = None) -> DataFrame:
    """Forecast the ``horizon_days`` dates after each site's last date (UDF4).

    ``site_ids`` restricts to the requested sites (the serving call takes
    one site and a horizon); default is every site in the model.
    """
    m = model if site_ids is None else model.filter(F.col("site_id").isin(site_ids))
    steps = m.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon_days))))
    target = F.date_add(F.col("last_date"), F.col("h"))
    x = (F.unix_date(target) - F.unix_date(F.col("first_date"))).cast("double")
    dow = iso_weekday(F.unix_date(target).cast("long"))
    value = (
        F.col("intercept_kwh") + F.col("slope_kwh_per_day") * x
    ) + F.element_at(F.col("weekday_resid_kwh"), dow.cast("int"))
    return steps.select(
        "site_id",
        F.col("h").alias("horizon_day"),
        target.alias("forecast_date"),
        value.alias("forecast_kwh"),
    )


FORMULA = (
    "forecast_kwh(date) = intercept_kwh + slope_kwh_per_day * (date - first_date) + weekday_resid_kwh[ISO weekday of date]"
)
_SCHEMA = (
    "site_id string, first_date date, last_date date, n_days bigint, slope_kwh_per_day double, intercept_kwh double, "
    "weekday_resid_kwh array<double>, formula string, version int"
)


def save_model(model: DataFrame, root: str, name: str, note: str = FORMULA) -> int:
    """Register a fitted model as the next version of ``name`` below ``root`` (shared storage); returns the version.

    One row per site; its first and last day say what it was fitted on. A version is never
    overwritten: of two writers of one version the second fails.
    """
    spark = model.sparkSession
    known = model_versions(spark, root, name)
    version = 1 + (known.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0] if known is not None else 0)
    kept = f"{root.rstrip('/')}/{name}/version={version}"
    model.withColumn("formula", F.lit(note)).write.mode("errorifexists").parquet(kept)
    return version


def _stored(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    try:
        return spark.read.schema(_SCHEMA).parquet(f"{root.rstrip('/')}/{name}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def model_versions(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """Per version: its sites, the first and last day it was fitted on and its formula; None if there is no such model."""
    rows = _stored(spark, root, name)
    if rows is None:
        return None
    return rows.groupBy("version").agg(
        F.count("site_id").alias("n_sites"), F.min("first_date").alias("fit_from"), F.max("last_date").alias("fit_to"),
        F.first("formula").alias("formula"),
    )


def load_model(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """The model rows of a version (default: the last), ready for ``forecast``."""
    known = model_versions(spark, root, name)
    there = [] if known is None else sorted(r["version"] for r in known.select("version").collect())
    chosen = version if version is not None else (there[-1] if there else None)
    if chosen not in there:
        raise ValueError(f"no version {version or 1} of model {name!r}; there are: {there}")
    return _stored(spark, root, name).where(F.col("version") == chosen).drop("version", "formula")
