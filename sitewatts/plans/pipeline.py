"""Silver and gold (CMP1, CMP2): AGG1, WIN1-WIN4, PRJ2.

Two ways to the same gold table:

* ``gold(silver)``: the reference shape, a 7-key roll-up of the enriched
  silver rows. Use it on a materialised silver table.
* ``build_gold(readings, sites, regions, business_units)``: the plan for
  large data. The raw readings are cleaned and rolled up by (site_id, date)
  first (partial aggregation on the map side shrinks the shuffle ~96x), the
  dimensions are joined to the small daily table, and the per-site window
  reuses the join's site_id partitioning. Equal to ``gold(silver(...))``
  whenever dimension keys are unique (see ``quality.dimension_guard``).

Exact arithmetic: kWh is summed as whole units and billionths (exact for values of
up to nine decimals) and rounded once, to two decimals (half up). The per-site baseline is
computed from n, S = sum of cents and Q = sum of cents^2. Mean and sigma are then one
correctly rounded double operation away from exact integers, the deviation is an exact
half-up rounding, and the 2-sigma test is decided in integers:

    total > mean + 2*sigma  <=>  (n*t - S) > 0 and (n*t - S)^2 > 4*(n*Q - S^2)

so a flat site never flags on float noise (T19) and the result does not
depend on row order or partitioning.

Bad readings stop nothing. NaN and infinite readings pass the rules as they do any
comparison in SQL, and make the day's total NaN or infinite; the site's mean is then what
adding them up gives, its sigma NaN, its deviations NaN, and no day of it is
flagged. Readings from 2^31 kWh on are added as doubles. A site with a daily total from
1e12 kWh on counts in a power of two instead of cents, chosen so that its largest
total has 46 bits: the test stays one of integers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewatts import schemas
from sitewatts.functions.columns import utc_date
from sitewatts.functions.exact import MOST_KWH, cents_sql, near_sql, parts
from sitewatts.operators import filters, joins, quality

ANOMALY_SIGMAS = 2


def with_reading_date(df: DataFrame) -> DataFrame:
    """``reading_date`` = UTC date of ``reading_timestamp`` (PRJ4, T2)."""
    return df.withColumn("reading_date", utc_date("reading_timestamp"))


def clean_readings(readings: DataFrame) -> DataFrame:
    """FLT1 then DQ1: error rows and negative / NULL kWh go."""
    cleaned = filters.drop_errors(readings)
    rules = quality.silver_rules()
    return quality.apply_rules(cleaned, rules)


def silver(readings: DataFrame, sites: DataFrame, regions: DataFrame, business_units: DataFrame) -> DataFrame:
    """Cleaned, enriched readings, 16 columns (CMP1)."""
    dim = joins.site_dim(sites, regions, business_units)
    enriched = joins.enrich(clean_readings(readings), dim)
    return with_reading_date(enriched).select(*schemas.SILVER_COLUMNS)


def silver_unchecked(readings: DataFrame, sites: DataFrame, regions: DataFrame, business_units: DataFrame) -> DataFrame:
    """Silver before the expectations: the rows DQ3 measures."""
    dim = joins.site_dim(sites, regions, business_units)
    return with_reading_date(joins.enrich(filters.drop_errors(readings), dim))


def clean_condition() -> Column:
    """What ``clean_readings`` keeps, as one condition."""
    kept = filters.not_error()
    for cond, action in quality.silver_rules().values():
        kept = kept & cond if action == "drop" else kept
    return kept


def daily_aggs(warning: str = "status = 'warning'") -> list[Column]:
    """AGG1a-d. kWh is summed exactly (see module doc)."""
    return [
        *parts("kwh_consumed", "total"),
        F.expr("round(max(kw_demand), 2) AS peak_kw"),
        F.expr("round(avg(voltage), 2) AS avg_voltage"),
        F.expr(f"sum(CASE WHEN {warning} THEN 1 ELSE 0 END) AS warning_count"),
    ]


def with_total(df: DataFrame) -> DataFrame:
    """total_kwh from the exact sums, rounded half up once, and total_cents (null from 1e12 kWh on)."""
    near = near_sql("total")
    kwh = (
        f"CASE WHEN total_far IS NULL THEN CAST(round({near}, 2) AS DOUBLE) "
        f"ELSE round(total_far + CAST({near} AS DOUBLE), 2) END"
    )
    return df.selectExpr("*", f"{kwh} AS total_kwh").selectExpr("*", f"{cents_sql('total_kwh')} AS total_cents").drop(
        "total_whole", "total_nano", "total_far"
    )


def daily(silver_df: DataFrame) -> DataFrame:
    """AGG1: the 7-key daily roll-up of silver (AGG1a-d), with total_cents.

    Silver that isn't written yet is a join on site_id, whose partitioning an
    aggregate on site_id would take over: all rows of a hot site in one task. The
    site key is therefore grouped by as an expression, so partial sums are made
    where the join's rows are (its hot partitions can be split) and only they are
    shuffled.
    """
    keys = [F.concat("site_id", F.lit("")).alias("_site"), *schemas.GOLD_ATTRIBUTES, "reading_date"]
    rolled = silver_df.groupBy(*keys).agg(*daily_aggs())
    return with_total(rolled.withColumnRenamed("_site", "site_id"))


def with_baseline(df: DataFrame, sigmas: int = ANOMALY_SIGMAS) -> DataFrame:
    """WIN1-WIN4 over ``Window.partitionBy("site_id")``, from ``total_kwh`` and ``total_cents``.

    Adds site_mean_kwh (WIN1), site_stddev_kwh (population, WIN2),
    anomaly_flag (strict, never NULL, WIN3) and deviation_pct (1 dp, NULL when
    the mean is 0, WIN4). Mean and sigma cover the whole site partition,
    current day included (T10). A site's largest total decides its unit, which its sums are
    counted in: two windows that share one sort of the daily rows per site.
    """
    w = "OVER (PARTITION BY site_id)"
    scaled = _counted(df.selectExpr("*", f"max(abs(total_kwh)) {w} AS _most", f"sum({_ODD}) {w} AS _odd"))
    return with_measures(scaled.selectExpr("*", *[f"{e} {w} AS {c}" for c, e in _STATE.items()]), sigmas).drop("_most", "_odd")


#: 0 for a finite total, else the total: its sum is 0 unless a total isn't finite.
_ODD = "CASE WHEN abs(total_kwh) < double('Infinity') THEN 0D ELSE total_kwh END"
#: A site's count, sum and sum of squares of its days' totals in its unit.
_STATE = {"_n": "count(_t)", "_s": "sum(_t)", "_q": "sum(CAST(_t AS DECIMAL(38,0)) * CAST(_t AS DECIMAL(38,0)))"}


def _counted(df: DataFrame) -> DataFrame:
    """_t: the total in the site's unit, from _most and _odd; _unit: the unit in kWh, null for cents."""
    huge = f"_odd = 0D AND _most >= {MOST_KWH!r}D"
    return df.selectExpr("*", f"CASE WHEN {huge} THEN pow(2D, floor(log2(_most)) - 45) END AS _unit").selectExpr(
        "*", "CASE WHEN _odd <> 0D THEN NULL WHEN _unit IS NULL THEN total_cents ELSE CAST(rint(total_kwh / _unit) AS BIGINT) END AS _t"
    )


def with_measures(df: DataFrame, sigmas: int = ANOMALY_SIGMAS) -> DataFrame:
    """WIN1-WIN4 of rows that have their site's _n, _s, _q, _unit and _odd; drops these but for _odd."""
    staged = df.selectExpr(
        "*",
        # n^2 * sigma^2 and n * (t - mean), both in units, exact
        "CAST(_n AS DECIMAL(38,0)) * _q - CAST(_s AS DECIMAL(38,0)) * CAST(_s AS DECIMAL(38,0)) AS _var",
        "CAST(_n AS DECIMAL(38,0)) * _t - CAST(_s AS DECIMAL(38,0)) AS _spread",
    )
    dev_num = "_spread * 1000 * CAST(signum(_s) AS BIGINT)"
    dev_den = "CAST(abs(_s) AS DECIMAL(38,0))"
    deviation = (
        "CASE WHEN _odd <> 0D THEN double('NaN') "
        f"WHEN _s <> 0 THEN (CASE WHEN {dev_num} >= 0 "
        f"THEN (2 * {dev_num} + {dev_den}) div (2 * {dev_den}) "
        f"ELSE -((-2 * {dev_num} + {dev_den}) div (2 * {dev_den})) END) / 10.0D END"
    )

    def of(state: str) -> str:
        in_unit = f"CASE WHEN _unit IS NULL THEN {state} / CAST(_n * 100 AS DOUBLE) ELSE {state} / CAST(_n AS DOUBLE) * _unit END"
        return f"CASE WHEN _n > 0 THEN {in_unit} END"

    return staged.selectExpr(
        "*",
        f"CASE WHEN _odd <> 0D THEN _odd ELSE {of('CAST(_s AS DOUBLE)')} END AS site_mean_kwh",
        f"CASE WHEN _odd <> 0D THEN double('NaN') ELSE {of('sqrt(CAST(_var AS DOUBLE))')} END AS site_stddev_kwh",
        f"coalesce(_spread > 0 AND _spread * _spread > {sigmas * sigmas} * _var, false) AS anomaly_flag",
        f"{deviation} AS deviation_pct",
    ).drop("_n", "_s", "_q", "_unit", "_t", "_var", "_spread")


def gold(silver_df: DataFrame) -> DataFrame:
    """Daily per-site gold table, 15 columns in fixed order (CMP2)."""
    return with_baseline(daily(silver_df)).select(*schemas.GOLD_COLUMNS)


def daily_by_site(readings: DataFrame) -> DataFrame:
    """Clean raw readings rolled up by (site_id, reading_date) only."""
    return with_total(
        with_reading_date(clean_readings(readings)).groupBy("site_id", "reading_date").agg(*daily_aggs())
    )


def build_gold(
    readings: DataFrame,
    sites: DataFrame,
    regions: DataFrame,
    business_units: DataFrame,
    keep_cents: bool = False,
) -> DataFrame:
    """Gold for large data: aggregate first, then attach dimensions, then the window."""
    dim = joins.site_dim(sites, regions, business_units).select("site_id", *schemas.GOLD_ATTRIBUTES)
    # Daily rows x site attributes: a sort-merge join here shuffles only the
    # dimension, because the window below needs site_id partitioning anyway.
    per_day = daily_by_site(readings).join(dim, on="site_id", how="left")
    out = with_baseline(per_day)
    cols = schemas.GOLD_COLUMNS + (["total_cents"] if keep_cents else [])
    return out.select(*cols)


def build(tables: dict[str, DataFrame]) -> DataFrame:
    """Gold from a dict of the four base tables."""
    return build_gold(
        tables["meter_readings"], tables["sites"], tables["regions"], tables["business_units"]
    )
