"""Aggregations over gold and raw readings (AGG2-AGG18).

All are ``groupBy().agg()`` with built-in functions: partial aggregation runs
map-side, so only one row per group per task is shuffled, and a group that
holds a third of all rows costs no more than any other. Sums of kWh are
done on integer cents (gold) or exact parts (raw readings, ``functions.exact``) and divided
once at the end, so results are exact and do not depend on row order.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitewatts.functions import zones
from sitewatts.functions.columns import pct_text, utc_date, utc_hour
from sitewatts.functions.exact import (
    cents_sql,
    kwh_mean,
    kwh_sum,
    mean_sql,
    merged_moments,
    merged_sum_sql,
    moment_columns,
    moments,
    parts,
    with_spread,
)
from sitewatts.operators import filters
from sitewatts.operators.joins import with_site_details

DateLike = str | dt.date


def cents(c: str) -> Column:
    """A 2-dp kWh total (gold) as integer cents; null for NaN, infinite and huge ones."""
    return F.expr(cents_sql(c))


def kwh_total(c: str) -> Column:
    """Exact sum of 2-dp kWh values, as a double."""
    return kwh_sum(c)


def gold_audit(gold: DataFrame) -> DataFrame:
    """Rows, anomaly rows, sites, first and last date; one row (AGG2)."""
    return gold.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("anomaly_flag")).alias("anomaly_rows"),
        F.countDistinct("site_id").alias("sites_covered"),
        F.min("reading_date").alias("first_date"),
        F.max("reading_date").alias("last_date"),
    )


def reading_span(readings: DataFrame) -> DataFrame:
    """Row count and first / last reading instant (AGG3)."""
    return readings.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("reading_timestamp").alias("first_reading"),
        F.max("reading_timestamp").alias("last_reading"),
    )


def anomalies_by_bu(gold: DataFrame, as_of: DateLike, days: int = 7) -> DataFrame:
    """Anomalies per business unit over the last ``days`` (D8), most first (AGG4)."""
    recent = filters.since(filters.anomalies(gold), as_of, days)
    return (
        recent.groupBy("business_unit_name")
        .agg(F.count(F.lit(1)).alias("anomaly_count"))
        .orderBy(F.desc("anomaly_count"), F.asc_nulls_last("business_unit_name"))
    )


def kwh_by_site(gold: DataFrame, sites: DataFrame, as_of: DateLike, days: int = 14) -> DataFrame:
    """kWh per (site_name, site_type, business unit) over the last ``days`` (AGG5)."""
    recent = filters.since(gold, as_of, days)
    joined = with_site_details(recent, sites, ["site_name"])
    return joined.groupBy("site_name", "site_type", "business_unit_name").agg(
        kwh_total("total_kwh").alias("total_kwh_14d" if days == 14 else f"total_kwh_{days}d")
    )


def anomalies_per_day(anoms: DataFrame) -> DataFrame:
    """Anomaly count per date; days without anomalies are absent (AGG6)."""
    return anoms.groupBy("reading_date").agg(F.count(F.lit(1)).alias("anomaly_count"))


def anomalies_bu_type(anoms: DataFrame) -> DataFrame:
    """Anomaly count per (business unit, site type) (AGG7)."""
    return anoms.groupBy("business_unit_name", "site_type").agg(F.count(F.lit(1)).alias("anomaly_count"))


def anomaly_kpi(gold: DataFrame, as_of: DateLike, days: int = 7) -> DataFrame:
    """Single count of anomalies in the last ``days`` (AGG8)."""
    return filters.since(filters.anomalies(gold), as_of, days).agg(
        F.count(F.lit(1)).alias("anomalies_last_7d" if days == 7 else f"anomalies_last_{days}d")
    )


def pct_label(c: Column) -> Column:
    """Whole-percent label of a deviation, dash when NULL (SCL11)."""
    return pct_text(c)


def anomaly_headline(anoms: DataFrame) -> DataFrame:
    """Rows, distinct sites, highest deviation; empty input gives 0, 0, NULL (AGG9)."""
    out = anoms.agg(
        F.count(F.lit(1)).alias("anomalies_in_range"),
        F.countDistinct("site_id").alias("distinct_sites_flagged"),
        F.max("deviation_pct").alias("highest_deviation_pct"),
    )
    return out.withColumn("highest_deviation_label", pct_label(F.col("highest_deviation_pct")))


def kwh_by_type_day(gold: DataFrame) -> DataFrame:
    """Total daily kWh per (date, site_type) (AGG10)."""
    return gold.groupBy("reading_date", "site_type").agg(kwh_total("total_kwh").alias("total_kwh"))


def site_month_kwh(gold: DataFrame, month: DateLike) -> DataFrame:
    """kWh per (business unit, site) in one calendar month (AGG11)."""
    return (
        filters.in_month(gold, month)
        .groupBy("business_unit_name", "site_id")
        .agg(kwh_total("total_kwh").alias("month_kwh"))
    )


def status_counts(readings: DataFrame) -> DataFrame:
    """Warning and error readings per (site, UTC day), from raw readings (AGG12, T15)."""
    return (
        readings.withColumn("reading_date", utc_date("reading_timestamp"))
        .groupBy("site_id", "reading_date")
        .agg(
            F.count_if(F.col("status") == "warning").alias("warning_readings"),
            F.count_if(F.col("status") == "error").alias("error_readings"),
        )
    )


def triage_summary(anoms: DataFrame) -> DataFrame:
    """N anomalies across M sites (AGG13, global part)."""
    return anoms.agg(
        F.count(F.lit(1)).alias("anomalies_found"),
        F.countDistinct("site_id").alias("sites_affected"),
    )


def triage_by_bu(anoms: DataFrame) -> DataFrame:
    """Anomaly count per business unit (AGG13, per-unit part)."""
    return anoms.groupBy("business_unit_name").agg(F.count(F.lit(1)).alias("anomaly_count"))


def temperature_sums(t: str) -> list[Column]:
    """Per-group exact sums (_t_*) of the temperatures in the column or SQL ``t``."""
    return moments(t, "_t")


def with_temperature_flags(per_day: DataFrame, k_sigma: int = 1) -> DataFrame:
    """From the per (site, day) sums of ``temperature_sums``: avg_temp_c and temp_elevated (D12).

    ``temp_elevated`` when the day's mean exceeds the site's mean over all its
    readings by more than ``k_sigma`` population standard deviations. Also returns
    the site mean and sigma. Drops the helper columns.
    """
    staged = per_day.selectExpr("*", *merged_moments("_t", "OVER (PARTITION BY site_id)", into="_site"))
    staged = staged.selectExpr("*", f"{mean_sql('_t')} AS avg_temp_c", f"{mean_sql('_site')} AS site_mean_temp_c")
    staged = with_spread(staged, "_site", "site_stddev_temp_c")
    return staged.selectExpr(
        "*",
        f"coalesce(avg_temp_c - site_mean_temp_c > {k_sigma} * site_stddev_temp_c, false) AS temp_elevated",
    ).drop(*moment_columns("_t"), *moment_columns("_site"))


def temperature_evidence(readings: DataFrame, k_sigma: int = 1) -> DataFrame:
    """Per (site, day): mean / max temperature vs the site's own level (AGG14, D12)."""
    per_day = (
        readings.withColumn("reading_date", utc_date("reading_timestamp"))
        .groupBy("site_id", "reading_date")
        .agg(*temperature_sums("temperature_c"), F.max("temperature_c").alias("max_temp_c"))
    )
    return with_temperature_flags(per_day, k_sigma).select(
        "site_id", "reading_date", "avg_temp_c", "max_temp_c", "site_mean_temp_c", "site_stddev_temp_c",
        "temp_elevated",
    )


def hourly_profile(readings: DataFrame, sites: DataFrame, local: bool = False, regions: DataFrame | None = None) -> DataFrame:
    """Mean kWh per hour of day by site type (AGG15).

    UTC hour by default; ``local=True`` uses the region's zone (SCL9). Shows
    the business-hours / night load pattern.

    Both aggregate first; raw rows are never joined. Readings are summed per (site,
    hour of day), or for local hours per (site, segment of constant zone offsets, UTC
    quarter of the day; see ``functions.zones``), before the site's type and zone are joined.
    """
    if not local:
        per_site = readings.groupBy("site_id", utc_hour("reading_timestamp").alias("utc_hour")).agg(*hourly_sums())
        joined = per_site.join(sites.select("site_id", "site_type"), on="site_id", how="inner")
        return joined.groupBy("site_type", "utc_hour").agg(*hourly_means())
    per_site = zones.with_segment(readings, regions).groupBy("site_id", "_segment", "_time").agg(*hourly_sums())
    joined = per_site.join(site_zones(sites, regions), on="site_id", how="inner")
    return joined.groupBy("site_type", F.expr(zones.hour_sql("timezone")).alias("local_hour")).agg(*hourly_means())


def site_zones(sites: DataFrame, regions: DataFrame) -> DataFrame:
    """site_id, site_type and the region's timezone."""
    zone = regions.select("region_id", "timezone")
    return sites.select("site_id", "site_type", "region_id").join(zone, on="region_id", how="left").drop("region_id")


def hourly_sums(kwh: str = "kwh_consumed") -> list[Column]:
    return [*parts(kwh, "_m"), F.count(kwh).alias("_c")]


def hourly_means() -> list[Column]:
    """n_readings and mean_kwh over rows of ``hourly_sums``."""
    mean = f"try_divide({merged_sum_sql('_m')}, CAST(sum(_c) AS DOUBLE))"
    return [F.sum("_c").alias("n_readings"), F.expr(mean).alias("mean_kwh")]


def status_share(readings: DataFrame) -> DataFrame:
    """Count and share of each status (AGG16). The share divides by the
    total of a handful of grouped rows, never of the raw table."""
    counts = readings.groupBy("status").agg(F.count(F.lit(1)).alias("n_readings"))
    total = F.sum("n_readings").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("share", F.try_divide(F.col("n_readings").cast("double"), total.cast("double")))


PROFILE_COLUMNS = ("kwh_consumed", "kw_demand", "voltage", "temperature_c")


def profile_sums(columns: tuple[str, ...] = PROFILE_COLUMNS) -> list[Column]:
    """Mergeable sums of each column's profile."""
    aggs = []
    for c in columns:
        aggs += [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls"), F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
        aggs += moments(c, c)
    return aggs


def merged_profile_sums(columns: tuple[str, ...] = PROFILE_COLUMNS) -> list[Column]:
    """The sums of ``profile_sums`` added up over groups."""
    aggs = []
    for c in columns:
        aggs += [F.sum(f"{c}_nulls").alias(f"{c}_nulls"), F.min(f"{c}_min").alias(f"{c}_min"), F.max(f"{c}_max").alias(f"{c}_max")]
        aggs += [F.expr(m) for m in merged_moments(c)]
    return aggs


def profiled(sums: DataFrame, columns: tuple[str, ...] = PROFILE_COLUMNS, keys: tuple[str, ...] = (), whole: bool = False) -> DataFrame:
    """Rows of ``profile_sums`` as one row per column; the columns of ``sums`` named in ``keys`` stay.

    ``whole``: and one row more with nulls for them.
    """
    names = ["nulls", "min", "max", *[m.removeprefix("c_") for m in moment_columns("c")]]
    doubles = ("min", "max")
    rows = [
        f"'{c}', " + ", ".join(f"CAST(`{c}_{m}` AS DOUBLE)" if m in doubles else f"`{c}_{m}`" for m in names) for c in columns
    ]
    if whole:
        rows.append(", ".join(["NULL"] * (1 + len(names))))
    stacked = F.expr(f"stack({len(rows)}, {', '.join(rows)}) AS (column_name, {', '.join('v_' + m for m in names)})")
    long = with_spread(sums.select(*keys, stacked), "v", "stddev_value")
    return long.selectExpr(
        *keys, "column_name", "v_n + v_fn AS non_null", "v_nulls AS null_count", "v_min AS min_value", "v_max AS max_value",
        f"{mean_sql('v')} AS mean_value", "stddev_value",
    )


def profile(readings: DataFrame, columns: tuple[str, ...] = PROFILE_COLUMNS) -> DataFrame:
    """count, nulls, min, max, mean, population stddev per numeric column, one pass (AGG17).

    Mean and spread come from exact sums. NaN is a value: it is counted, and makes mean and spread NaN.
    """
    return profiled(readings.agg(*profile_sums(columns)), columns)


def kwh_by_dimension(gold: DataFrame, dim: str) -> DataFrame:
    """Total and mean daily kWh per site_type / business_unit_name / region_name (AGG18)."""
    return gold.groupBy(dim).agg(
        kwh_total("total_kwh").alias("total_kwh"),
        kwh_mean("total_kwh").alias("mean_daily_kwh"),
        F.count(F.lit(1)).alias("site_days"),
    )
