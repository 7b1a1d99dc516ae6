"""Composite results over gold (CMP3 anomaly details, CMP4 overview, CMP6 exploration).

Each is a composition of operators; only aggregated rows ever need to leave
the cluster.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitewatts.functions import zones

from sitewatts.operators import aggregates, filters, topk
from sitewatts.operators.joins import with_site_details

DateLike = str | dt.date

DETAIL_COLUMNS = [
    "reading_date",
    "site_id",
    "site_name",
    "site_type",
    "business_unit_name",
    "region_name",
    "city",
    "state",
    "total_kwh",
    "peak_kw",
    "deviation_pct",
    "warning_count",
]


def site_types(gold: DataFrame) -> DataFrame:
    """Sorted distinct site types (PRJ5)."""
    return gold.select("site_type").distinct().orderBy(F.asc_nulls_last("site_type"))


def anomaly_details(
    gold: DataFrame,
    sites: DataFrame,
    start: DateLike,
    end: DateLike,
    types: Iterable[str] | None = None,
) -> DataFrame:
    """Flagged (site, day) rows in [start, end] of the chosen types, with site
    details, newest first (CMP3 = FLT2 + FLT4 + FLT5 + JOIN4 + PRJ3 + SRT1)."""
    rows = filters.of_types(filters.between_dates(filters.anomalies(gold), start, end), types)
    joined = with_site_details(rows, sites, ["site_name", "city", "state"])
    return topk.anomaly_order(joined.select(*DETAIL_COLUMNS))


def overview(gold: DataFrame, as_of: DateLike, start: DateLike | None = None, end: DateLike | None = None) -> dict[str, DataFrame]:
    """The four dashboard data sets under one optional date range (CMP4)."""
    ranged = gold if start is None else filters.between_dates(gold, start, end)
    anoms = filters.anomalies(ranged)
    return {
        "kpi": aggregates.anomaly_kpi(ranged, as_of, 7),
        "per_day": aggregates.anomalies_per_day(filters.since(anoms, as_of, 30)),
        "bu_type": aggregates.anomalies_bu_type(anoms),
        "top_deviation": topk.top_deviation(ranged, 10),
    }


#: The parts of the exploration report (CMP6).
EXPLORATION = (
    "span", "kwh_by_type_day", "hourly_utc", "hourly_local", "status_share", "profile", "by_site_type", "by_business_unit", "by_region",
)


def exploration(readings: DataFrame, sites: DataFrame, regions: DataFrame, gold: Callable[[], DataFrame], part: str) -> DataFrame:
    """One part of the exploration report's data (CMP6): span, daily kWh by type, hourly profiles, status
    share, column profile, consumption by dimension. Nothing else is built; ``gold`` only if the part is about it."""
    builders = {
        "span": lambda: aggregates.reading_span(readings),
        "kwh_by_type_day": lambda: aggregates.kwh_by_type_day(gold()),
        "hourly_utc": lambda: aggregates.hourly_profile(readings, sites),
        "hourly_local": lambda: aggregates.hourly_profile(readings, sites, local=True, regions=regions),
        "status_share": lambda: aggregates.status_share(readings),
        "profile": lambda: aggregates.profile(readings),
        "by_site_type": lambda: aggregates.kwh_by_dimension(gold(), "site_type"),
        "by_business_unit": lambda: aggregates.kwh_by_dimension(gold(), "business_unit_name"),
        "by_region": lambda: aggregates.kwh_by_dimension(gold(), "region_name"),
    }
    return builders[part]()


REPORT_COLUMNS = {
    "part": "string", "reading_date": "date", "site_type": "string", "business_unit_name": "string", "region_name": "string",
    "hour": "int", "status": "string", "column_name": "string", "n": "bigint", "null_count": "bigint",
    "first_reading": "timestamp", "last_reading": "timestamp", "min_value": "double", "max_value": "double",
    "mean_value": "double", "stddev_value": "double", "share": "double", "total_kwh": "double",
}


def _reported(df: DataFrame) -> DataFrame:
    """The report's columns; those that a part doesn't have are null."""
    return df.selectExpr(*[
        f"CAST({c if c in df.columns else 'NULL'} AS {kind}) AS {c}" for c, kind in REPORT_COLUMNS.items()
    ])


def _raw_parts(readings: DataFrame, sites: DataFrame, regions: DataFrame) -> DataFrame:
    """Span, profile, status shares and hourly profiles from one scan of the readings.

    Each reading counts in two groupings: its status (with the sums of the column profile), and its site, segment of
    constant zone offsets and quarter of the day (with those of the hourly means). Only groups meet the dimensions.
    """
    columns = aggregates.PROFILE_COLUMNS
    rows = zones.with_segment(readings, regions).select(
        F.explode(F.lit(["status", "hour"])).alias("_set"), "site_id", "status", "_segment", "_time", "reading_timestamp", *columns
    )
    only = lambda s, c, out=None: F.expr(f"CASE WHEN _set = '{s}' THEN {c} END").alias(out or c)
    rows = rows.select(
        "_set", "reading_timestamp", *[only("status", c) for c in ("status", *columns)],
        *[only("hour", c) for c in ("site_id", "_segment", "_time")], only("hour", "kwh_consumed", "_kwh"),
    )
    cube = rows.groupBy("_set", "status", "site_id", "_segment", "_time").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("reading_timestamp").alias("first_reading"),
        F.max("reading_timestamp").alias("last_reading"), *aggregates.hourly_sums("_kwh"), *aggregates.profile_sums(columns),
    )
    # a status is also part of the whole; a site's hour counts in UTC and in its zone, if the site is known
    known = aggregates.site_zones(sites, regions).withColumn("_known", F.lit(True))
    roles = f"""inline(CASE WHEN _set = 'hour' THEN array(
        struct('hourly_utc' AS part, {zones.hour_sql()} AS hour), struct('hourly_local' AS part, {zones.hour_sql("timezone")} AS hour)
      ) ELSE array(struct('status_share' AS part, CAST(NULL AS INT) AS hour), struct('span' AS part, CAST(NULL AS INT) AS hour)) END)"""
    placed = cube.join(known, "site_id", "left").where("_set = 'status' OR _known").selectExpr("*", roles)
    placed = placed.withColumn("status", F.expr("CASE WHEN part = 'status_share' THEN status END"))
    merged = placed.groupBy("part", "site_type", "hour", "status").agg(
        F.sum("_rows").alias("_rows"), F.min("first_reading").alias("first_reading"), F.max("last_reading").alias("last_reading"),
        *aggregates.hourly_means(), *aggregates.merged_profile_sums(columns),
    )
    total = F.sum("_rows").over(Window.partitionBy("part"))
    merged = merged.withColumn("share", F.try_divide(F.col("_rows").cast("double"), total.cast("double")))
    keys = ("part", "site_type", "hour", "status", "_rows", "first_reading", "last_reading", "n_readings", "mean_kwh", "share")
    told = aggregates.profiled(merged, columns, keys, whole=True).where("column_name IS NULL OR part = 'span'")
    told = told.withColumn("part", F.expr("CASE WHEN column_name IS NULL THEN part ELSE 'profile' END"))
    shown = {
        "n": "CASE WHEN part = 'profile' THEN non_null WHEN part LIKE 'hourly%' THEN n_readings ELSE _rows END",
        "first_reading": "CASE WHEN part = 'span' THEN first_reading END",
        "last_reading": "CASE WHEN part = 'span' THEN last_reading END",
        "share": "CASE WHEN part = 'status_share' THEN share END",
        "mean_value": "CASE WHEN part = 'profile' THEN mean_value WHEN part LIKE 'hourly%' THEN mean_kwh END",
    }
    return told.withColumns({c: F.expr(e) for c, e in shown.items()})


_DIMENSIONS = {"by_site_type": "site_type", "by_business_unit": "business_unit_name", "by_region": "region_name"}


def _gold_parts(gold: DataFrame) -> DataFrame:
    """Daily kWh by type and consumption by dimension from one pass over gold, by grouping sets."""
    sets = [["reading_date", "site_type"], *([d] for d in _DIMENSIONS.values())]
    sums = gold.groupingSets(sets, "reading_date", *_DIMENSIONS.values()).agg(
        F.grouping("reading_date").alias("_all_days"), *[F.grouping(d).alias(f"_no_{d}") for d in _DIMENSIONS.values()],
        aggregates.kwh_total("total_kwh").alias("total_kwh"), aggregates.kwh_mean("total_kwh").alias("mean_value"),
        F.count(F.lit(1)).alias("n"),
    )
    part = " ".join(f"WHEN _no_{d} = 0 THEN '{p}'" for p, d in _DIMENSIONS.items())
    parted = sums.withColumn("part", F.expr(f"CASE WHEN _all_days = 0 THEN 'kwh_by_type_day' {part} END"))
    per_day = "part = 'kwh_by_type_day'"
    return parted.withColumns({c: F.expr(f"CASE WHEN {per_day} THEN NULL ELSE {c} END") for c in ("n", "mean_value")})


def exploration_report(readings: DataFrame, sites: DataFrame, regions: DataFrame, gold: DataFrame) -> DataFrame:
    """The whole exploration report (CMP6) as rows of ``REPORT_COLUMNS``: one scan of the readings, one of gold."""
    return _reported(_raw_parts(readings, sites, regions)).unionByName(_reported(_gold_parts(gold)))
