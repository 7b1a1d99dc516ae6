"""Sorts and top-k questions (SRT1, TOP1-TOP6, LIM1).

``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each task keeps
its own k best rows and only those are merged, so no full sort or single
task ever holds the table. Ties break on site_id, then reading_date (D7);
NULLs sort last (D15).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewatts.functions.exact import far_sql
from sitewatts.operators import aggregates, filters, measures
from sitewatts.operators.joins import with_site_details

DateLike = str | dt.date


def anomaly_order(df: DataFrame) -> DataFrame:
    """Date desc, deviation desc, site_id (SRT1)."""
    return df.orderBy(
        F.desc_nulls_last("reading_date"), F.desc_nulls_last("deviation_pct"), F.asc("site_id")
    )


def top_sites_kwh(gold: DataFrame, sites: DataFrame, as_of: DateLike, days: int = 14, n: int = 5) -> DataFrame:
    """Top ``n`` sites by total kWh over the last ``days`` (TOP1)."""
    per_site = aggregates.kwh_by_site(gold, sites, as_of, days)
    total = per_site.columns[-1]
    return per_site.orderBy(F.desc_nulls_last(total), F.asc("site_name")).limit(n)


def _intensity(gold: DataFrame, sites: DataFrame, as_of: DateLike, days: int) -> DataFrame:
    """Per site over the period: mean daily kWh/sqft and mean MSR2 (D4, D5).

    Both means are exact: sqft is constant per site, and MSR2 is linear in
    the day's total, so each mean is one division of integer sums.
    """
    staged = measures.with_site_stats(gold)
    recent = filters.since(staged, as_of, days)
    joined = with_site_details(recent, sites, ["site_name", "square_footage"])
    per_site = joined.groupBy("site_id", "site_name", "business_unit_name", "square_footage").agg(
        F.sum(aggregates.cents("total_kwh")).alias("_p"),
        F.expr(f"sum({far_sql('total_kwh')})").alias("_pf"),
        F.count(F.lit(1)).alias("days_in_period"),
        *[F.first(c).alias(c) for c in ("_n", "_s", "_f")],
    )
    area = "CAST(square_footage AS BIGINT) * days_in_period"
    kwh = "(_pf + coalesce(_p, 0) / 100D)"  # of the period, where a total isn't near
    intensity = (
        f"CASE WHEN square_footage = 0 THEN NULL WHEN _pf IS NULL THEN CAST(_p AS DOUBLE) / CAST({area} * 100 AS DOUBLE) "
        f"ELSE {kwh} / CAST({area} AS DOUBLE) END"
    )
    deviation = (
        "CASE WHEN _f IS NULL THEN CASE WHEN _s <> 0 THEN "
        "CAST((_n * _p - days_in_period * _s) * 100 AS DOUBLE) / CAST(days_in_period * _s AS DOUBLE) END "
        f"ELSE (coalesce({kwh}, _p / 100D) / days_in_period - {measures.ROUGH_MEAN}) / {measures.ROUGH_MEAN} * 100D END"
    )
    return per_site.selectExpr(
        "site_id", "site_name", "business_unit_name", "days_in_period",
        f"{intensity} AS avg_kwh_per_sqft", f"{deviation} AS avg_deviation_from_baseline_pct",
    )


def top_sites_intensity(gold: DataFrame, sites: DataFrame, as_of: DateLike, days: int = 14, n: int = 5) -> DataFrame:
    """Top ``n`` sites by mean daily kWh per square foot over the last ``days`` (TOP2)."""
    return (
        _intensity(gold, sites, as_of, days)
        .select("site_id", "site_name", "days_in_period", "avg_kwh_per_sqft")
        .orderBy(F.desc_nulls_last("avg_kwh_per_sqft"), F.asc("site_id"))
        .limit(n)
    )


def top_sites_intensity_detail(gold: DataFrame, sites: DataFrame, as_of: DateLike, days: int = 14, n: int = 3) -> DataFrame:
    """TOP2 with business unit and mean deviation from baseline (TOP3)."""
    return (
        _intensity(gold, sites, as_of, days)
        .orderBy(F.desc_nulls_last("avg_kwh_per_sqft"), F.asc("site_id"))
        .limit(n)
    )


def top_deviation(gold: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` (site, day) rows by deviation_pct, flagged or not (TOP4, D9)."""
    return gold.orderBy(
        F.desc_nulls_last("deviation_pct"), F.asc("site_id"), F.asc("reading_date")
    ).limit(n)


def triage_top(df: DataFrame, n: int = 3) -> DataFrame:
    """Top ``n`` anomalies by deviation; fewer if fewer exist, never padded (TOP5)."""
    rows = filters.anomalies(df) if "anomaly_flag" in df.columns else df
    return rows.orderBy(
        F.desc_nulls_last("deviation_pct"), F.asc("site_id"), F.asc("reading_date")
    ).limit(n)


def top_sites_peak(gold: DataFrame, as_of: DateLike, days: int = 14, n: int = 5) -> DataFrame:
    """Sites ranked by highest daily peak kW over the last ``days`` (TOP6)."""
    per_site = filters.since(gold, as_of, days).groupBy("site_id", "site_type", "business_unit_name").agg(
        F.max("peak_kw").alias("max_peak_kw")
    )
    return per_site.orderBy(F.desc_nulls_last("max_peak_kw"), F.asc("site_id")).limit(n)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows, unordered (LIM1)."""
    return df.limit(n)
