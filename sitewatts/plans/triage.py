"""Anomaly triage (CMP5): the evidence table behind a triage report.

FLT6 window -> FLT2 anomalies -> JOIN4 site details -> MSR5 deviation ->
JOIN6 raw warning/error counts of the same day -> AGG14 temperature ->
a cause class per (site, day). The report text itself is not built here;
its numbers are these columns plus ``triage_summary`` / ``triage_by_bu``
and ``triage_top``.

Cause class (D11): ``meter_issue`` when the day's warning + error readings
exceed ``ratio`` times the site's mean daily count over all its days,
otherwise ``genuine``. Decided in integers.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewatts import schemas
from sitewatts.functions.columns import utc_date
from sitewatts.operators import aggregates, filters, measures
from sitewatts.operators.joins import meter_health, site_dim, with_site_details
from sitewatts.plans import pipeline

DateLike = str | dt.date

TRIAGE_COLUMNS = [
    "reading_date",
    "site_id",
    "site_name",
    "city",
    "state",
    "site_type",
    "business_unit_name",
    "region_name",
    "square_footage",
    "total_kwh",
    "site_mean_kwh",
    "deviation_pct",
    "warning_readings",
    "error_readings",
    "avg_temp_c",
    "temp_elevated",
    "cause_class",
]


_T_OK = "CASE WHEN status <> 'error' THEN temperature_c END"


def evidence_sums() -> list[Column]:
    """Per (site, day): warning and error readings of all rows (T15), temperature sums of the non-error rows."""
    return [
        F.count_if(F.col("status") == "warning").alias("warning_readings"),
        F.count_if(F.col("status") == "error").alias("error_readings"),
        *aggregates.temperature_sums(_T_OK),
        F.expr(f"max({_T_OK})").alias("max_temp_c"),
    ]


def _with_evidence(per_day: DataFrame, k_sigma: int = 1) -> DataFrame:
    """Rows of ``evidence_sums`` with the day's and the site's temperature, and the site's day count and issues."""
    w = "OVER (PARTITION BY site_id)"
    staged = per_day.selectExpr(
        "*", f"count(1) {w} AS _issue_days", f"sum(warning_readings + error_readings) {w} AS _issue_total"
    )
    return aggregates.with_temperature_flags(staged, k_sigma)


def daily_evidence(readings: DataFrame, k_sigma: int = 1) -> DataFrame:
    """Per (site, UTC day) evidence from raw readings, one aggregation (AGG12 + AGG14).

    warning / error readings (all rows, T15); mean and max temperature of the
    non-error rows and whether the day's mean is above the site's mean by more
    than ``k_sigma`` population sigmas (D12); and the
    site's day count and total of warning + error readings (for D11).
    Grouping is by (site, day) with map-side partial aggregation, so a hot
    site costs one row per day per task in the shuffle.
    """
    per_day = readings.withColumn("reading_date", utc_date("reading_timestamp")).groupBy("site_id", "reading_date")
    return _with_evidence(per_day.agg(*evidence_sums()), k_sigma).select(
        "site_id",
        "reading_date",
        "warning_readings",
        "error_readings",
        "avg_temp_c",
        "max_temp_c",
        "temp_elevated",
        "_issue_days",
        "_issue_total",
    )


DETAILS = ["site_name", "city", "state", "square_footage"]


def triage(
    gold: DataFrame,
    sites: DataFrame,
    readings: DataFrame,
    window: tuple[dt.date, dt.date],
    ratio: int = 2,
) -> DataFrame:
    """One row per anomalous (site, day) in ``window`` with its evidence (CMP5).

    The anomalies are few (flagged days of one window). The raw readings are cut
    to the flagged sites by a semi join before they are aggregated per (site,
    day); the evidence needs a flagged site's whole history (its mean counts and
    temperatures), so it isn't cut by date.
    """
    anoms = filters.in_window(filters.anomalies(gold), window)
    anoms = measures.ensure_deviation(anoms)
    detailed = with_site_details(anoms, sites, DETAILS)
    flagged = readings.join(anoms.select("site_id").distinct(), on="site_id", how="left_semi")
    return _classified(meter_health(detailed, daily_evidence(flagged)), ratio)


def triage_readings(
    readings: DataFrame,
    sites: DataFrame,
    regions: DataFrame,
    business_units: DataFrame,
    window: tuple[dt.date, dt.date],
    ratio: int = 2,
) -> DataFrame:
    """CMP5 without a gold table: one scan and one roll-up of the readings give gold and the evidence (CMP5).

    The sums of gold look at clean rows, those of the evidence at all rows of the same (site, day). A day
    without a clean row counts as evidence, but isn't a day of gold.
    """
    usable = pipeline.clean_condition()
    rows = pipeline.with_reading_date(readings).withColumn("_usable", F.coalesce(usable, F.lit(False)))
    clean = {c: F.when(F.col("_usable"), F.col(c)) for c in ("kwh_consumed", "kw_demand", "voltage")}
    rows = rows.withColumns(clean)
    per_day = rows.groupBy("site_id", "reading_date").agg(
        *pipeline.daily_aggs(warning="_usable AND status = 'warning'"), F.count_if("_usable").alias("_usable_rows"), *evidence_sums()
    )
    evident = _with_evidence(per_day).where("_usable_rows > 0").drop("_usable_rows")
    gold = pipeline.with_baseline(pipeline.with_total(evident))
    anoms = filters.in_window(filters.anomalies(gold), window)
    dim = site_dim(sites, regions, business_units).select("site_id", *schemas.GOLD_ATTRIBUTES)
    detailed = with_site_details(anoms.join(dim, on="site_id", how="left"), sites, DETAILS)
    return _classified(detailed, ratio)


def _classified(out: DataFrame, ratio: int) -> DataFrame:
    issues = F.col("warning_readings") + F.col("error_readings")
    meter = issues * F.col("_issue_days") > F.lit(ratio) * F.col("_issue_total")
    out = out.withColumn(
        "cause_class", F.when(F.coalesce(meter, F.lit(False)), "meter_issue").otherwise("genuine")
    ).withColumn("temp_elevated", F.coalesce(F.col("temp_elevated"), F.lit(False)))
    return out.select(*TRIAGE_COLUMNS).orderBy(
        F.desc_nulls_last("deviation_pct"), F.asc("site_id"), F.asc("reading_date")
    )
