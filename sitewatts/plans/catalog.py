"""Registry of runnable queries over the driver tables, and their SQL oracles.

Every query reads the whole driver tables through the adapter; nothing is
sampled or capped except where a limit is the feature (top-k, preview).
``AS_OF`` is the last event date (D1). Keys are SURVEY section 2 op ids,
lower-cased, with the function name.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewatts import oracle_sql as O
from sitewatts.functions import sql_functions
from sitewatts.functions.columns import reading_id, utc_date, whole_days_between
from sitewatts.operators import aggregates as A
from sitewatts.operators import filters, forecast, joins, measures, quality, topk, windows
from sitewatts.plans import incremental, pipeline, questions, triage
from sitewatts.sources import adapter, generate, tables

AS_OF = dt.date(2024, 1, 30)
MONTH = "2024-01"
ONE_SITE = "8"
TYPES = ["factory", "data_center"]


def _d(days_back: int) -> str:
    return f"DATE '{(AS_OF - dt.timedelta(days=days_back)).isoformat()}'"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = O.q(sql)
        return fn

    return deco


def star(spark: SparkSession, sf_dir: str, **bounds) -> dict[str, DataFrame]:
    """The base tables, read anew on each call; ``bounds`` cut the readings (see the adapter)."""
    return adapter.load_star(spark, sf_dir, **bounds)


def gold_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.build(star(spark, sf_dir))


def gold_sites(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    t = star(spark, sf_dir)
    return pipeline.build(t), t["sites"]


CENTS = "CAST(floor(total_kwh * 100 + 0.5) AS BIGINT)"
KWH_TOTAL = f"CAST(SUM({CENTS}) AS DOUBLE) / 100.0::DOUBLE"

# ---------------------------------------------------------------------------
# Sources, silver, gold
# ---------------------------------------------------------------------------


@register("src1_scan_meter_readings", "SELECT * FROM meter_readings")
def src1_scan_meter_readings(spark, sf_dir):
    return adapter.meter_readings(spark, sf_dir)


@register("src1_scan_sites", "SELECT * FROM sites")
def src1_scan_sites(spark, sf_dir):
    return adapter.sites(spark, sf_dir)


@register("src1_scan_regions", "SELECT * FROM regions")
def src1_scan_regions(spark, sf_dir):
    return adapter.regions(spark, sf_dir)


@register("src1_scan_business_units", "SELECT * FROM business_units")
def src1_scan_business_units(spark, sf_dir):
    return adapter.business_units(spark, sf_dir)


GEN_DAYS, GEN_STEPS = 30, 30 * 96
GEN_END = dt.datetime(2024, 1, 30, 23)


@register(
    "src4_generate_readings",
    f"""
SELECT site_id, CAST({GEN_STEPS} AS BIGINT) AS n_readings,
       printf('R-%08d', seq * {GEN_STEPS} + 1) AS first_id, printf('R-%08d', (seq + 1) * {GEN_STEPS}) AS last_id,
       CAST({GEN_STEPS} AS BIGINT) AS n_instants,
       TIMESTAMP '{GEN_END}' - INTERVAL {15 * (GEN_STEPS - 1)} MINUTE AS first_reading,
       TIMESTAMP '{GEN_END}' AS last_reading,
       CAST(0 AS BIGINT) AS out_of_range
FROM (SELECT site_id, CAST(row_number() OVER (ORDER BY site_id) - 1 AS BIGINT) AS seq FROM sites)
""",
)
def src4_generate_readings(spark, sf_dir):
    """Readings generated for every driver site (30 days), checked per site against the formula's bounds."""
    sites = adapter.sites(spark, sf_dir)
    # what the bounds need is worked out once for each site and comes along with the readings
    lo, hi = generate.base_range(F.col("site_type"))
    sites = sites.withColumns({"base_lo": lo, "base_hi": hi})
    gen = generate.generate_readings(spark, sites, GEN_END, days=GEN_DAYS, carry=("base_lo", "base_hi", "voltage_nominal"))
    bad = ~generate.in_range(F.col("base_lo"), F.col("base_hi"), F.col("voltage_nominal"))
    number = F.expr("CAST(substr(reading_id, 3) AS BIGINT)")
    per_site = gen.groupBy("site_id").agg(
        F.count(F.lit(1)).alias("n_readings"),
        # numbers, not texts: their minima can be kept in a hash aggregate
        F.min(number).alias("first_number"),
        F.max(number).alias("last_number"),
        ((F.unix_micros(F.max("reading_timestamp")) - F.unix_micros(F.min("reading_timestamp"))) / F.lit(900_000_000) + 1)
        .cast("long").alias("n_instants"),
        F.min("reading_timestamp").alias("first_reading"),
        F.max("reading_timestamp").alias("last_reading"),
        F.count_if(bad).alias("out_of_range"),
    )
    ids = {"first_id": reading_id("first_number"), "last_id": reading_id("last_number")}
    return per_site.withColumns(ids).drop("first_number", "last_number")


@register("lim1_preview_membership", "SELECT CAST(5 AS BIGINT) AS n_rows, CAST(5 AS BIGINT) AS n_found")
def lim1_preview_membership(spark, sf_dir):
    """Which rows a preview shows is open; how many, and that they are readings, isn't."""
    readings = adapter.meter_readings(spark, sf_dir)
    shown = topk.preview(readings, 5).select("reading_id").withColumn("shown", F.lit(True))
    found = readings.select("reading_id").join(shown, "reading_id")
    return found.agg(F.count("shown").alias("n_rows"), F.countDistinct("reading_id").alias("n_found"))


@register("src7_row_count", "SELECT COUNT(*) AS row_count FROM meter_readings")
def src7_row_count(spark, sf_dir):
    return adapter.meter_readings(spark, sf_dir).agg(F.count(F.lit(1)).alias("row_count"))


@register(
    "dq5_verify_seed",
    """
SELECT t.table_name, t.row_count, e.expected_rows, COALESCE(t.row_count = e.expected_rows, FALSE) AS ok
FROM (SELECT 'regions' AS table_name, COUNT(*) AS row_count FROM regions
      UNION ALL SELECT 'business_units', COUNT(*) FROM business_units
      UNION ALL SELECT 'sites', COUNT(*) FROM sites
      UNION ALL SELECT 'meter_readings', COUNT(*) FROM meter_readings) t
LEFT JOIN (SELECT 'regions' AS table_name, CAST(5 AS BIGINT) AS expected_rows
           UNION ALL SELECT 'business_units', 5) e ON t.table_name = e.table_name
""",
)
def dq5_verify_seed(spark, sf_dir):
    return quality.verify_seed(tables.row_count_audit(star(spark, sf_dir)), {"regions": 5, "business_units": 5})


@register(
    "scl7_age_days",
    "SELECT reading_id, CAST(floor(epoch_us(TIMESTAMP '2024-01-30 00:00:00' - reading_timestamp) / 86400000000) AS BIGINT) "
    "AS age_days FROM meter_readings",
)
def scl7_age_days(spark, sf_dir):
    as_of = F.timestamp_micros(F.lit(1_706_572_800_000_000))  # 2024-01-30 00:00 UTC
    r = adapter.meter_readings(spark, sf_dir)
    return r.select("reading_id", whole_days_between(as_of, "reading_timestamp").cast("long").alias("age_days"))


@register("scl8_reading_id", "SELECT event_id, printf('R-%08d', event_id) AS padded_id FROM events")
def scl8_reading_id(spark, sf_dir):
    events = adapter.read_table(spark, sf_dir, "events")
    return events.select("event_id", reading_id("event_id").alias("padded_id"))


@register("lim1_preview")
def lim1_preview(spark, sf_dir):
    return topk.preview(adapter.meter_readings(spark, sf_dir), 5)


@register(
    "set1_row_count_audit",
    """
SELECT 'regions' AS table_name, COUNT(*) AS row_count FROM regions
UNION ALL SELECT 'business_units', COUNT(*) FROM business_units
UNION ALL SELECT 'sites', COUNT(*) FROM sites
UNION ALL SELECT 'meter_readings', COUNT(*) FROM meter_readings
""",
)
def set1_row_count_audit(spark, sf_dir):
    return tables.row_count_audit(star(spark, sf_dir))


@register("flt1_drop_errors", "SELECT * FROM meter_readings WHERE status <> 'error'")
def flt1_drop_errors(spark, sf_dir):
    return filters.drop_errors(adapter.meter_readings(spark, sf_dir))


@register(
    "dq1_expect_or_drop",
    "SELECT * FROM meter_readings WHERE status <> 'error' AND COALESCE(kwh_consumed >= 0, FALSE)",
)
def dq1_expect_or_drop(spark, sf_dir):
    return pipeline.clean_readings(adapter.meter_readings(spark, sf_dir))


@register(
    "dq3_expectation_metrics",
    """
SELECT 'non_negative_kwh' AS rule, 'drop' AS action,
       CAST(COUNT_IF(COALESCE(kwh_consumed >= 0, FALSE)) AS BIGINT) AS passed,
       COUNT(*) - CAST(COUNT_IF(COALESCE(kwh_consumed >= 0, FALSE)) AS BIGINT) AS failed
FROM silver_unchecked
UNION ALL
SELECT 'voltage_in_range', 'warn',
       CAST(COUNT_IF(COALESCE(voltage BETWEEN 100 AND 600, FALSE)) AS BIGINT),
       COUNT(*) - CAST(COUNT_IF(COALESCE(voltage BETWEEN 100 AND 600, FALSE)) AS BIGINT)
FROM silver_unchecked
""",
)
def dq3_expectation_metrics(spark, sf_dir):
    # the rules look at reading columns only, so the dimensions needn't be joined
    rows = filters.drop_errors(adapter.meter_readings(spark, sf_dir))
    return quality.expectation_metrics(rows, quality.silver_rules())


@register(
    "dq_dimension_guard",
    """
SELECT 'duplicate_key' AS guard, 'regions' AS table_name, region_id AS key_value, COUNT(*) AS n_rows
FROM regions GROUP BY region_id HAVING COUNT(*) > 1
UNION ALL
SELECT 'duplicate_key', 'business_units', business_unit_id, COUNT(*)
FROM business_units GROUP BY business_unit_id HAVING COUNT(*) > 1
UNION ALL
SELECT 'duplicate_key', 'sites', site_id, COUNT(*) FROM sites GROUP BY site_id HAVING COUNT(*) > 1
UNION ALL
SELECT 'orphan_readings', 'meter_readings', CAST(NULL AS VARCHAR), COUNT(*)
FROM meter_readings m WHERE NOT EXISTS (SELECT 1 FROM sites s WHERE s.site_id = m.site_id)
""",
)
def dq_dimension_guard(spark, sf_dir):
    return quality.dimension_guard(star(spark, sf_dir))


@register("prj1_site_dim", "SELECT * FROM site_dim")
def prj1_site_dim(spark, sf_dir):
    t = star(spark, sf_dir)
    return joins.site_dim(t["sites"], t["regions"], t["business_units"])


@register(
    "join3_enrich",
    "SELECT m.*, d.* EXCLUDE (site_id) FROM meter_readings m LEFT JOIN site_dim d ON m.site_id = d.site_id",
)
def join3_enrich(spark, sf_dir):
    t = star(spark, sf_dir)
    dim = joins.site_dim(t["sites"], t["regions"], t["business_units"])
    return joins.enrich(t["meter_readings"], dim)


@register(
    "prj4_with_reading_date",
    "SELECT reading_id, reading_timestamp, CAST(reading_timestamp AS DATE) AS reading_date FROM meter_readings",
)
def prj4_with_reading_date(spark, sf_dir):
    r = adapter.meter_readings(spark, sf_dir)
    return r.select("reading_id", "reading_timestamp", utc_date("reading_timestamp").alias("reading_date"))


@register("cmp1_silver", "SELECT * FROM silver")
def cmp1_silver(spark, sf_dir):
    t = star(spark, sf_dir)
    return pipeline.silver(t["meter_readings"], t["sites"], t["regions"], t["business_units"])


@register(
    "agg1_daily",
    """
SELECT site_id, site_type, business_unit_id, business_unit_name, region_id, region_name, reading_date,
       CAST(total_cents AS DOUBLE) / 100.0::DOUBLE AS total_kwh, peak_kw, avg_voltage, warning_count
FROM daily
""",
)
def agg1_daily(spark, sf_dir):
    t = star(spark, sf_dir)
    silver = pipeline.silver(t["meter_readings"], t["sites"], t["regions"], t["business_units"])
    return pipeline.daily(silver).drop("total_cents")


@register("cmp2_gold", "SELECT * FROM gold")
def cmp2_gold(spark, sf_dir):
    return gold_of(spark, sf_dir)


@register("cmp2_gold_from_silver", "SELECT * FROM gold")
def cmp2_gold_from_silver(spark, sf_dir):
    """The reference-shaped path: gold from the 7-key roll-up of silver."""
    t = star(spark, sf_dir)
    silver = pipeline.silver(t["meter_readings"], t["sites"], t["regions"], t["business_units"])
    return pipeline.gold(silver)


@register("cmp2_gold_from_states", "SELECT * FROM gold")
def cmp2_gold_from_states(spark, sf_dir):
    """Gold from two periods' daily rows, their sites' n, S and Q added up (what the incremental tables do)."""
    t = star(spark, sf_dir)
    cut = AS_OF - dt.timedelta(days=14)
    early = adapter.meter_readings(spark, sf_dir, until=cut - dt.timedelta(days=1))
    parts = [pipeline.daily_by_site(r) for r in (early, adapter.meter_readings(spark, sf_dir, since=cut))]
    return incremental.merge_gold(parts, t["sites"], t["regions"], t["business_units"])


@register(
    "win1_win2_site_baseline",
    "SELECT DISTINCT site_id, site_mean_kwh, site_stddev_kwh FROM gold",
)
def win1_win2_site_baseline(spark, sf_dir):
    return gold_of(spark, sf_dir).select("site_id", "site_mean_kwh", "site_stddev_kwh").distinct()


@register("win3_anomaly_flag", "SELECT site_id, reading_date, total_kwh, anomaly_flag FROM gold")
def win3_anomaly_flag(spark, sf_dir):
    return gold_of(spark, sf_dir).select("site_id", "reading_date", "total_kwh", "anomaly_flag")


@register("win4_deviation", "SELECT site_id, reading_date, deviation_pct FROM gold")
def win4_deviation(spark, sf_dir):
    return gold_of(spark, sf_dir).select("site_id", "reading_date", "deviation_pct")


@register(
    "agg2_gold_audit",
    """
SELECT COUNT(*) AS total_rows, CAST(COUNT_IF(anomaly_flag) AS BIGINT) AS anomaly_rows,
       COUNT(DISTINCT site_id) AS sites_covered, MIN(reading_date) AS first_date,
       MAX(reading_date) AS last_date
FROM gold
""",
)
def agg2_gold_audit(spark, sf_dir):
    return A.gold_audit(gold_of(spark, sf_dir))


@register(
    "agg3_reading_span",
    """
SELECT COUNT(*) AS row_count, MIN(reading_timestamp) AS first_reading, MAX(reading_timestamp) AS last_reading
FROM meter_readings
""",
)
def agg3_reading_span(spark, sf_dir):
    return A.reading_span(adapter.meter_readings(spark, sf_dir))


# ---------------------------------------------------------------------------
# Filters
# ---------------------------------------------------------------------------


@register("flt2_anomalies", "SELECT * FROM gold WHERE anomaly_flag")
def flt2_anomalies(spark, sf_dir):
    return filters.anomalies(gold_of(spark, sf_dir))


@register("flt3_since_7d", f"SELECT * FROM gold WHERE reading_date >= {_d(7)}")
def flt3_since_7d(spark, sf_dir):
    return filters.since(gold_of(spark, sf_dir), AS_OF, 7)


@register("flt4_between_dates", f"SELECT * FROM gold WHERE reading_date BETWEEN {_d(14)} AND {_d(0)}")
def flt4_between_dates(spark, sf_dir):
    start, end = filters.default_range(AS_OF, 14)
    return filters.between_dates(gold_of(spark, sf_dir), start, end)


@register("flt5_of_types", "SELECT * FROM gold WHERE site_type IN ('factory', 'data_center')")
def flt5_of_types(spark, sf_dir):
    return filters.of_types(gold_of(spark, sf_dir), TYPES)


@register("flt5_of_types_empty", "SELECT * FROM gold")
def flt5_of_types_empty(spark, sf_dir):
    return filters.of_types(gold_of(spark, sf_dir), [])


@register("flt6_triage_window_yesterday", f"SELECT * FROM gold WHERE reading_date = {_d(1)}")
def flt6_triage_window_yesterday(spark, sf_dir):
    return filters.in_window(gold_of(spark, sf_dir), filters.triage_window(AS_OF, "yesterday"))


@register("flt6_triage_window_last3", f"SELECT * FROM gold WHERE reading_date BETWEEN {_d(3)} AND {_d(0)}")
def flt6_triage_window_last3(spark, sf_dir):
    return filters.in_window(gold_of(spark, sf_dir), filters.triage_window(AS_OF, "last_days", 3))


@register(
    "flt6_triage_window_default",
    f"SELECT * FROM gold WHERE reading_date BETWEEN {_d(7)} AND {_d(0)}",
)
def flt6_triage_window_default(spark, sf_dir):
    return filters.in_window(gold_of(spark, sf_dir), filters.triage_window(AS_OF))


@register(
    "flt7_in_month",
    "SELECT * FROM gold WHERE reading_date >= DATE '2024-01-01' AND reading_date < DATE '2024-02-01'",
)
def flt7_in_month(spark, sf_dir):
    return filters.in_month(gold_of(spark, sf_dir), MONTH)


@register("flt8_for_site", f"SELECT * FROM gold WHERE site_id = '{ONE_SITE}'")
def flt8_for_site(spark, sf_dir):
    return filters.for_site(gold_of(spark, sf_dir), ONE_SITE)


@register("prj5_site_types", "SELECT DISTINCT site_type FROM gold")
def prj5_site_types(spark, sf_dir):
    return questions.site_types(gold_of(spark, sf_dir))


# ---------------------------------------------------------------------------
# Joins
# ---------------------------------------------------------------------------


@register(
    "join4_with_site_details",
    "SELECT g.*, s.site_name, s.city, s.state, s.square_footage FROM gold g JOIN sites s ON g.site_id = s.site_id",
)
def join4_with_site_details(spark, sf_dir):
    g, sites = gold_sites(spark, sf_dir)
    return joins.with_site_details(g, sites, ["site_name", "city", "state", "square_footage"])


@register(
    "join5_gold_regions",
    "SELECT g.*, r.timezone FROM gold g JOIN regions r ON g.region_id = r.region_id",
)
def join5_gold_regions(spark, sf_dir):
    t = star(spark, sf_dir)
    return joins.join_related(gold_of(spark, sf_dir), "daily_site_consumption", "regions", t["regions"])


@register(
    "join5_sites_business_units",
    "SELECT s.*, b.business_unit_name, b.description FROM sites s JOIN business_units b "
    "ON s.business_unit_id = b.business_unit_id",
)
def join5_sites_business_units(spark, sf_dir):
    t = star(spark, sf_dir)
    return joins.join_related(t["sites"], "sites", "business_units", t["business_units"])


@register(
    "join5_sites_regions",
    "SELECT s.*, r.region_name, r.timezone FROM sites s JOIN regions r ON s.region_id = r.region_id",
)
def join5_sites_regions(spark, sf_dir):
    t = star(spark, sf_dir)
    return joins.join_related(t["sites"], "sites", "regions", t["regions"])


@register(
    "join5_gold_sites",
    "SELECT g.*, s.site_name, s.city, s.state, s.square_footage, s.installation_date, s.voltage_nominal "
    "FROM gold g JOIN sites s ON g.site_id = s.site_id",
)
def join5_gold_sites(spark, sf_dir):
    t = star(spark, sf_dir)
    return joins.join_related(pipeline.build(t), "daily_site_consumption", "sites", t["sites"])


@register(
    "join5_gold_business_units",
    "SELECT g.*, b.description FROM gold g JOIN business_units b ON g.business_unit_id = b.business_unit_id",
)
def join5_gold_business_units(spark, sf_dir):
    t = star(spark, sf_dir)
    return joins.join_related(pipeline.build(t), "daily_site_consumption", "business_units", t["business_units"])


STATUS_COUNTS = """
status_counts AS (
  SELECT site_id, CAST(reading_timestamp AS DATE) AS reading_date,
         CAST(COUNT_IF(status = 'warning') AS BIGINT) AS warning_readings,
         CAST(COUNT_IF(status = 'error') AS BIGINT) AS error_readings
  FROM meter_readings GROUP BY ALL
)"""


@register(
    "join6_meter_health",
    f"""
, {STATUS_COUNTS.strip()}
SELECT g.site_id, g.reading_date, g.deviation_pct,
       COALESCE(c.warning_readings, 0) AS warning_readings, COALESCE(c.error_readings, 0) AS error_readings
FROM gold g LEFT JOIN status_counts c ON g.site_id = c.site_id AND g.reading_date = c.reading_date
WHERE g.anomaly_flag AND g.reading_date >= {_d(7)}
""",
)
def join6_meter_health(spark, sf_dir):
    anoms = filters.since(filters.anomalies(gold_of(spark, sf_dir)), AS_OF, 7).select(
        "site_id", "reading_date", "deviation_pct"
    )
    # the gold baseline needs all readings, the day's status counts only those of the days asked for
    recent = adapter.meter_readings(spark, sf_dir, since=AS_OF - dt.timedelta(days=7))
    return joins.meter_health(anoms, A.status_counts(recent))


INTENSITY = f"""
, st AS (
  SELECT site_id, COUNT({CENTS}) AS n, SUM({CENTS}) AS s FROM gold GROUP BY site_id
),
per AS (
  SELECT g.site_id, si.site_name, g.business_unit_name, si.square_footage,
         SUM(CAST(floor(g.total_kwh * 100 + 0.5) AS BIGINT)) AS p, COUNT(*) AS d,
         ANY_VALUE(st.n) AS n, ANY_VALUE(st.s) AS s
  FROM gold g JOIN st ON g.site_id = st.site_id JOIN sites si ON g.site_id = si.site_id
  WHERE g.reading_date >= {_d(14)}
  GROUP BY g.site_id, si.site_name, g.business_unit_name, si.square_footage
),
intensity AS (
  SELECT site_id, site_name, business_unit_name, d AS days_in_period,
         CASE WHEN square_footage <> 0
              THEN CAST(p AS DOUBLE) / CAST(CAST(square_footage AS BIGINT) * d * 100 AS DOUBLE) END
           AS avg_kwh_per_sqft,
         CASE WHEN s <> 0 THEN CAST((n * p - d * s) * 100 AS DOUBLE) / CAST(d * s AS DOUBLE) END
           AS avg_deviation_from_baseline_pct
  FROM per
)
"""


@register(
    "join7_warnings_for_top_sites",
    INTENSITY
    + f"""
, top3 AS (SELECT * FROM intensity ORDER BY avg_kwh_per_sqft DESC NULLS LAST, site_id LIMIT 3)
SELECT m.site_id, CAST(COUNT_IF(m.status = 'warning') AS BIGINT) AS warning_readings
FROM meter_readings m
WHERE m.site_id IN (SELECT site_id FROM top3) AND CAST(m.reading_timestamp AS DATE) >= {_d(14)}
GROUP BY m.site_id
""",
)
def join7_warnings_for_top_sites(spark, sf_dir):
    t = star(spark, sf_dir)
    ranked = topk.top_sites_intensity_detail(gold_of(spark, sf_dir), t["sites"], AS_OF, 14, 3)
    recent = adapter.meter_readings(spark, sf_dir, since=AS_OF - dt.timedelta(days=14))
    rows = joins.warnings_for(ranked, recent)
    return rows.groupBy("site_id").agg(F.count_if(F.col("status") == "warning").alias("warning_readings"))


@register(
    "join8_explore_view",
    """
SELECT m.*, s.site_name, s.site_type, s.square_footage, s.business_unit_id, b.business_unit_name,
       s.region_id, r.region_name, r.timezone
FROM meter_readings m
LEFT JOIN sites s ON m.site_id = s.site_id
LEFT JOIN regions r ON s.region_id = r.region_id
LEFT JOIN business_units b ON s.business_unit_id = b.business_unit_id
""",
)
def join8_explore_view(spark, sf_dir):
    t = star(spark, sf_dir)
    return joins.explore_view(t["meter_readings"], t["sites"], t["regions"], t["business_units"])


# ---------------------------------------------------------------------------
# Aggregations
# ---------------------------------------------------------------------------


@register(
    "agg4_anomalies_by_bu",
    f"""
SELECT business_unit_name, COUNT(*) AS anomaly_count FROM gold
WHERE anomaly_flag AND reading_date >= {_d(7)}
GROUP BY business_unit_name
""",
)
def agg4_anomalies_by_bu(spark, sf_dir):
    return A.anomalies_by_bu(gold_of(spark, sf_dir), AS_OF, 7)


@register(
    "agg5_kwh_by_site",
    f"""
SELECT s.site_name, g.site_type, g.business_unit_name,
       CAST(SUM(CAST(floor(g.total_kwh * 100 + 0.5) AS BIGINT)) AS DOUBLE) / 100.0::DOUBLE AS total_kwh_14d
FROM gold g JOIN sites s ON g.site_id = s.site_id
WHERE g.reading_date >= {_d(14)}
GROUP BY s.site_name, g.site_type, g.business_unit_name
""",
)
def agg5_kwh_by_site(spark, sf_dir):
    g, sites = gold_sites(spark, sf_dir)
    return A.kwh_by_site(g, sites, AS_OF, 14)


DETAILS = f"""
, details AS (
  SELECT g.reading_date, g.site_id, s.site_name, g.site_type, g.business_unit_name, g.region_name,
         s.city, s.state, g.total_kwh, g.peak_kw, g.deviation_pct, g.warning_count
  FROM gold g JOIN sites s ON g.site_id = s.site_id
  WHERE g.anomaly_flag AND g.reading_date BETWEEN {_d(14)} AND {_d(0)}
)
"""


def _details(spark, sf_dir, types=None):
    g, sites = gold_sites(spark, sf_dir)
    start, end = filters.default_range(AS_OF, 14)
    return questions.anomaly_details(g, sites, start, end, types)


@register("cmp3_anomaly_details", DETAILS + "SELECT * FROM details")
def cmp3_anomaly_details(spark, sf_dir):
    return _details(spark, sf_dir)


@register(
    "cmp3_anomaly_details_types",
    DETAILS + "SELECT * FROM details WHERE site_type IN ('factory', 'data_center')",
)
def cmp3_anomaly_details_types(spark, sf_dir):
    return _details(spark, sf_dir, TYPES)


@register(
    "agg6_anomalies_per_day",
    DETAILS + "SELECT reading_date, COUNT(*) AS anomaly_count FROM details GROUP BY reading_date",
)
def agg6_anomalies_per_day(spark, sf_dir):
    return A.anomalies_per_day(_details(spark, sf_dir))


@register(
    "agg6_anomalies_per_day_30d",
    f"SELECT reading_date, COUNT(*) AS anomaly_count FROM gold WHERE anomaly_flag AND reading_date >= {_d(30)} "
    "GROUP BY reading_date",
)
def agg6_anomalies_per_day_30d(spark, sf_dir):
    return A.anomalies_per_day(filters.since(filters.anomalies(gold_of(spark, sf_dir)), AS_OF, 30))


@register(
    "agg7_anomalies_bu_type",
    "SELECT business_unit_name, site_type, COUNT(*) AS anomaly_count FROM gold WHERE anomaly_flag GROUP BY ALL",
)
def agg7_anomalies_bu_type(spark, sf_dir):
    return A.anomalies_bu_type(filters.anomalies(gold_of(spark, sf_dir)))


@register(
    "agg8_anomaly_kpi",
    f"SELECT COUNT(*) AS anomalies_last_7d FROM gold WHERE anomaly_flag AND reading_date >= {_d(7)}",
)
def agg8_anomaly_kpi(spark, sf_dir):
    return A.anomaly_kpi(gold_of(spark, sf_dir), AS_OF, 7)


@register(
    "agg9_anomaly_headline",
    DETAILS
    + """
SELECT COUNT(*) AS anomalies_in_range, COUNT(DISTINCT site_id) AS distinct_sites_flagged,
       MAX(deviation_pct) AS highest_deviation_pct,
       COALESCE(CAST(CAST(round_even(MAX(deviation_pct), 0) AS BIGINT) AS VARCHAR) || '%', '—')
         AS highest_deviation_label
FROM details
""",
)
def agg9_anomaly_headline(spark, sf_dir):
    return A.anomaly_headline(_details(spark, sf_dir))


@register(
    "agg10_kwh_by_type_day",
    f"SELECT reading_date, site_type, {KWH_TOTAL} AS total_kwh FROM gold GROUP BY reading_date, site_type",
)
def agg10_kwh_by_type_day(spark, sf_dir):
    return A.kwh_by_type_day(gold_of(spark, sf_dir))


@register(
    "agg11_site_month_kwh",
    f"""
SELECT business_unit_name, site_id, {KWH_TOTAL} AS month_kwh FROM gold
WHERE reading_date >= DATE '2024-01-01' AND reading_date < DATE '2024-02-01'
GROUP BY business_unit_name, site_id
""",
)
def agg11_site_month_kwh(spark, sf_dir):
    return A.site_month_kwh(gold_of(spark, sf_dir), MONTH)


@register("agg12_status_counts", f", {STATUS_COUNTS.strip()} SELECT * FROM status_counts")
def agg12_status_counts(spark, sf_dir):
    return A.status_counts(adapter.meter_readings(spark, sf_dir))


TRIAGE_ANOMS = f"""
, tri AS (
  SELECT * FROM gold WHERE anomaly_flag AND reading_date BETWEEN {_d(7)} AND {_d(0)}
)
"""


@register(
    "agg13_triage_summary",
    TRIAGE_ANOMS + "SELECT COUNT(*) AS anomalies_found, COUNT(DISTINCT site_id) AS sites_affected FROM tri",
)
def agg13_triage_summary(spark, sf_dir):
    return A.triage_summary(filters.in_window(filters.anomalies(gold_of(spark, sf_dir)), filters.triage_window(AS_OF)))


@register(
    "agg13_triage_by_bu",
    TRIAGE_ANOMS + "SELECT business_unit_name, COUNT(*) AS anomaly_count FROM tri GROUP BY business_unit_name",
)
def agg13_triage_by_bu(spark, sf_dir):
    return A.triage_by_bu(filters.in_window(filters.anomalies(gold_of(spark, sf_dir)), filters.triage_window(AS_OF)))


def _double(exact: str) -> str:
    """An exact number as the nearest double (a plain cast of a wide decimal isn't always)."""
    return f"CAST(CAST({exact} AS VARCHAR) AS DOUBLE)"


def _spread(x: str, n: str) -> str:
    """Population spread of whole billionths ``x`` (HUGEINT): exact integers up to one root and one division."""
    exact = f"CAST({n} AS HUGEINT) * SUM({x} * {x}) - SUM({x}) * SUM({x})"
    return f"sqrt({_double(exact)}) / (CAST({n} AS DOUBLE) * 1e9::DOUBLE)"


def _nano(v: str) -> str:
    return f"(CAST(floor({v}) AS HUGEINT) * 1000000000 + CAST(floor(({v} - floor({v})) * 1e9::DOUBLE + 0.5::DOUBLE) AS HUGEINT))"


def _temps_sql(source: str) -> str:
    return f"""
temp_rows AS (
  SELECT site_id, CAST(reading_timestamp AS DATE) AS reading_date, temperature_c,
         {_nano("temperature_c")} - min({_nano("temperature_c")}) OVER (PARTITION BY site_id) AS above
  FROM {source} WHERE status <> 'error'
),
temp_day AS (
  SELECT site_id, reading_date, {_double("SUM(CAST(temperature_c AS DECIMAL(18,9)))")} / COUNT(temperature_c) AS avg_temp_c,
         MAX(temperature_c) AS max_temp_c
  FROM temp_rows GROUP BY site_id, reading_date
),
temp_site AS (
  SELECT site_id, {_double("SUM(CAST(temperature_c AS DECIMAL(18,9)))")} / COUNT(temperature_c) AS site_mean_temp_c,
         {_spread("above", "COUNT(temperature_c)")} AS site_stddev_temp_c
  FROM temp_rows GROUP BY site_id
),
temps AS (
  SELECT d.site_id, d.reading_date, d.avg_temp_c, d.max_temp_c, t.site_mean_temp_c, t.site_stddev_temp_c,
         COALESCE(d.avg_temp_c - t.site_mean_temp_c > t.site_stddev_temp_c, FALSE) AS temp_elevated
  FROM temp_day d JOIN temp_site t ON d.site_id = t.site_id
)"""


@register("agg14_temperature_evidence", ", " + _temps_sql("meter_readings").strip() + " SELECT * FROM temps")
def agg14_temperature_evidence(spark, sf_dir):
    return A.temperature_evidence(filters.drop_errors(adapter.meter_readings(spark, sf_dir)))


@register(
    "agg15_hourly_profile_utc",
    """
SELECT s.site_type, CAST(hour(m.reading_timestamp) AS INTEGER) AS utc_hour,
       COUNT(m.kwh_consumed) AS n_readings,
       CAST(CAST(SUM(CAST(m.kwh_consumed AS DECIMAL(18,9))) AS VARCHAR) AS DOUBLE) / COUNT(m.kwh_consumed) AS mean_kwh
FROM meter_readings m JOIN sites s ON m.site_id = s.site_id
GROUP BY ALL
""",
)
def agg15_hourly_profile_utc(spark, sf_dir):
    t = star(spark, sf_dir)
    return A.hourly_profile(t["meter_readings"], t["sites"])


@register(
    "agg15_hourly_profile_local",
    """
SELECT s.site_type, CAST(hour(timezone(r.timezone, timezone('UTC', m.reading_timestamp))) AS INTEGER) AS local_hour,
       COUNT(m.kwh_consumed) AS n_readings,
       CAST(CAST(SUM(CAST(m.kwh_consumed AS DECIMAL(18,9))) AS VARCHAR) AS DOUBLE) / COUNT(m.kwh_consumed) AS mean_kwh
FROM meter_readings m JOIN sites s ON m.site_id = s.site_id LEFT JOIN regions r ON s.region_id = r.region_id
GROUP BY ALL
""",
)
def agg15_hourly_profile_local(spark, sf_dir):
    t = star(spark, sf_dir)
    return A.hourly_profile(t["meter_readings"], t["sites"], local=True, regions=t["regions"])


@register(
    "agg16_status_share",
    """
SELECT status, COUNT(*) AS n_readings,
       CAST(COUNT(*) AS DOUBLE) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE) AS share
FROM meter_readings GROUP BY status
""",
)
def agg16_status_share(spark, sf_dir):
    return A.status_share(adapter.meter_readings(spark, sf_dir))


def _profile_sql(col: str) -> str:
    n = f"COUNT({col})"
    mean = f"{_double(f'SUM(CAST({col} AS DECIMAL(18,9)))')} / {n}"
    return f"""
SELECT '{col}' AS column_name, {n} AS non_null, CAST(COUNT_IF({col} IS NULL) AS BIGINT) AS null_count,
       CAST(MIN({col}) AS DOUBLE) AS min_value, CAST(MAX({col}) AS DOUBLE) AS max_value,
       CASE WHEN {n} > 0 THEN {mean} END AS mean_value,
       CASE WHEN {n} > 0 THEN {_spread("above", n)} END AS stddev_value
FROM (SELECT {col}, {_nano(col)} - min({_nano(col)}) OVER () AS above FROM meter_readings)"""


@register("agg17_profile", "\nUNION ALL".join(_profile_sql(c) for c in A.PROFILE_COLUMNS))
def agg17_profile(spark, sf_dir):
    return A.profile(adapter.meter_readings(spark, sf_dir))


# Readings as they come from broken meters: a few are NaN, infinite or absurdly large.
NAN, SQL_NAN = "double('NaN')", "'nan'::DOUBLE"
_ODD_KWH = """CASE WHEN CAST({id} AS BIGINT) % 2503 = 7 THEN {nan} WHEN CAST({id} AS BIGINT) % 2003 = 11 THEN {inf}
     WHEN CAST({id} AS BIGINT) % 499 = 3 THEN 1e18 WHEN CAST({id} AS BIGINT) % 997 = 5 THEN 5e12 ELSE kwh_consumed END"""
_FINITE = ("total_kwh", "site_mean_kwh", "site_stddev_kwh", "deviation_pct")


@register(
    "agg1_odd_readings",
    f"""
, odd AS (
  SELECT site_id, CAST(reading_timestamp AS DATE) AS reading_date,
         {_ODD_KWH.format(id="reading_id", nan=SQL_NAN, inf="'inf'::DOUBLE")} AS kwh
  FROM meter_readings WHERE status <> 'error'
),
odd_day AS (
  SELECT site_id, reading_date, SUM(CASE WHEN abs(kwh) < 2147483648 THEN CAST(kwh AS DECIMAL(28,9)) END) AS near,
         SUM(CASE WHEN abs(kwh) < 2147483648 THEN NULL ELSE kwh END) AS far
  FROM (SELECT site_id, reading_date, kwh FROM odd WHERE kwh >= 0) GROUP BY ALL
),
odd_total AS (
  SELECT site_id, reading_date,
         CASE WHEN far IS NULL THEN {_double("ROUND(near, 2)")}
              WHEN abs(far) < 1e15 THEN ROUND(far + COALESCE({_double("near")}, 0), 2)
              ELSE far + COALESCE({_double("near")}, 0) END AS total
  FROM odd_day
),
odd_site AS (
  SELECT *, BOOL_AND(isfinite(total)) OVER (PARTITION BY site_id) AS fine,
         SUM(CASE WHEN isfinite(total) THEN 0 ELSE total END) OVER (PARTITION BY site_id) AS beyond,
         MAX(CASE WHEN isfinite(total) THEN total END) OVER (PARTITION BY site_id) AS most
  FROM odd_total
),
odd_unit AS (
  SELECT *, CASE WHEN most >= 1e12 THEN pow(2::DOUBLE, floor(log2(most)) - 45) END AS unit FROM odd_site
),
odd_count AS (
  SELECT *, CASE WHEN NOT fine THEN NULL WHEN unit IS NULL THEN CAST(round(total * 100) AS HUGEINT)
                 ELSE CAST(round_even(total / unit, 0) AS HUGEINT) END AS t
  FROM odd_unit
),
odd_state AS (
  SELECT *, COUNT(t) OVER w AS n, SUM(t) OVER w AS s, SUM(t * t) OVER w AS q FROM odd_count WINDOW w AS (PARTITION BY site_id)
)
SELECT site_id, reading_date,
       CASE WHEN isnan(total) THEN 'nan' WHEN isinf(total) THEN 'inf' ELSE 'finite' END AS total_kwh_kind,
       CASE WHEN isnan(beyond) THEN 'nan' WHEN isinf(beyond) THEN 'inf' ELSE 'finite' END AS site_mean_kwh_kind,
       CASE WHEN fine THEN 'finite' ELSE 'nan' END AS site_stddev_kwh_kind,
       CASE WHEN fine THEN 'finite' ELSE 'nan' END AS deviation_pct_kind,
       CASE WHEN isfinite(total) THEN total END AS total_kwh,
       CASE WHEN fine THEN CASE WHEN unit IS NULL THEN CAST(s AS DOUBLE) / CAST(n * 100 AS DOUBLE)
                                ELSE {_double("s")} / CAST(n AS DOUBLE) * unit END END AS site_mean_kwh,
       CASE WHEN fine THEN CASE WHEN unit IS NULL THEN sqrt({_double("n * q - s * s")}) / CAST(n * 100 AS DOUBLE)
                                ELSE sqrt({_double("n * q - s * s")}) / CAST(n AS DOUBLE) * unit END END AS site_stddev_kwh,
       CASE WHEN fine THEN CAST(floor((2 * (n * t - s) * 1000 + s) / (2 * s)) AS DOUBLE) / 10.0::DOUBLE END AS deviation_pct,
       COALESCE(fine AND n * t - s > 0 AND (n * t - s) * (n * t - s) > 4 * (n * q - s * s), FALSE) AS anomaly_flag
FROM odd_state
""",
)
def agg1_odd_readings(spark, sf_dir):
    """Gold from readings of which some are NaN, infinite or huge; numbers that aren't finite are named."""
    t = star(spark, sf_dir)
    odd = F.expr(_ODD_KWH.format(id="reading_id", nan=NAN, inf="double('Infinity')"))
    g = pipeline.build(t | {"meter_readings": t["meter_readings"].withColumn("kwh_consumed", odd)})
    kind = "CASE WHEN isnan({c}) THEN 'nan' WHEN abs({c}) = double('Infinity') THEN 'inf' ELSE 'finite' END"
    return g.selectExpr(
        "site_id", "reading_date", *[f"{kind.format(c=c)} AS {c}_kind" for c in _FINITE],
        *[f"CASE WHEN {kind.format(c=c)} = 'finite' THEN {c} END AS {c}" for c in _FINITE], "anomaly_flag",
    )


# Values of which a plain mean of squares loses the spread, and a column with NaN.
_WIDE = {
    "near_1e8": "1e8{d} + 0.001{d} * (CAST(reading_id AS BIGINT) % 2)",
    "near_1e12": "-1e12{d} + 3.0{d} + CAST(reading_id AS BIGINT) % 3",
    "straddling": "(CAST(reading_id AS BIGINT) % 2) * 2e-6{d} + 0.999999{d}",
    "huge": "CASE WHEN CAST(reading_id AS BIGINT) % 2 = 0 THEN 0.0{d} ELSE 1e150{d} END",
    "with_nan": "CASE WHEN CAST(reading_id AS BIGINT) % 499 = 3 THEN {nan} ELSE kwh_consumed END",
}


def _wide_sql(col: str) -> str:
    head = f"SELECT '{col}' AS column_name, COUNT({col}) AS non_null, "
    if col == "with_nan":
        return head + "TRUE AS is_nan, CAST(NULL AS DOUBLE) AS mean_value, CAST(NULL AS DOUBLE) AS stddev_value FROM wide"
    if col == "huge":
        half = "COUNT_IF(huge > 0) * 1e150::DOUBLE / COUNT(huge)"
        return head + (
            f"FALSE AS is_nan, round({half} / 1e147::DOUBLE, 3) * 1e147::DOUBLE AS mean_value, "
            "round(sqrt(COUNT_IF(huge > 0) * CAST(COUNT_IF(huge = 0) AS DOUBLE)) / COUNT(huge), 3) * 1e150::DOUBLE AS stddev_value "
            "FROM wide"
        )
    mean = f"{_double(f'SUM({_nano(col)})')} / COUNT({col}) / 1e9::DOUBLE"
    return head + f"FALSE AS is_nan, round({mean}, 2) AS mean_value, {_spread('above', f'COUNT({col})')} AS stddev_value FROM (SELECT {col}, {_nano(col)} - min({_nano(col)}) OVER () AS above FROM wide)"


@register(
    "agg17_wide_values",
    ", wide AS (SELECT "
    + ", ".join(f"{e.format(d='::DOUBLE', nan=SQL_NAN)} AS {c}" for c, e in _WIDE.items())
    + " FROM meter_readings) "
    + "\nUNION ALL\n".join(_wide_sql(c) for c in _WIDE),
)
def agg17_wide_values(spark, sf_dir):
    """The profile of columns whose values are large, far apart or NaN."""
    values = [f"{e.format(d='D', nan=NAN)} AS {c}" for c, e in _WIDE.items()]
    p = A.profile(adapter.meter_readings(spark, sf_dir).selectExpr(*values), tuple(_WIDE))
    return p.selectExpr(
        "column_name", "non_null", "isnan(mean_value) AS is_nan",
        "CASE WHEN isnan(mean_value) THEN NULL WHEN column_name = 'huge' THEN round(mean_value / 1e147D, 3) * 1e147D ELSE round(mean_value, 2) END AS mean_value",
        "CASE WHEN isnan(stddev_value) THEN NULL WHEN column_name = 'huge' THEN round(stddev_value / 1e150D, 3) * 1e150D "
        "ELSE stddev_value END AS stddev_value",
    )


def _by_dim_sql(dim: str) -> str:
    return (
        f"SELECT {dim}, {KWH_TOTAL} AS total_kwh, "
        f"CAST(SUM({CENTS}) AS DOUBLE) / CAST(COUNT(total_kwh) * 100 AS DOUBLE) AS mean_daily_kwh, "
        f"COUNT(*) AS site_days FROM gold GROUP BY {dim}"
    )


for _dim, _key in (
    ("site_type", "agg18_kwh_by_site_type"),
    ("business_unit_name", "agg18_kwh_by_business_unit"),
    ("region_name", "agg18_kwh_by_region"),
):

    def _mk(dim):
        return lambda spark, sf_dir: A.kwh_by_dimension(gold_of(spark, sf_dir), dim)

    register(_key, _by_dim_sql(_dim))(_mk(_dim))


# ---------------------------------------------------------------------------
# Windows, measures, top-k
# ---------------------------------------------------------------------------


@register(
    "win5_top_consumers",
    f"""
, pm AS (
  SELECT business_unit_name, site_id, {KWH_TOTAL} AS month_kwh FROM gold
  WHERE reading_date >= DATE '2024-01-01' AND reading_date < DATE '2024-02-01'
  GROUP BY business_unit_name, site_id
)
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY business_unit_name ORDER BY month_kwh DESC, site_id) AS INTEGER)
    AS rank
  FROM pm
) WHERE rank <= 3
""",
)
def win5_top_consumers(spark, sf_dir):
    return gold_of(spark, sf_dir).transform(windows.top_consumers_fn(MONTH, 3))


MSR2 = f"""
, st2 AS (SELECT site_id, COUNT({CENTS}) AS n, SUM({CENTS}) AS s FROM gold GROUP BY site_id),
msr AS (
  SELECT g.*, CASE WHEN st2.s <> 0
                   THEN CAST((st2.n * {CENTS.replace('total_kwh', 'g.total_kwh')} - st2.s) * 100 AS DOUBLE)
                        / CAST(st2.s AS DOUBLE) END AS deviation_from_baseline_pct
  FROM gold g JOIN st2 ON g.site_id IS NOT DISTINCT FROM st2.site_id
)
"""


@register(
    "win6_site_trend",
    MSR2
    + f"""
SELECT site_id, reading_date, total_kwh, site_mean_kwh, deviation_pct, deviation_from_baseline_pct, anomaly_flag
FROM msr WHERE site_id = '{ONE_SITE}'
""",
)
def win6_site_trend(spark, sf_dir):
    return windows.site_trend(gold_of(spark, sf_dir), ONE_SITE)


@register(
    "msr1_kwh_per_sqft",
    "SELECT g.site_id, g.reading_date, g.total_kwh / NULLIF(s.square_footage, 0) AS kwh_per_sqft "
    "FROM gold g JOIN sites s ON g.site_id = s.site_id",
)
def msr1_kwh_per_sqft(spark, sf_dir):
    g, sites = gold_sites(spark, sf_dir)
    return joins.with_site_details(g, sites, ["square_footage"]).select(
        "site_id", "reading_date", measures.kwh_per_sqft().alias("kwh_per_sqft")
    )


@register("msr2_deviation_from_baseline", MSR2 + "SELECT site_id, reading_date, deviation_from_baseline_pct FROM msr")
def msr2_deviation_from_baseline(spark, sf_dir):
    return measures.with_deviation_from_baseline(gold_of(spark, sf_dir)).select(
        "site_id", "reading_date", "deviation_from_baseline_pct"
    )


@register("msr3_is_anomaly", "SELECT site_id, reading_date, anomaly_flag = TRUE AS is_anomaly FROM gold")
def msr3_is_anomaly(spark, sf_dir):
    return gold_of(spark, sf_dir).select("site_id", "reading_date", measures.is_anomaly().alias("is_anomaly"))


@register(
    "msr4_measured",
    MSR2
    + """
SELECT m.*, s.site_name, m.total_kwh / NULLIF(s.square_footage, 0) AS kwh_per_sqft,
       m.anomaly_flag = TRUE AS is_anomaly
FROM msr m JOIN sites s ON m.site_id = s.site_id
""",
)
def msr4_measured(spark, sf_dir):
    g, sites = gold_sites(spark, sf_dir)
    return measures.measured(g, sites)


@register("msr5_ensure_deviation", "SELECT site_id, reading_date, deviation_pct FROM gold")
def msr5_ensure_deviation(spark, sf_dir):
    g = gold_of(spark, sf_dir).drop("deviation_pct")
    return measures.ensure_deviation(g).select("site_id", "reading_date", "deviation_pct")


@register(
    "srt1_anomaly_list",
    "SELECT * FROM gold WHERE anomaly_flag",
)
def srt1_anomaly_list(spark, sf_dir):
    return topk.anomaly_order(filters.anomalies(gold_of(spark, sf_dir)))


@register(
    "top1_top_sites_kwh",
    f"""
SELECT s.site_name, g.site_type, g.business_unit_name,
       CAST(SUM(CAST(floor(g.total_kwh * 100 + 0.5) AS BIGINT)) AS DOUBLE) / 100.0::DOUBLE AS total_kwh_14d
FROM gold g JOIN sites s ON g.site_id = s.site_id
WHERE g.reading_date >= {_d(14)}
GROUP BY s.site_name, g.site_type, g.business_unit_name
ORDER BY total_kwh_14d DESC NULLS LAST, s.site_name LIMIT 5
""",
)
def top1_top_sites_kwh(spark, sf_dir):
    g, sites = gold_sites(spark, sf_dir)
    return topk.top_sites_kwh(g, sites, AS_OF, 14, 5)


@register(
    "top2_top_sites_intensity",
    INTENSITY
    + """
SELECT site_id, site_name, days_in_period, avg_kwh_per_sqft FROM intensity
ORDER BY avg_kwh_per_sqft DESC NULLS LAST, site_id LIMIT 5
""",
)
def top2_top_sites_intensity(spark, sf_dir):
    g, sites = gold_sites(spark, sf_dir)
    return topk.top_sites_intensity(g, sites, AS_OF, 14, 5)


@register(
    "top3_top_sites_intensity_detail",
    INTENSITY + "SELECT * FROM intensity ORDER BY avg_kwh_per_sqft DESC NULLS LAST, site_id LIMIT 3",
)
def top3_top_sites_intensity_detail(spark, sf_dir):
    g, sites = gold_sites(spark, sf_dir)
    return topk.top_sites_intensity_detail(g, sites, AS_OF, 14, 3)


@register(
    "top4_top_deviation",
    "SELECT * FROM gold ORDER BY deviation_pct DESC NULLS LAST, site_id, reading_date LIMIT 10",
)
def top4_top_deviation(spark, sf_dir):
    return topk.top_deviation(gold_of(spark, sf_dir), 10)


TRIAGE_SQL = f"""
, win AS (
  SELECT * FROM gold WHERE anomaly_flag AND reading_date BETWEEN {_d(7)} AND {_d(0)}
),
det AS (
  SELECT w.*, s.site_name, s.city, s.state, s.square_footage FROM win w JOIN sites s ON w.site_id = s.site_id
),
flagged AS (SELECT * FROM meter_readings WHERE site_id IN (SELECT site_id FROM win)),
sc AS (
  SELECT site_id, CAST(reading_timestamp AS DATE) AS reading_date,
         CAST(COUNT_IF(status = 'warning') AS BIGINT) AS warning_readings, CAST(COUNT_IF(status = 'error') AS BIGINT) AS error_readings
  FROM flagged GROUP BY ALL
),
hb AS (
  SELECT *, COUNT(*) OVER (PARTITION BY site_id) AS issue_days,
         SUM(warning_readings + error_readings) OVER (PARTITION BY site_id) AS issue_total
  FROM sc
),
{_temps_sql("flagged").strip()},
triage AS (
  SELECT d.reading_date, d.site_id, d.site_name, d.city, d.state, d.site_type, d.business_unit_name,
         d.region_name, d.square_footage, d.total_kwh, d.site_mean_kwh, d.deviation_pct,
         COALESCE(hb.warning_readings, 0) AS warning_readings, COALESCE(hb.error_readings, 0) AS error_readings,
         t.avg_temp_c, COALESCE(t.temp_elevated, FALSE) AS temp_elevated,
         CASE WHEN COALESCE((COALESCE(hb.warning_readings, 0) + COALESCE(hb.error_readings, 0)) * hb.issue_days
                            > 2 * hb.issue_total, FALSE)
              THEN 'meter_issue' ELSE 'genuine' END AS cause_class
  FROM det d
  LEFT JOIN hb ON d.site_id = hb.site_id AND d.reading_date = hb.reading_date
  LEFT JOIN temps t ON d.site_id = t.site_id AND d.reading_date = t.reading_date
)
"""


def _triage(spark, sf_dir):
    t = star(spark, sf_dir)
    base = [t[n] for n in ("meter_readings", "sites", "regions", "business_units")]
    return triage.triage_readings(*base, filters.triage_window(AS_OF))


@register("cmp5_triage_of_gold", TRIAGE_SQL + "SELECT * FROM triage")
def cmp5_triage_of_gold(spark, sf_dir):
    """From a gold table and the readings of its flagged sites."""
    t = star(spark, sf_dir)
    return triage.triage(gold_of(spark, sf_dir), t["sites"], t["meter_readings"], filters.triage_window(AS_OF))


@register("cmp5_triage", TRIAGE_SQL + "SELECT * FROM triage")
def cmp5_triage(spark, sf_dir):
    return _triage(spark, sf_dir)


@register(
    "top5_triage_top",
    TRIAGE_SQL + "SELECT * FROM triage ORDER BY deviation_pct DESC NULLS LAST, site_id, reading_date LIMIT 3",
)
def top5_triage_top(spark, sf_dir):
    return topk.triage_top(_triage(spark, sf_dir), 3)


@register(
    "top6_top_sites_peak",
    f"""
SELECT site_id, site_type, business_unit_name, MAX(peak_kw) AS max_peak_kw FROM gold
WHERE reading_date >= {_d(14)}
GROUP BY site_id, site_type, business_unit_name
ORDER BY max_peak_kw DESC NULLS LAST, site_id LIMIT 5
""",
)
def top6_top_sites_peak(spark, sf_dir):
    return topk.top_sites_peak(gold_of(spark, sf_dir), AS_OF, 14, 5)


# ---------------------------------------------------------------------------
# Table function, forecast
# ---------------------------------------------------------------------------


@register(
    "udf1_get_site_anomalies",
    f"SELECT * FROM gold WHERE anomaly_flag AND reading_date >= {_d(14)}",
)
def udf1_get_site_anomalies(spark, sf_dir):
    """The SQL table function applied to every site (LATERAL over sites), past 14 days."""
    g, sites = gold_sites(spark, sf_dir)
    g.createOrReplaceTempView(sql_functions.GOLD_VIEW)
    sites.createOrReplaceTempView("sites")
    sql_functions.register_get_site_anomalies(spark)
    return spark.sql(
        f"""
        SELECT a.* FROM sites s, LATERAL get_site_anomalies(s.site_id, 14, DATE'{AS_OF.isoformat()}') a
        """
    )


@register(
    "udf1_one_site_anomalies",
    f"SELECT * FROM gold WHERE site_id = '{ONE_SITE}' AND anomaly_flag AND reading_date >= {_d(30)}",
)
def udf1_one_site_anomalies(spark, sf_dir):
    """The table function for one given site, by deviation descending."""
    gold_of(spark, sf_dir).createOrReplaceTempView(sql_functions.GOLD_VIEW)
    sql_functions.register_get_site_anomalies(spark)
    return spark.sql(
        "SELECT * FROM get_site_anomalies(:site, 30, DATE'" + AS_OF.isoformat() + "') ORDER BY deviation_pct DESC NULLS LAST, reading_date",
        args={"site": ONE_SITE},
    )


FORECAST_SQL = f"""
, fd AS (
  SELECT site_id, reading_date, CAST(reading_date - DATE '1970-01-01' AS BIGINT) AS day,
         {CENTS} AS y
  FROM gold WHERE total_kwh IS NOT NULL
),
fdw AS (SELECT *, CAST((day + 3) % 7 + 1 AS BIGINT) AS dow FROM fd),
fs AS (
  SELECT site_id, COUNT(y) AS n, MIN(reading_date) AS first_date, MAX(reading_date) AS last_date,
         SUM(day) AS sx, SUM(y) AS sy, SUM(day * y) AS sxy, SUM(day * day) AS sxx
  FROM fdw GROUP BY site_id
),
frel AS (
  SELECT *, CAST(first_date - DATE '1970-01-01' AS BIGINT) AS f0 FROM fs
),
frel2 AS (
  SELECT *, sx - n * f0 AS rx, sxx - 2 * f0 * sx + n * f0 * f0 AS rxx, sxy - f0 * sy AS rxy FROM frel
),
ffit AS (
  SELECT *, CASE WHEN n >= 2 AND (n * rxx - rx * rx) <> 0
                 THEN CAST(n * rxy - rx * sy AS DOUBLE) / CAST(n * rxx - rx * rx AS DOUBLE)
                 ELSE 0.0::DOUBLE END AS slope_c
  FROM frel2
),
ffit2 AS (
  SELECT *, (CAST(sy AS DOUBLE) - slope_c * CAST(rx AS DOUBLE)) / CAST(n AS DOUBLE) AS intercept_c FROM ffit
),
fwd AS (
  SELECT site_id, dow, COUNT(y) AS nd, SUM(day) AS sxd, SUM(y) AS syd FROM fdw GROUP BY site_id, dow
),
fgrid AS (
  SELECT f.*, CAST(w.d AS BIGINT) AS iso_weekday FROM ffit2 f CROSS JOIN range(1, 8) w(d)
),
model AS (
  SELECT g.site_id, g.first_date, g.last_date, g.iso_weekday, g.n AS n_days,
         g.slope_c / 100.0::DOUBLE AS slope_kwh_per_day, g.intercept_c / 100.0::DOUBLE AS intercept_kwh,
         CASE WHEN wd.nd > 0
              THEN ((CAST(wd.syd AS DOUBLE) - g.intercept_c * CAST(wd.nd AS DOUBLE))
                    - g.slope_c * CAST(wd.sxd - wd.nd * g.f0 AS DOUBLE)) / CAST(wd.nd AS DOUBLE) / 100.0::DOUBLE
              ELSE 0.0::DOUBLE END AS weekday_resid_kwh
  FROM fgrid g LEFT JOIN fwd wd ON g.site_id = wd.site_id AND g.iso_weekday = wd.dow
)
"""


@register(
    "udf3_fit_forecast",
    FORECAST_SQL
    + "SELECT site_id, CAST(iso_weekday AS INTEGER) AS iso_weekday, n_days, slope_kwh_per_day, intercept_kwh, "
    "weekday_resid_kwh FROM model",
)
def udf3_fit_forecast(spark, sf_dir):
    return forecast.model_rows(forecast.fit_forecast(gold_of(spark, sf_dir)))


@register(
    "udf4_forecast",
    FORECAST_SQL
    + """
, fsteps AS (
  SELECT DISTINCT m.site_id, m.first_date, m.last_date, m.slope_kwh_per_day, m.intercept_kwh, CAST(h.h AS INTEGER) AS h
  FROM model m CROSS JOIN range(1, 8) h(h)
),
ftarget AS (
  SELECT *, CAST(last_date + h AS DATE) AS forecast_date,
         CAST((CAST(last_date + h AS DATE) - DATE '1970-01-01' + 3) % 7 + 1 AS BIGINT) AS tdow
  FROM fsteps
)
SELECT t.site_id, t.h AS horizon_day, t.forecast_date,
       (t.intercept_kwh + t.slope_kwh_per_day * CAST(t.forecast_date - t.first_date AS DOUBLE)) + m.weekday_resid_kwh
         AS forecast_kwh
FROM ftarget t JOIN model m ON t.site_id = m.site_id AND t.tdow = m.iso_weekday
""",
)
def udf4_forecast(spark, sf_dir):
    return forecast.forecast(forecast.fit_forecast(gold_of(spark, sf_dir)), 7)


@register(
    "udf4_forecast_two_sites",
    ORACLE["udf4_forecast"].removeprefix(O.BASE) + f" WHERE t.site_id IN ('{ONE_SITE}', '13') AND t.h <= 3",
)
def udf4_forecast_two_sites(spark, sf_dir):
    """The serving call: chosen sites and horizon."""
    return forecast.forecast(forecast.fit_forecast(gold_of(spark, sf_dir)), 3, [ONE_SITE, "13"])


# ---------------------------------------------------------------------------
# Composites under one range (CMP4) and the exploration report (CMP6)
# ---------------------------------------------------------------------------

_RANGE = f"reading_date BETWEEN {_d(14)} AND {_d(0)}"
_OVERVIEW_SQL = {
    "kpi": f"SELECT COUNT(*) AS anomalies_last_7d FROM gold WHERE {_RANGE} AND anomaly_flag AND reading_date >= {_d(7)}",
    "per_day": f"SELECT reading_date, COUNT(*) AS anomaly_count FROM gold WHERE {_RANGE} AND anomaly_flag "
    f"AND reading_date >= {_d(30)} GROUP BY reading_date",
    "bu_type": f"SELECT business_unit_name, site_type, COUNT(*) AS anomaly_count FROM gold WHERE {_RANGE} AND anomaly_flag "
    "GROUP BY ALL",
    "top_deviation": f"SELECT * FROM gold WHERE {_RANGE} ORDER BY deviation_pct DESC NULLS LAST, site_id, reading_date LIMIT 10",
}


def _overview(part: str):
    def run(spark, sf_dir):
        start, end = filters.default_range(AS_OF, 14)
        return questions.overview(gold_of(spark, sf_dir), AS_OF, start, end)[part]

    return run


for _part, _sql in _OVERVIEW_SQL.items():
    register(f"cmp4_overview_{_part}", _sql)(_overview(_part))

_EXPLORATION = {
    "span": "agg3_reading_span",
    "kwh_by_type_day": "agg10_kwh_by_type_day",
    "hourly_utc": "agg15_hourly_profile_utc",
    "hourly_local": "agg15_hourly_profile_local",
    "status_share": "agg16_status_share",
    "profile": "agg17_profile",
    "by_site_type": "agg18_kwh_by_site_type",
    "by_business_unit": "agg18_kwh_by_business_unit",
    "by_region": "agg18_kwh_by_region",
}


def _exploration(part: str):
    def run(spark, sf_dir):
        t = star(spark, sf_dir)
        return questions.exploration(t["meter_readings"], t["sites"], t["regions"], lambda: pipeline.build(t), part)

    return run


for _part, _same in _EXPLORATION.items():
    register(f"cmp6_{_part}", ORACLE[_same].removeprefix(O.BASE))(_exploration(_part))

#: The report's columns as each part has them.
_REPORTED = {
    "span": {"n": "row_count", "first_reading": "first_reading", "last_reading": "last_reading"},
    "kwh_by_type_day": {"reading_date": "reading_date", "site_type": "site_type", "total_kwh": "total_kwh"},
    "hourly_utc": {"site_type": "site_type", "hour": "utc_hour", "n": "n_readings", "mean_value": "mean_kwh"},
    "hourly_local": {"site_type": "site_type", "hour": "local_hour", "n": "n_readings", "mean_value": "mean_kwh"},
    "status_share": {"status": "status", "n": "n_readings", "share": "share"},
    "profile": {c: c for c in ("column_name", "null_count", "min_value", "max_value", "mean_value", "stddev_value")} | {"n": "non_null"},
    **{
        p: {d: d, "n": "site_days", "total_kwh": "total_kwh", "mean_value": "mean_daily_kwh"}
        for p, d in (("by_site_type", "site_type"), ("by_business_unit", "business_unit_name"), ("by_region", "region_name"))
    },
}


def _report_sql() -> str:
    """The nine parts side by side."""
    kinds = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE", "timestamp": "TIMESTAMP"}
    parts = []
    for part, same in _EXPLORATION.items():
        has = _REPORTED[part] | {"part": f"'{part}'"}
        columns = ", ".join(f"CAST({has.get(c, 'NULL')} AS {kinds[k]}) AS {c}" for c, k in questions.REPORT_COLUMNS.items())
        parts.append(f"SELECT {columns} FROM ({ORACLE[same].removeprefix(O.BASE)})")
    return "\nUNION ALL\n".join(parts)


@register("cmp6_report", _report_sql())
def cmp6_report(spark, sf_dir):
    t = star(spark, sf_dir)
    return questions.exploration_report(t["meter_readings"], t["sites"], t["regions"], pipeline.build(t))
