"""Trap fixtures (FIXTURES.md section 4, SURVEY section 7.3), literal expectations."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sitewatts.functions import sql_functions
from sitewatts.operators import aggregates, filters, measures, quality, topk
from sitewatts.plans import pipeline, questions
from sitewatts.sources import generate
from tests.helpers import AS_OF, dims, gold_for, readings_df


def _silver(spark, readings):
    t = dims(spark)
    return pipeline.silver(readings, t["sites"], t["regions"], t["business_units"])


def test_t1_null_status_drops(spark):
    r = readings_df(spark, [{"status": s} for s in ("normal", "warning", "error", None)])
    assert _silver(spark, r).count() == 2


def test_dq1_negative_kwh(spark):
    r = readings_df(spark, [{"kwh_consumed": v} for v in (-1.0, 0.0, 1.0, None)])
    kept = sorted(x["kwh_consumed"] for x in _silver(spark, r).collect())
    assert kept == [0.0, 1.0]
    t = dims(spark)
    rows = pipeline.silver_unchecked(r, t["sites"], t["regions"], t["business_units"])
    m = {x["rule"]: x for x in quality.expectation_metrics(rows, quality.silver_rules()).collect()}
    assert m["non_negative_kwh"]["failed"] == 2
    assert m["non_negative_kwh"]["passed"] == 2


def test_dq2_voltage_range_keeps_and_counts(spark):
    r = readings_df(spark, [{"voltage": v} for v in (99.9, 100.0, 600.0, 600.1, None)])
    assert _silver(spark, r).count() == 5
    t = dims(spark)
    rows = pipeline.silver_unchecked(r, t["sites"], t["regions"], t["business_units"])
    m = {x["rule"]: x for x in quality.expectation_metrics(rows, quality.silver_rules()).collect()}
    assert m["voltage_in_range"]["failed"] == 3


def test_dq3_observe_counts_in_the_same_job(spark):
    r = readings_df(spark, [{"kwh_consumed": v} for v in (-1.0, 0.0, 1.0, None)])
    observed, obs = quality.observe_rules(r, quality.silver_rules())
    assert quality.apply_rules(observed, quality.silver_rules()).count() == 2
    got = obs.get
    assert got["rows"] == 4 and got["non_negative_kwh__failed"] == 2


@pytest.mark.parametrize("tz", ["America/Los_Angeles", "UTC"])
def test_t2_utc_day_whatever_session_zone(spark, tz):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", tz)
        ts = dt.datetime(2024, 1, 2, 2, 0, tzinfo=dt.timezone.utc)
        r = readings_df(spark, [{"reading_timestamp": ts}])
        day = pipeline.with_reading_date(r).first()["reading_date"]
        assert day == dt.date(2024, 1, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_t3_zero_mean_site(spark):
    g = gold_for(spark, {"SITE-0001": [0.0] * 6})
    rows = g.collect()
    assert all(r["deviation_pct"] is None for r in rows)
    assert not any(r["anomaly_flag"] for r in rows)


def test_t3_zero_area(spark):
    g = gold_for(spark, {"SITE-0001": [1.0, 2.0]})
    sites = dims(spark)["sites"].withColumn("square_footage", F.lit(0))
    m = measures.measured(g, sites).collect()
    assert all(r["kwh_per_sqft"] is None for r in m)


def test_t5_orphan_site(spark):
    g = gold_for(spark, {"SITE-9999": [1.0] * 5 + [50.0], "SITE-0001": [1.0]})
    orphan = g.filter(F.col("site_id") == "SITE-9999").collect()
    assert len(orphan) == 6 and all(r["site_type"] is None for r in orphan)
    assert sum(r["anomaly_flag"] for r in orphan) == 1
    details = questions.anomaly_details(g, dims(spark)["sites"], "2024-01-01", "2024-01-31")
    assert details.filter(F.col("site_id") == "SITE-9999").count() == 0


def test_t5_duplicate_region_guard(spark):
    t = dims(spark)
    t["regions"] = t["regions"].unionByName(t["regions"].filter(F.col("region_id") == "R-NE"))
    t["meter_readings"] = readings_df(spark, [{}])
    rows = quality.dimension_guard(t).collect()
    dup = [r for r in rows if r["guard"] == "duplicate_key"]
    assert [(r["table_name"], r["key_value"], r["n_rows"]) for r in dup] == [("regions", "R-NE", 2)]


def test_property_a_five_vs_six_days(spark):
    g = gold_for(spark, {"SITE-0001": [10.0] * 4 + [100.0], "SITE-0002": [10.0] * 5 + [100.0]})
    flags = {r["site_id"]: r["n"] for r in g.groupBy("site_id").agg(F.count_if("anomaly_flag").alias("n")).collect()}
    assert flags == {"SITE-0001": 0, "SITE-0002": 1}


def test_property_b_mask(spark):
    g = gold_for(spark, {"SITE-0001": [10.0] * 25 + [80.0] * 5, "SITE-0002": [10.0] * 24 + [80.0] * 6})
    flags = {r["site_id"]: r["n"] for r in g.groupBy("site_id").agg(F.count_if("anomaly_flag").alias("n")).collect()}
    assert flags == {"SITE-0001": 5, "SITE-0002": 0}


def test_t19_constant_sites_never_flag(spark):
    series = {f"SITE-{n:04d}": [0.13] * n for n in range(2, 42)}
    g = gold_for(spark, series)
    assert g.filter("anomaly_flag").count() == 0


def test_t19_boundary_fifth(spark):
    # spike on exactly 1/5 of days: z-score of the spike is exactly 2 -> no flag
    g = gold_for(spark, {"SITE-0001": [1.0] * 8 + [3.0] * 2, "SITE-0002": [0.07] * 20 + [0.19] * 5})
    assert g.filter("anomaly_flag").count() == 0


def test_msr5_missing_deviation_recomputed(spark):
    g = gold_for(spark, {"SITE-0001": [1.0, 2.0, 4.0, 8.0, 3.3, 7.25], "SITE-0002": [5.5, 6.5, 9.1]})
    want = {(r["site_id"], r["reading_date"]): r["deviation_pct"] for r in g.collect()}
    got = measures.ensure_deviation(g.drop("deviation_pct")).collect()
    assert {(r["site_id"], r["reading_date"]): r["deviation_pct"] for r in got} == want
    assert measures.ensure_deviation(g) is g


def test_t6_date_edges(spark):
    days = [AS_OF - dt.timedelta(days=15), AS_OF - dt.timedelta(days=14), AS_OF, AS_OF + dt.timedelta(days=1)]
    df = spark.createDataFrame([(d,) for d in days], "reading_date date")
    since = sorted(r[0] for r in filters.since(df, AS_OF, 14).collect())
    between = sorted(r[0] for r in filters.between_dates(df, *filters.default_range(AS_OF, 14)).collect())
    assert since == days[1:]
    assert between == days[1:3]


def test_flt5_empty_types_is_no_filter(spark):
    g = gold_for(spark, {"SITE-0001": [1.0], "SITE-0003": [2.0]})
    assert filters.of_types(g, []).count() == 2
    assert filters.of_types(g, None).count() == 2
    assert filters.of_types(g, ["office"]).count() == 1


def test_t7_unknown_site_table_function(spark):
    g = gold_for(spark, {"SITE-0001": [10.0] * 5 + [100.0]})
    g.createOrReplaceTempView("t7_gold")
    sql_functions.register_get_site_anomalies(spark, "t7_gold")
    one = spark.sql("SELECT * FROM get_site_anomalies('SITE-0001', 60, DATE'2024-01-30')").count()
    none = spark.sql("SELECT * FROM get_site_anomalies('SITE-4242', 60, DATE'2024-01-30')").count()
    assert (one, none) == (1, 0)


def test_top5_few_anomalies_not_padded(spark):
    g = gold_for(spark, {"SITE-0001": [10.0] * 5 + [100.0], "SITE-0002": [10.0] * 5 + [90.0], "SITE-0003": [1.0] * 6})
    assert topk.triage_top(g, 3).count() == 2


@pytest.mark.parametrize("hour", [0, 7, 23])
def test_t8_partial_days(spark, hour):
    t = dims(spark)
    sites = t["sites"].filter(F.col("site_id").isin("SITE-0001", "SITE-0002"))
    gen = generate.generate_readings(spark, sites, dt.datetime(2024, 1, 30, hour), days=30)
    per_day = (
        pipeline.with_reading_date(gen).groupBy("site_id", "reading_date").count().orderBy("reading_date").collect()
    )
    dates = sorted({r["reading_date"] for r in per_day})
    assert len(dates) == 31
    counts = {(r["site_id"], r["reading_date"]): r["count"] for r in per_day}
    assert counts[("SITE-0001", dates[-1])] == 4 * hour + 1
    assert counts[("SITE-0001", dates[0])] == 95 - 4 * hour


def test_t11_measure_uses_full_table_baseline(spark):
    g = gold_for(spark, {"SITE-0001": [float(v) for v in range(1, 31)]})
    full = measures.with_deviation_from_baseline(g)
    late = filters.since(full, AS_OF, 14).collect()
    literal = measures.deviation_over_filtered(filters.since(g, AS_OF, 14)).collect()
    assert len(late) == len(literal) == 15
    a = {r["reading_date"]: r["deviation_from_baseline_pct"] for r in late}
    b = {r["reading_date"]: r["deviation_from_baseline_pct"] for r in literal}
    assert all(a[d] != b[d] for d in a)
    # the full-table measure agrees with the pipeline's (rounded) deviation
    assert all(round(r["deviation_from_baseline_pct"], 1) == pytest.approx(r["deviation_pct"]) for r in late)


def test_empty_input_headline(spark):
    g = gold_for(spark, {"SITE-0001": [1.0]}).filter(F.lit(False))
    h = aggregates.anomaly_headline(g).first()
    assert (h["anomalies_in_range"], h["distinct_sites_flagged"], h["highest_deviation_pct"]) == (0, 0, None)
    assert h["highest_deviation_label"] == "—"


def test_pct_label_half_even(spark):
    df = spark.createDataFrame([(412.5,), (413.5,), (-0.4,), (99.96,)], "d double")
    got = [r[0] for r in df.select(aggregates.pct_label(F.col("d"))).collect()]
    assert got == ["412%", "414%", "0%", "100%"]


def test_scalar_helpers(spark):
    from sitewatts.functions import columns as C

    utc = dt.timezone.utc
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 3, 1, 0, tzinfo=utc), dt.datetime(2024, 1, 1, 2, 0, tzinfo=utc), 7, "America/Phoenix")],
        "later timestamp, earlier timestamp, n long, tz string",
    )
    r = df.select(
        C.whole_days_between("later", "earlier").alias("days"),
        C.reading_id("n").alias("rid"),
        C.utc_hour("later").alias("h"),
        C.local_hour("later", "tz").alias("lh"),
        C.utc_date("later").alias("d"),
        C.safe_div(F.lit(1.0), F.lit(0)).alias("z"),
    ).first()
    assert (r["days"], r["rid"], r["h"], r["lh"], r["d"], r["z"]) == (1, "R-00000007", 1, 18, dt.date(2024, 1, 3), None)
