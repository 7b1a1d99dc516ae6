"""NaN, infinite and huge readings, spreads far from zero, and local hours without joining readings."""

import datetime as dt
import math
import statistics

import pytest
from pyspark.sql import functions as F

from sitewatts.functions.columns import local_hour
from sitewatts.functions.exact import kwh_mean, kwh_sum
from sitewatts.operators import aggregates, forecast, measures, topk
from sitewatts.plans import pipeline, triage
from tests.helpers import AS_OF, DAY0, dims, gold_for, readings_df, series_readings

NAN, INF = float("nan"), float("inf")


def by_day(df):
    return {(r["site_id"], r["reading_date"].day): r for r in df.collect()}


def test_bad_readings_stay_with_their_site_and_day(spark):
    series = {"SITE-0001": [1.0, NAN, 3.0], "SITE-0002": [1.0, 2.0, INF], "SITE-0003": [1.0, 2.0, 6.0]}
    rows = by_day(gold_for(spark, series))
    assert math.isnan(rows["SITE-0001", 2]["total_kwh"]) and rows["SITE-0001", 3]["total_kwh"] == 3.0
    assert rows["SITE-0002", 3]["total_kwh"] == INF
    for d in (1, 2, 3):
        assert math.isnan(rows["SITE-0001", d]["site_mean_kwh"]) and rows["SITE-0002", d]["site_mean_kwh"] == INF
        assert all(math.isnan(rows[s, d][c]) for s in ("SITE-0001", "SITE-0002") for c in ("site_stddev_kwh", "deviation_pct"))
        assert not any(rows[s, d]["anomaly_flag"] for s in series)
        assert rows["SITE-0003", d]["site_mean_kwh"] == 3.0


def test_several_bad_readings_in_one_day_add_up_as_doubles_do(spark):
    t = dims(spark)
    values = {"SITE-0001": [NAN, INF, 1.0], "SITE-0002": [INF, INF, 2.0], "SITE-0003": [1e18, 2e18, 0.01], "SITE-0004": [1e300, 1e300, 5.0]}
    rows = [{"site_id": s, "kwh_consumed": v} for s, vs in values.items() for v in vs]
    got = {r["site_id"]: r["total_kwh"] for r in pipeline.build_gold(readings_df(spark, rows), t["sites"], t["regions"], t["business_units"]).collect()}
    assert math.isnan(got["SITE-0001"]) and got["SITE-0002"] == INF and got["SITE-0003"] == 3e18 and got["SITE-0004"] == 2e300


@pytest.mark.parametrize("spike", [1e13, 1e18, 4.5e305])
def test_huge_totals_are_flagged_by_whole_numbers(spark, spike):
    """One spike in five days is exactly two sigmas off, one in six is more."""
    rows = by_day(gold_for(spark, {"SITE-0001": [spike, 7.0, 7.0, 7.0, 7.0], "SITE-0002": [spike, 7.0, 7.0, 7.0, 7.0, 7.0]}))
    assert rows["SITE-0001", 1]["total_kwh"] == spike
    assert [d for (s, d), r in rows.items() if r["anomaly_flag"]] == [1] and rows["SITE-0002", 1]["anomaly_flag"]
    assert rows["SITE-0001", 1]["site_mean_kwh"] == pytest.approx(spike / 5, rel=1e-11)
    assert rows["SITE-0001", 1]["site_stddev_kwh"] == pytest.approx(spike * 0.4, rel=1e-11)
    assert rows["SITE-0001", 1]["deviation_pct"] == pytest.approx(400.0, rel=1e-9)


def test_silver_path_agrees_on_bad_readings(spark):
    t = dims(spark)
    r = series_readings(spark, {"SITE-0001": [1.0, 1e18, 3.0, 2.0], "SITE-0002": [NAN, 2.0], "SITE-0003": [3.0, 4.0]})
    one = pipeline.build_gold(r, t["sites"], t["regions"], t["business_units"])
    two = pipeline.gold(pipeline.silver(r, t["sites"], t["regions"], t["business_units"]))
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))


def test_questions_go_on_with_bad_totals(spark):
    t = dims(spark)
    gold = gold_for(spark, {"SITE-0001": [1.0, NAN, 3.0], "SITE-0005": [2.0, INF], "SITE-0009": [5.0, 1e15], "SITE-0002": [1.5, 2.5, 8.0]})
    totals = {r["site_type"]: r for r in aggregates.kwh_by_dimension(gold, "site_type").collect()}
    assert math.isnan(totals["factory"]["total_kwh"]) and totals["warehouse"]["total_kwh"] == 12.0
    assert totals["warehouse"]["mean_daily_kwh"] == 4.0 and totals["warehouse"]["site_days"] == 3
    dev = by_day(measures.with_deviation_from_baseline(gold))
    assert math.isnan(dev["SITE-0001", 1]["deviation_from_baseline_pct"]) and dev["SITE-0002", 3]["deviation_from_baseline_pct"] == 100.0
    assert dev["SITE-0009", 2]["deviation_from_baseline_pct"] == pytest.approx(100.0)
    intensity = {r["site_id"]: r for r in topk.top_sites_intensity_detail(gold, t["sites"], AS_OF, 60, 9).collect()}
    assert math.isnan(intensity["SITE-0001"]["avg_kwh_per_sqft"])
    assert intensity["SITE-0009"]["avg_kwh_per_sqft"] == pytest.approx((1e15 + 5) / 2 / 300_000)
    assert intensity["SITE-0002"]["avg_deviation_from_baseline_pct"] == 0.0
    models = {r["site_id"]: r for r in forecast.fit_forecast(gold).collect()}
    assert models["SITE-0001"]["n_days"] == 2 and models["SITE-0009"]["n_days"] == 1
    readings = series_readings(spark, {"SITE-0001": [1.0, NAN, 3.0]})
    assert triage.triage(gold, t["sites"], readings, (DAY0.date(), AS_OF)).count() == 0


def test_sums_of_totals(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("b", 1e14), ("b", 0.25), ("c", None), ("d", NAN), ("d", 1.0)], "k string, v double")
    got = {r["k"]: (r["s"], r["m"]) for r in df.groupBy("k").agg(kwh_sum("v").alias("s"), kwh_mean("v").alias("m")).collect()}
    assert got["a"] == (0.3, 0.15) and got["b"] == (1e14 + 0.25, (1e14 + 0.25) / 2) and got["c"] == (None, None)
    assert math.isnan(got["d"][0]) and math.isnan(got["d"][1])


@pytest.mark.parametrize(
    "values",
    [[1e8, 1e8 + 0.001] * 5, [1e12, 1e12 + 1, 1e12 + 2], [-1e12, 1e12], [0.9999999, 1.0000001] * 3, [5.5] * 7, [1e9, 0.0], [-3.25, 4.75, 1e6]],
)
def test_spread_keeps_small_differences(spark, values):
    row = aggregates.profile(spark.createDataFrame([(v,) for v in values] + [(None,)], "x double"), ("x",)).first()
    assert row["non_null"] == len(values) and row["null_count"] == 1
    assert row["mean_value"] == pytest.approx(math.fsum(values) / len(values), rel=1e-15)
    assert row["stddev_value"] == pytest.approx(statistics.pstdev(values), rel=1e-6, abs=1e-12)


def test_profile_of_values_that_are_not_numbers_or_huge(spark):
    df = spark.createDataFrame([(NAN, 1e200, INF, None), (2.0, 0.0, 1.0, None)], "x double, y double, z double, w double")
    x, y, z, w = (aggregates.profile(df, (c,)).first() for c in "xyzw")
    assert x["non_null"] == 2 and math.isnan(x["mean_value"]) and math.isnan(x["stddev_value"]) and x["min_value"] == 2.0
    assert y["mean_value"] == 5e199 and z["mean_value"] == INF and math.isnan(z["stddev_value"])
    assert (w["non_null"], w["null_count"], w["mean_value"], w["stddev_value"]) == (0, 2, None, None)


def test_temperatures_far_from_zero(spark):
    rows = [{"reading_timestamp": DAY0 + dt.timedelta(days=d), "temperature_c": 1e8 + (0.001 if d == 4 else 0.0)} for d in range(10)]
    got = {r["reading_date"].day: r for r in aggregates.temperature_evidence(readings_df(spark, rows)).collect()}
    assert got[1]["site_stddev_temp_c"] == pytest.approx(0.0003, rel=1e-4)
    assert [d for d, r in got.items() if r["temp_elevated"]] == [5]


ZONES = [
    "America/New_York", "America/Phoenix", "Australia/Lord_Howe", "Asia/Kathmandu", "America/St_Johns", "Africa/Casablanca",
    "Asia/Kolkata", "Pacific/Apia", "Africa/Monrovia", "Europe/London",
]


def test_local_hours_equal_those_of_each_reading(spark):
    """Across changes of all zones, 30- and 45-minute offsets, a skipped day, local mean times and far years."""
    regions = spark.createDataFrame([(str(k), str(k), z) for k, z in enumerate(ZONES)] + [("x", "x", None)], "region_id string, region_name string, timezone string")
    sites = regions.selectExpr("region_id AS site_id", "region_id AS site_type", "region_id")
    around = "transform(sequence(-40, 40), k -> {at} + k * 907000000L)"
    years = [1880, 1950, 1971, 1973, 1987, 2011, 2023, 2024, 2099, 2100, 2120]
    days = spark.range(1).selectExpr(f"explode(array({', '.join(map(str, years))})) AS y").selectExpr("explode(sequence(make_date(y,1,1), make_date(y,12,31), interval 9 days)) AS d")
    instants = days.selectExpr("explode(" + around.format(at="unix_micros(to_timestamp(d))") + ") AS us").selectExpr("timestamp_micros(us) AS reading_timestamp")
    changed = spark.createDataFrame([(t,) for t in _change_micros()], "us long").selectExpr("explode(" + around.format(at="us").replace("907000000L", "61000000L") + ") AS us")
    instants = instants.union(changed.selectExpr("timestamp_micros(us)")).selectExpr("reading_timestamp", "CAST(hash(reading_timestamp) % 1000 AS DOUBLE) AS kwh_consumed")
    readings = instants.join(sites.select("site_id"))
    direct = readings.join(aggregates.site_zones(sites, regions), "site_id").groupBy("site_type", local_hour("reading_timestamp", F.col("timezone")).alias("local_hour"))
    want = {tuple(r) for r in direct.agg(F.count("*").alias("n"), (F.sum("kwh_consumed") / F.count("*")).alias("m")).collect()}
    got = aggregates.hourly_profile(readings, sites, local=True, regions=regions)
    assert {(r.site_type, r.local_hour, r.n_readings, r.mean_kwh) for r in got.collect()} == want


def _change_micros():
    """Some changes of the zones above, from the zone database of the standard library."""
    import zoneinfo

    out = set()
    for z in ZONES:
        zone = zoneinfo.ZoneInfo(z)
        for year in (1987, 2010, 2011, 2024):
            at = dt.datetime(year, 1, 1, tzinfo=dt.timezone.utc)
            for _ in range(366 * 24 * 2):
                after = at + dt.timedelta(minutes=30)
                if at.astimezone(zone).utcoffset() != after.astimezone(zone).utcoffset():
                    out.add(int(at.timestamp()) * 1_000_000)
                at = after
    return out


def test_readings_are_summed_before_their_zone_is_joined(spark):
    t = dims(spark)
    r = series_readings(spark, {"SITE-0001": [1.0, 2.0]}).withColumn("mark", F.lit(1))
    plan = aggregates.hourly_profile(r, t["sites"], local=True, regions=t["regions"])._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    leaf = next(k for k, x in enumerate(lines) if "kwh_consumed#" in x and ("LogicalRDD" in x or "LocalRelation" in x))
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    above, at = [], depth(lines[leaf])
    for x in reversed(lines[:leaf]):
        if depth(x) < at:
            above.append(x.lstrip(" :+-").split()[0])
            at = depth(x)
    assert above.index("Aggregate") < above.index("Join")
