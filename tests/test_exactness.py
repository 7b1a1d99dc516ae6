"""Sums are rounded once, nothing overflows at design scale, plans start no jobs and see new files."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from sitewatts.operators import aggregates, filters, forecast
from sitewatts.plans import pipeline
from sitewatts.sources import adapter, generate
from tests.conftest import SF_SMALL
from tests.helpers import DAY0, dims, readings_df


def _readings(spark, kwh, temperature=20.0, n=96):
    return readings_df(
        spark,
        [{"reading_timestamp": DAY0.replace(hour=0) + dt.timedelta(minutes=15 * k), "kwh_consumed": kwh, "temperature_c": temperature} for k in range(n)],
    )


@pytest.mark.parametrize(("kwh", "n", "total"), [(0.0004, 96, 0.04), (1.0006, 24, 24.01), (0.000000123, 50, 0.0), (2.0051234, 3, 6.02)])
def test_daily_total_is_rounded_after_the_sum(spark, kwh, n, total):
    t = dims(spark)
    gold = pipeline.build_gold(_readings(spark, kwh, n=n), t["sites"], t["regions"], t["business_units"])
    assert gold.first()["total_kwh"] == total


def test_means_keep_small_values(spark):
    r = _readings(spark, 0.0004, temperature=21.123456)
    row = aggregates.profile(r, ("kwh_consumed",)).first()
    assert row["mean_value"] == pytest.approx(0.0004, rel=1e-15) and row["min_value"] == 0.0004 and row["stddev_value"] < 1e-9
    temps = aggregates.temperature_evidence(r).first()
    assert temps["avg_temp_c"] == pytest.approx(21.123456, rel=1e-15) and not temps["temp_elevated"]
    hour = aggregates.hourly_profile(r, dims(spark)["sites"]).first()
    assert hour["mean_kwh"] == pytest.approx(0.0004, rel=1e-15)


def test_local_hour_of_historic_offsets(spark):
    """Local mean time isn't a multiple of 15 minutes off UTC."""
    t = dims(spark)
    r = readings_df(spark, [{"reading_timestamp": dt.datetime(1880, 6, 1, 4, m)} for m in (50, 59)])
    got = aggregates.hourly_profile(r, t["sites"], local=True, regions=t["regions"])
    assert sorted(x["local_hour"] for x in got.collect()) == [0, 23]


def test_no_overflow_at_design_scale(spark):
    """3,650 days of 1e9 readings a day, given as sums per day."""
    days = spark.range(3650).select(
        F.lit("S").alias("site_id"),
        F.date_add(F.lit(dt.date(2014, 1, 1)), F.col("id").cast("int")).alias("reading_date"),
        (F.lit(4_000_000_000_000) + F.col("id") * 1000).alias("total_cents"),
    ).withColumn("total_kwh", F.col("total_cents") / 100.0)
    out = pipeline.with_baseline(days).orderBy("reading_date").collect()
    assert out[0]["deviation_pct"] == 0.0 and out[-1]["site_mean_kwh"] == pytest.approx(40_000_018_245.0)
    model = forecast.fit_forecast(days).first()
    assert model["slope_kwh_per_day"] == pytest.approx(10.0) and model["n_days"] == 3650
    t = F.when(F.col("id") == 3, 22).otherwise(20).cast("decimal(20,0)")
    many = F.lit(10**9).cast("decimal(20,0)")
    sums = {"n": F.lit(10**9), "a": t * many, "aa": t * t * many, **dict.fromkeys(("b", "ab", "bb"), F.lit(0).cast("decimal(28,0)"))}
    sums |= {"fn": F.lit(0).cast("long"), "f": F.lit(None).cast("double"), "ff": F.lit(None).cast("double")}
    temps = spark.range(30).select(
        F.lit("S").alias("site_id"), F.col("id").alias("day"), *[sums[m].alias(f"_t_{m}") for m in sums]
    )
    flagged = aggregates.with_temperature_flags(temps).where("temp_elevated").collect()
    assert [r["day"] for r in flagged] == [3]


def test_files_that_arrive_later_are_seen(spark, tmp_path):
    for name in ("region", "nation", "customer"):
        shutil.copy(f"{SF_SMALL}/{name}.parquet", tmp_path / f"{name}.parquet")
    (tmp_path / "events.parquet").mkdir()
    shutil.copy(f"{SF_SMALL}/events.parquet", tmp_path / "events.parquet" / "a.parquet")
    queries = E.queries()

    def counts():
        audit = {r["table_name"]: r["row_count"] for r in queries["set1_row_count_audit"](spark, str(tmp_path)).collect()}
        return audit["meter_readings"], queries["src7_row_count"](spark, str(tmp_path)).first()[0]

    before = counts()
    shutil.copy(f"{SF_SMALL}/events.parquet", tmp_path / "events.parquet" / "b.parquet")
    assert before[0] == before[1] and counts() == (2 * before[0], 2 * before[1])


def test_building_a_query_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "plans only")
    try:
        for name, query in E.queries().items():
            if not name.startswith("op") and name != "pipeline":
                query(spark, SF_SMALL).schema  # noqa: B018
        assert list(tracker.getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_date_ranges_reach_the_scan(spark, tmp_path):
    recent = adapter.meter_readings(spark, SF_SMALL, since=dt.date(2024, 1, 23))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan
    r = pipeline.with_reading_date(_readings(spark, 1.0))
    r.write.partitionBy("reading_date").parquet(str(tmp_path / "readings"))
    back = filters.reading_dates(spark.read.parquet(str(tmp_path / "readings")), DAY0.date(), DAY0.date())
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(reading_date" in plan and "GreaterThanOrEqual(reading_timestamp" in plan
    assert back.count() == 96


def test_generated_ids_are_dense_and_distinct(spark):
    end = dt.datetime(2024, 1, 30, 12)
    sites = generate.seed_dimensions(spark, end.date())["sites"]
    ids = [r[0] for r in generate.generate_readings(spark, sites, end, days=2, partitions=3).select("reading_id").collect()]
    assert min(ids) == "R-00000001" and max(ids) == f"R-{10 * 192:08d}" and len(set(ids)) == 10 * 192
    clash = sites.limit(2).withColumn("site_id", F.when(F.col("site_id") == "SITE-0001", "A-1").otherwise("B-1"))
    got = generate.generate_readings(spark, clash, end, days=1, partitions=1)
    assert got.select("reading_id").distinct().count() == got.count() == 192
