"""The exploration report in two scans, parts on demand, and ranks without a single task."""

import random

import pytest
from pyspark.sql import functions as F

from sitewatts.plans import catalog, pipeline, questions
from sitewatts.sources import adapter, generate
from tests.conftest import SF_SMALL
from tests.helpers import dims, readings_df


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_report_reads_the_readings_once_for_itself_and_once_for_gold(spark):
    plan = executed(catalog.cmp6_report(spark, SF_SMALL))
    assert plan.count("events.parquet") == 2
    t = adapter.load_star(spark, SF_SMALL)
    stored = pipeline.build(t).limit(50)
    gold = spark.createDataFrame(stored.toPandas(), stored.schema)
    report = questions.exploration_report(t["meter_readings"], t["sites"], t["regions"], gold)
    assert executed(report).count("events.parquet") == 1
    assert report.columns == list(questions.REPORT_COLUMNS) and {r.part for r in report.select("part").distinct().collect()} == set(questions.EXPLORATION)


def test_a_part_builds_only_itself(spark):
    t = adapter.load_star(spark, SF_SMALL)

    def no_gold():
        raise AssertionError("gold isn't needed")

    for part in ("span", "hourly_utc", "hourly_local", "status_share", "profile"):
        questions.exploration(t["meter_readings"], t["sites"], t["regions"], no_gold, part)
    by_region = questions.exploration(None, None, None, lambda: pipeline.build(t), "by_region")
    assert executed(by_region).count("events.parquet") == 1
    with pytest.raises(KeyError):
        questions.exploration(t["meter_readings"], t["sites"], t["regions"], no_gold, "nothing")


def test_report_of_odd_readings(spark):
    """Unknown and missing sites, statuses and values, and no readings at all."""
    t = dims(spark)
    rows = [{"site_id": "nowhere"}, {"site_id": None, "status": None}, {"site_id": "SITE-0001", "kwh_consumed": float("nan"), "voltage": None}]
    gold = pipeline.build_gold(readings_df(spark, rows), t["sites"], t["regions"], t["business_units"])
    report = questions.exploration_report(readings_df(spark, rows), t["sites"], t["regions"], gold).collect()
    parts = {}
    for r in report:
        parts.setdefault(r.part, []).append(r)
    assert parts["span"][0].n == 3 and sorted(map(repr, ((r.status, r.n) for r in parts["status_share"]))) == ["('normal', 2)", "(None, 1)"]
    assert [(r.site_type, r.n) for r in parts["hourly_utc"]] == [("factory", 1)] == [(r.site_type, r.n) for r in parts["hourly_local"]]
    assert {r.column_name: r.null_count for r in parts["profile"]}["voltage"] == 1
    empty = readings_df(spark, rows).limit(0)
    none = pipeline.build_gold(empty, t["sites"], t["regions"], t["business_units"])
    assert questions.exploration_report(empty, t["sites"], t["regions"], none).count() == 0


@pytest.mark.parametrize("n", [0, 1, 300, 3000])
def test_ranks_equal_row_numbers(spark, n):
    rng = random.Random(n)
    keys = list({f"S-{rng.randint(0, 10**rng.randint(1, 6))}" for _ in range(n)})
    df = spark.createDataFrame([(k, k) for k in keys], "site_id string, other string").repartition(5)
    ranked = generate.with_rank(df, "site_id", "place")
    assert {r.site_id: r.place for r in ranked.collect()} == {k: i for i, k in enumerate(sorted(keys))}
    assert "SinglePartition" not in executed(ranked.select("site_id", "place")).split("Subquery")[0]


def test_ranks_of_repeated_and_null_keys(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), (None,)], "k string")
    got = sorted((r.place, r.k) for r in generate.with_rank(df, "k", "place").collect())
    assert got == [(0, None), (1, None), (2, "a"), (3, "b"), (4, "b")]


def test_carried_columns_follow_their_site(spark):
    import datetime as dt

    sites = dims(spark)["sites"].withColumn("odd name", F.col("site_name"))
    got = generate.generate_readings(spark, sites, dt.datetime(2024, 1, 30, 12), days=1, carry=("odd name", "site_type"))
    assert got.columns[-2:] == ["odd name", "site_type"]
    assert got.join(sites.select("site_id", F.col("site_name")), "site_id").where("`odd name` <> site_name").count() == 0
