"""A hot site holding a third of all readings: gold stays exact.

Checked against a brute-force pandas computation with exact fractions on the
same small fixture.
"""

import datetime as dt
from fractions import Fraction

import pandas as pd
from pyspark.sql import functions as F

from sitewatts import schemas
from sitewatts.plans import pipeline
from tests.helpers import dims


def _fixture(spark):
    rows = []
    n = 0
    start = dt.datetime(2024, 1, 1)
    # 9 ordinary sites: one reading per hour for 8 days
    for s in range(2, 11):
        for h in range(8 * 24):
            n += 1
            rows.append((f"R-{n}", f"SITE-{s:04d}", start + dt.timedelta(hours=h), round(((n * 37) % 500) / 100, 2),
                         4.0, 480.0, 20.0, "warning" if n % 17 == 0 else "normal"))
    ordinary = len(rows)
    # the hot site: as many readings as the other nine together / 2 -> a third of all rows
    for i in range(ordinary // 2):
        n += 1
        day = i % 8
        spike = 40.0 if day == 6 else 1.0
        rows.append((f"R-{n}", "SITE-0001", start + dt.timedelta(days=day, minutes=(i // 8) % 1440),
                     round(spike * (1 + (i % 7) / 10), 2), 5.0, 480.0, 21.0, "normal"))
    return spark.createDataFrame(rows, schemas.METER_READINGS), rows


def _brute_force(rows):
    df = pd.DataFrame(rows, columns=schemas.METER_READINGS.fieldNames())
    df = df[(df.status != "error") & (df.kwh_consumed >= 0)]
    df["day"] = df.reading_timestamp.dt.date
    out = {}
    for site, g in df.groupby("site_id"):
        totals = {d: sum(Fraction(str(x)) for x in gg.kwh_consumed) for d, gg in g.groupby("day")}
        totals = {d: Fraction(round(t * 100), 100) for d, t in totals.items()}  # sums have <= 2 dp
        n = len(totals)
        mean = sum(totals.values()) / n
        var = sum((t - mean) ** 2 for t in totals.values()) / n
        for d, t in totals.items():
            flag = t - mean > 0 and (t - mean) ** 2 > 4 * var
            out[(site, d)] = (float(t), bool(flag))
    return out


def test_hot_site_gold_is_exact(spark):
    readings, rows = _fixture(spark)
    by_site = {r["site_id"]: r["count"] for r in readings.groupBy("site_id").count().collect()}
    assert by_site["SITE-0001"] * 3 >= sum(by_site.values()) - 1
    t = dims(spark)
    gold = pipeline.build_gold(readings.repartition(16), t["sites"], t["regions"], t["business_units"])
    got = {(r["site_id"], r["reading_date"]): (r["total_kwh"], r["anomaly_flag"]) for r in gold.collect()}
    assert got == _brute_force(rows)
    assert gold.filter(F.col("anomaly_flag") & (F.col("site_id") == "SITE-0001")).count() == 1


SORT_MERGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_silver_without_broadcast_splits_the_hot_site(spark):
    """Dimension past the broadcast bound: the sort-merge join's hot partition is split by AQE."""
    readings, _rows = _fixture(spark)
    t = dims(spark)
    conf = SORT_MERGE
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        silver = pipeline.silver(readings.repartition(8), t["sites"], t["regions"], t["business_units"])
        n = silver.count()
        rows = silver.collect()
        plan = silver._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert n == len(rows) == readings.filter("status <> 'error' AND kwh_consumed >= 0").count()
    assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan


def test_gold_of_lazy_silver_splits_the_hot_site(spark):
    """The roll-up mustn't take over the join's partitioning: no task may get all rows of the hot site."""
    readings, rows = _fixture(spark)
    t = dims(spark)
    for k, v in SORT_MERGE.items():
        spark.conf.set(k, v)
    try:
        silver = pipeline.silver(readings.repartition(8), t["sites"], t["regions"], t["business_units"])
        gold = pipeline.gold(silver)
        got = {(r["site_id"], r["reading_date"]): (r["total_kwh"], r["anomaly_flag"]) for r in gold.collect()}
        plan = gold._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in SORT_MERGE:
            spark.conf.unset(k)
    assert got == _brute_force(rows)
    assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
    direct = pipeline.build_gold(readings, t["sites"], t["regions"], t["business_units"])
    assert sorted(map(repr, direct.collect())) == sorted(map(repr, gold.collect()))
