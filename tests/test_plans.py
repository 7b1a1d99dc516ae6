"""Physical-plan shape: the properties the scale design relies on."""

import contextlib
import datetime as dt
import io
import os
import tempfile

import pytest

from sitewatts.operators import topk, windows
from sitewatts.plans import pipeline
from sitewatts.sources import generate
from tests.helpers import AS_OF


def _plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


@pytest.fixture(scope="module")
def lab(spark):
    """The four base tables as Parquet files (a real scan, as in production)."""
    base = tempfile.mkdtemp(prefix="sitewatts-lab-")
    d = generate.seed_dimensions(spark, AS_OF)
    r = generate.generate_readings(spark, d["sites"], dt.datetime(2024, 1, 30, 12), days=3, anomalous=["SITE-0005"])
    r.write.parquet(os.path.join(base, "meter_readings"))
    for name in ("sites", "regions", "business_units"):
        d[name].write.parquet(os.path.join(base, name))
    return {n: spark.read.parquet(os.path.join(base, n)) for n in ("meter_readings", "sites", "regions", "business_units")}


def test_gold_pushes_filters_and_prunes_columns(lab):
    plan = _plan(pipeline.build(lab))
    assert "Not(EqualTo(status,error))" in plan
    assert "GreaterThanOrEqual(kwh_consumed,0.0)" in plan
    scan = [line for line in plan.splitlines() if line.startswith("ReadSchema: struct<site_id:string,reading_timestamp")]
    assert scan and "reading_id" not in scan[0] and "temperature_c" not in scan[0]


def test_gold_aggregates_readings_before_any_join(lab):
    plan = _plan(pipeline.build(lab))
    nodes = [line.strip() for line in plan.split("\n\n")[0].splitlines()]
    tree = "\n".join(nodes)
    # the readings branch: Scan -> Filter -> Project -> HashAggregate(partial) -> Exchange -> HashAggregate
    first_scan = tree.rfind("Scan parquet")
    assert "HashAggregate" in tree and "Window" in tree
    below_window = tree[tree.index("Window"):]
    join_pos = min(p for p in (below_window.find("SortMergeJoin"), below_window.find("BroadcastHashJoin")) if p >= 0)
    agg_pos = below_window.find("HashAggregate")
    assert agg_pos > join_pos  # aggregate sits under (before) the join in the tree
    assert first_scan > 0
    assert "partial_sum" in plan


def test_windows_share_one_sort(lab):
    """The largest total of a site, then its sums in the unit that follows from it: two passes over one sorted partition."""
    tree = _plan(pipeline.build(lab)).split("\n\n")[0]
    assert tree.count("Window (") == 2
    windows_ = tree[tree.index("Window (") : tree.index("Join")]
    assert "Sort (" not in windows_ and "Exchange (" not in windows_


def test_top_k_is_take_ordered(lab):
    g = pipeline.build(lab)
    assert "TakeOrderedAndProject" in _plan(topk.top_deviation(g, 10))


def test_top_n_per_unit_limits_before_shuffle(lab):
    g = pipeline.build(lab)
    assert "WindowGroupLimit" in _plan(windows.top_consumers(g, "2024-01", 3))


def test_site_filter_goes_below_the_window(lab):
    g = pipeline.build(lab)
    plan = _plan(windows.site_trend(g, "SITE-0005"), mode="extended")
    optimized = plan.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    lines = optimized.splitlines()
    win = next(i for i, line in enumerate(lines) if "Window [" in line)
    site_filters = [i for i, line in enumerate(lines) if "Filter" in line and "SITE-0005" in line]
    assert site_filters and min(site_filters) > win


def test_bucketed_gold_needs_no_shuffle_for_site_windows(spark, lab):
    from sitewatts.operators import measures
    from sitewatts.sources import tables

    tables.ensure_namespace(spark, "sw_plans")
    gold = tables.materialize(pipeline.build(lab), "sw_plans.gold_bucketed", bucket_by=("site_id", 4))
    plan = _plan(measures.with_deviation_from_baseline(gold))
    tree = plan.split("\n\n")[0]
    assert "Window" in tree and "Exchange" not in tree


def test_silver_table_prunes_date_partitions(spark, lab):
    from pyspark.sql import functions as F

    from sitewatts.sources import tables

    tables.ensure_namespace(spark, "sw_plans")
    silver = pipeline.silver(lab["meter_readings"], lab["sites"], lab["regions"], lab["business_units"])
    back = tables.materialize(silver, "sw_plans.silver_by_date", partition_by=["reading_date"])
    plan = _plan(back.filter(F.col("reading_date") >= F.lit(dt.date(2024, 1, 29))))
    assert "PartitionFilters: [isnotnull(reading_date" in plan and "2024-01-29" in plan


def test_generated_readings_set_up_no_formatter_and_look_up_no_site_type(spark, lab):
    from pyspark.sql import functions as F

    lo, hi = generate.base_range(F.col("site_type"))
    sites = lab["sites"].withColumns({"lo": lo, "hi": hi})
    gen = generate.generate_readings(spark, sites, dt.datetime(2024, 1, 30, 12), days=1, carry=("lo", "hi", "voltage_nominal"))
    checked = gen.groupBy("site_id").agg(
        F.max("reading_id"), F.count_if(~generate.in_range(F.col("lo"), F.col("hi"), F.col("voltage_nominal"))).alias("bad")
    )
    plan = _plan(checked)
    assert "lpad(" in plan  # ids are padded by a string built-in, the formatter is for null and negative numbers
    assert not [line for line in plan.splitlines() if line.startswith("Functions") and "factory" in line]
    assert {r["bad"] for r in checked.collect()} == {0}


def test_reading_ids_are_those_of_the_formatter(spark):
    from pyspark.sql import functions as F

    from sitewatts.functions import columns as C

    numbers = [None, -(2**63), -123456789, -1, 0, 7, 99_999_999, 100_000_000, 2**63 - 1]
    df = spark.createDataFrame([(n,) for n in numbers], "n long")
    for kind in ("long", "int"):
        some = df.where("n is null or abs(try_add(n, 1)) < 1000000000") if kind == "int" else df
        got = some.withColumn("n", F.col("n").cast(kind)).select(C.reading_id("n"), F.format_string("R-%08d", "n")).collect()
        assert len(got) >= 7 and all(a == b for a, b in got)
