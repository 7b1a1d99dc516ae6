"""Incremental gold, typed dry run, model versions and the catalog's table function."""

import datetime as dt
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sitewatts import schemas
from sitewatts.functions import sql_functions
from sitewatts.operators import forecast, quality
from sitewatts.plans import graph, incremental, jobs, pipeline
from sitewatts.sources import tables
from tests.helpers import AS_OF, DAY0, dims, gold_for, readings_df

NAN = float("nan")


def rows_of(gold):
    return sorted(map(repr, gold.select(*schemas.GOLD_COLUMNS).collect()))


def reading(site, day, kwh, minute=0):
    return {"site_id": site, "reading_timestamp": DAY0 + dt.timedelta(days=day, minutes=minute), "kwh_consumed": kwh, "voltage": 470.0 + minute}


def test_day_by_day_with_late_and_corrected_days_equals_a_rebuild(spark, tmp_path):
    t = dims(spark)
    rng = random.Random(7)
    path = str(tmp_path / "gold")
    by_day = {d: [reading(s, d, rng.choice([1.0, 2.5, 40.0]), m) for s in ("SITE-0001", "SITE-0002", "nowhere", None) for m in (0, 15)] for d in range(7)}
    by_day[2] = []  # comes late
    by_day[4].append(reading("SITE-0002", 4, NAN))  # corrected later
    by_day[5].append(reading("SITE-0009", 5, 1e18))  # stays
    # each step: the days that change, then what they hold
    steps = [(d, None) for d in range(7)]
    steps += [(2, [reading("SITE-0001", 2, 500.0), reading("SITE-0005", 2, 3.0)])]  # a late day with a new site
    steps += [(4, [r for r in by_day[4] if r["kwh_consumed"] == r["kwh_consumed"]])]
    steps += [(0, [reading("SITE-0001", 0, 9.0)]), (6, [])]  # a corrected day, an emptied day
    known = {}
    for n, (day, rows) in enumerate(steps, 1):
        known[day] = by_day[day] if rows is None else rows
        date = (DAY0 + dt.timedelta(days=day)).date()
        assert incremental.replace_days(spark, path, readings_df(spark, known[day]), [date]) == n
        everything = [r for d in known.values() for r in d]
        want = pipeline.build_gold(readings_df(spark, everything), t["sites"], t["regions"], t["business_units"])
        if n in (3, 7, 8, 9, 11):
            assert rows_of(incremental.gold(spark, path, t["sites"], t["regions"], t["business_units"])) == rows_of(want)
    last = incremental.gold(spark, path, t["sites"], t["regions"], t["business_units"], since=dt.date(2024, 1, 6), until=dt.date(2024, 1, 6))
    assert rows_of(last) == rows_of(want.where("reading_date = DATE'2024-01-06'"))
    assert {r.site_id: (r.days, r.n) for r in incremental.state(spark, path).collect()}["SITE-0009"] == (1, 0)


def test_several_days_at_once_and_runs_that_failed(spark, tmp_path):
    t = dims(spark)
    path = str(tmp_path / "gold")
    rows = [reading("SITE-0001", d, 1.0 + d) for d in range(5)]
    days = [(DAY0 + dt.timedelta(days=d)).date() for d in range(5)]
    incremental.replace_days(spark, path, readings_df(spark, rows), days[:3])
    # a run that wrote rows and state, but no commit
    junk = incremental.daily(spark, path).withColumn("total_cents", F.lit(1))
    junk.write.partitionBy("reading_date").parquet(f"{path}/daily/version=2")
    incremental.state(spark, path).write.parquet(f"{path}/state/version=2")
    assert incremental.version(spark, path) == 1 and incremental.daily(spark, path).count() == 3
    assert incremental.replace_days(spark, path, readings_df(spark, rows), days[2:]) == 2
    want = pipeline.build_gold(readings_df(spark, rows), t["sites"], t["regions"], t["business_units"])
    assert rows_of(incremental.gold(spark, path, t["sites"], t["regions"], t["business_units"])) == rows_of(want)
    assert incremental.replace_days(spark, path, readings_df(spark, rows), []) == 2


def test_a_day_reads_neither_other_readings_nor_other_daily_rows(spark, tmp_path):
    t = dims(spark)
    readings = pipeline.with_reading_date(readings_df(spark, [reading("SITE-0001", d, 1.0) for d in range(6)]))
    readings.write.partitionBy("reading_date").parquet(str(tmp_path / "readings"))
    stored = spark.read.parquet(str(tmp_path / "readings"))
    days = [(DAY0 + dt.timedelta(days=d)).date() for d in range(6)]
    path = str(tmp_path / "gold")
    incremental.replace_days(spark, path, stored, days)
    for folder in (tmp_path / "readings" / f"reading_date={days[0]}", tmp_path / "gold" / "daily" / "version=1" / f"reading_date={days[0]}"):
        for file in folder.glob("*.parquet"):
            file.write_bytes(b"not to be read")
    assert incremental.replace_days(spark, path, stored, days[3:4]) == 2
    one = incremental.gold(spark, path, t["sites"], t["regions"], t["business_units"], since=days[3], until=days[3])
    assert one.collect()[0]["site_mean_kwh"] == 1.0


def test_job_for_some_days(spark, tmp_path):
    jobs.seed_lab(spark, "lab_days", AS_OF, dt.datetime(2024, 1, 30, 12), days=4)
    days = [dt.date(2024, 1, d) for d in range(26, 31)]
    for chosen in (days[:2], days[2:]):
        out = jobs.run_days(spark, "lab_days", str(tmp_path / "gold"), chosen)
    assert out["version"] == 2 and out["audit"]["sites_covered"] == 10
    base = {n: spark.table(f"lab_days.{n}") for n in schemas.BASE_TABLES}
    dim = [base[n] for n in ("sites", "regions", "business_units")]
    assert rows_of(incremental.gold(spark, str(tmp_path / "gold"), *dim)) == rows_of(pipeline.build(base))


# -- dry run ------------------------------------------------------------------


def sources(spark):
    base = {n: spark.createDataFrame([], getattr(schemas, n.upper())) for n in schemas.BASE_TABLES}
    return base


def kinds(found):
    return [(p.dataset, p.kind) for p in found]


def test_lab_graph_has_no_problems_and_starts_no_job(spark):
    spark.sparkContext.setJobGroup("dry", "dry run")
    try:
        assert graph.LAB.problems(spark, sources(spark)) == []
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("dry")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert graph.LAB.build(spark, sources(spark), "daily_site_consumption").schema.fieldNames() == schemas.GOLD_COLUMNS


def test_each_mistake_is_one_problem(spark):
    good = sources(spark)
    r = good["meter_readings"]
    assert kinds(graph.LAB.problems(spark, {n: d for n, d in good.items() if n != "sites"})) == [("sites", "missing")]
    assert kinds(graph.LAB.problems(spark, good | {"meter_readings": r.withColumnRenamed("kwh_consumed", "kwh")})) == [("meter_readings", "columns")]
    found = graph.LAB.problems(spark, good | {"meter_readings": r.withColumn("kwh_consumed", F.col("kwh_consumed").cast("string"))})
    assert kinds(found) == [("meter_readings", "type")] and "string" in str(found[0])
    with pytest.raises(ValueError, match="kwh_consumed is string"):
        graph.LAB.build(spark, good | {"meter_readings": r.withColumn("kwh_consumed", F.col("kwh_consumed").cast("string"))}, "silver_readings")


def test_mistakes_inside_the_graph(spark):
    x = schemas.REGIONS
    ok = graph.Dataset("a", x)
    good = {"a": spark.createDataFrame([], x)}
    broken = graph.Dataset("b", x, ("a",), lambda a: a.select("nothing"))
    typed = graph.Dataset("c", x, ("b",), lambda b: b.withColumn("timezone", F.lit(1)))
    assert kinds(graph.Graph([ok, broken, typed]).problems(spark, good)) == [("b", "analysis"), ("c", "type")]
    lost = graph.Dataset("d", x, ("zz",), lambda z: z)
    assert kinds(graph.Graph([ok, lost]).problems(spark, good)) == [("d", "missing")]
    one, two = graph.Dataset("e", x, ("f",), lambda f: f), graph.Dataset("f", x, ("e",), lambda e: e)
    assert kinds(graph.Graph([ok, one, two]).problems(spark, good)) == [("e", "ring")]
    assert kinds(graph.Graph([ok, ok]).problems(spark, good)) == [("a", "twice")]
    swapped = graph.Dataset("g", x, ("a",), lambda a: a.select("timezone", "region_id", "region_name"))
    assert kinds(graph.Graph([ok, swapped]).problems(spark, good)) == [("g", "columns")]


def test_validate_knows_types(spark):
    df = spark.createDataFrame([], schemas.REGIONS)
    assert quality.validate({"regions": df}, {"regions": schemas.REGIONS}) == []
    assert len(quality.validate({"regions": df.withColumn("timezone", F.lit(1.5))}, {"regions": schemas.REGIONS})) == 1


def test_pipeline_job_stops_at_the_dry_run(spark):
    jobs.seed_lab(spark, "lab_dry", AS_OF, dt.datetime(2024, 1, 30, 12), days=1)
    bad = spark.table("lab_dry.sites").withColumn("square_footage", F.col("square_footage").cast("string"))
    tables.save_table(spark.createDataFrame(bad.collect(), bad.schema), "lab_dry.sites")
    with pytest.raises(ValueError, match="square_footage is string"):
        jobs.run_pipeline(spark, "lab_dry")
    assert not spark.catalog.tableExists("lab_dry.silver_readings")


# -- model versions -----------------------------------------------------------


def test_old_model_versions_score_the_same_in_another_session(spark, tmp_path):
    root = str(tmp_path / "models")
    first = forecast.fit_forecast(gold_for(spark, {"SITE-0001": [1.0, 2.0, 3.0, 4.0], "SITE-0002": [5.0]}))
    assert forecast.model_versions(spark, root, "daily_kwh") is None
    assert forecast.save_model(first, root, "daily_kwh") == 1
    before = sorted(map(tuple, forecast.forecast(forecast.load_model(spark, root, "daily_kwh"), 3).collect()))
    assert before == sorted(map(tuple, forecast.forecast(first, 3).collect()))
    second = forecast.fit_forecast(gold_for(spark, {"SITE-0001": [9.0, 7.0, 3.0, 4.0, 1.0]}))
    assert forecast.save_model(second, root, "daily_kwh", note="other data") == 2
    other = spark.newSession()
    assert sorted(map(tuple, forecast.forecast(forecast.load_model(other, root, "daily_kwh", 1), 3).collect())) == before
    assert forecast.load_model(other, root, "daily_kwh").collect()[0]["n_days"] == 5
    known = {r["version"]: r for r in forecast.model_versions(other, root, "daily_kwh").collect()}
    assert (known[1]["n_sites"], known[2]["n_sites"], known[2]["formula"]) == (2, 1, "other data")
    assert (known[2]["fit_from"], known[2]["fit_to"]) == (dt.date(2024, 1, 1), dt.date(2024, 1, 5))
    assert "slope_kwh_per_day" in known[1]["formula"]
    for missing in (("daily_kwh", 3), ("nothing", None)):
        with pytest.raises(ValueError):
            forecast.load_model(spark, root, *missing)


# -- table function -----------------------------------------------------------


def test_another_session_calls_the_catalogs_table_function(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS lab_fn")
    tables.save_table(gold_for(spark, {"SITE-0001": [1.0] * 9 + [50.0], "SITE-0002": [1.0] * 9 + [70.0]}), "lab_fn.daily_site_consumption")
    name = sql_functions.create_get_site_anomalies(spark, "lab_fn")
    assert name == "lab_fn.get_site_anomalies"
    other = spark.newSession()
    other.sql("USE lab_fn")  # table functions are called without a schema's name
    got = other.sql("SELECT site_id, total_kwh FROM get_site_anomalies('SITE-0002', 30, DATE'2024-01-10')")
    assert [tuple(r) for r in got.collect()] == [("SITE-0002", 70.0)]
    with pytest.raises(AnalysisException):
        spark.newSession().sql("SELECT * FROM get_site_anomalies('SITE-0002', 30)").collect()
    with pytest.raises(ValueError):
        sql_functions.create_get_site_anomalies(spark, "lab; drop")
