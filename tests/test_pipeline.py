"""Schemas, the two gold paths, the generator, sinks, dry run, streaming."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from sitewatts import schemas
from sitewatts.operators import forecast, quality
from sitewatts.plans import pipeline
from sitewatts.sources import adapter, generate, tables
from sitewatts.streaming import silver_stream
from tests.conftest import SF_SMALL
from tests.helpers import AS_OF, dims, gold_for


def test_gold_schema_is_the_15_columns(spark):
    g = gold_for(spark, {"SITE-0001": [1.0, 2.0]})
    assert g.schema.simpleString() == schemas.GOLD.simpleString()


def test_silver_schema_is_the_16_columns(spark):
    t = adapter.load_star(spark, SF_SMALL)
    s = pipeline.silver(t["meter_readings"], t["sites"], t["regions"], t["business_units"])
    assert s.columns == schemas.SILVER_COLUMNS
    assert dict(s.dtypes)["reading_date"] == "date"


def test_both_gold_paths_agree(spark):
    t = adapter.load_star(spark, SF_SMALL)
    fast = pipeline.build(t)
    ref = pipeline.gold(pipeline.silver(t["meter_readings"], t["sites"], t["regions"], t["business_units"]))
    assert fast.exceptAll(ref).count() == 0 and ref.exceptAll(fast).count() == 0


def test_adapter_star_shapes(spark):
    t = adapter.load_star(spark, SF_SMALL)
    for name, schema in (("regions", schemas.REGIONS), ("business_units", schemas.BUSINESS_UNITS),
                         ("sites", schemas.SITES), ("meter_readings", schemas.METER_READINGS)):
        assert t[name].schema.simpleString() == schema.simpleString(), name
    assert quality.dimension_guard(t).filter("guard = 'duplicate_key'").count() == 0


def test_generator_counts_ranges_and_partition_independence(spark):
    t = dims(spark)
    end = dt.datetime(2024, 1, 30, 10)
    a = generate.generate_readings(spark, t["sites"], end, days=3)
    b = generate.generate_readings(spark, t["sites"].repartition(5), end, days=3, partitions=3)
    assert a.count() == 10 * 3 * 96
    assert a.select("reading_id").distinct().count() == 10 * 3 * 96
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    stats = a.join(t["sites"].select("site_id", "site_type"), "site_id").groupBy("site_type").agg(
        F.min("kwh_consumed").alias("lo"), F.max("kwh_consumed").alias("hi")
    ).collect()
    for r in stats:
        lo, hi = generate.BASE_KWH[r["site_type"]]
        assert r["lo"] >= lo * 0.5 - 1e-9 and r["hi"] <= hi * 1.5 * 6 + 1e-9
    v = a.agg(F.min("voltage"), F.max("voltage"), F.min("temperature_c"), F.max("temperature_c")).first()
    assert 480 * 0.98 - 0.01 <= v[0] and v[1] <= 480 * 1.02 + 0.01
    assert 15 - 0.01 <= v[2] and v[3] <= 34 + 0.01
    shares = {r["status"]: r["count"] for r in a.groupBy("status").count().collect()}
    assert shares.get("normal", 0) > 0.9 * a.count()


def test_generator_spikes_show_up_as_anomalies(spark):
    t = dims(spark)
    end = dt.datetime(2024, 1, 30, 12)
    r = generate.generate_readings(spark, t["sites"], end, days=30, anomalous=list(generate.LAB_ANOMALOUS_SITES))
    g = pipeline.build_gold(r, t["sites"], t["regions"], t["business_units"])
    flagged = {x["site_id"] for x in g.filter("anomaly_flag").select("site_id").distinct().collect()}
    assert set(generate.LAB_ANOMALOUS_SITES) <= flagged


def test_seed_dimensions(spark):
    t = generate.seed_dimensions(spark, AS_OF)
    audit = {r["table_name"]: r["row_count"] for r in tables.row_count_audit(t).collect()}
    assert audit == {"regions": 5, "business_units": 5, "sites": 10}
    days = [(AS_OF - r["installation_date"]).days for r in t["sites"].collect()]
    assert all(180 <= d <= 1800 for d in days)


def test_sinks_namespace_comments_and_materialize(spark):
    tables.ensure_namespace(spark, "sw_lab")
    tables.ensure_namespace(spark, "sw_lab")
    t = dims(spark)
    name = tables.qualified("sw_lab", "regions")
    tables.save_table(t["regions"], name)
    tables.annotate(spark, name, "Regions.", {"timezone": "IANA zone"})
    desc = {r["col_name"]: r["comment"] for r in spark.sql(f"DESCRIBE TABLE {name}").collect()}
    assert desc["timezone"] == "IANA zone"
    g = gold_for(spark, {"SITE-0001": [1.0, 2.0, 3.0]})
    back = tables.materialize(g, tables.qualified("sw_lab", "gold"), "Gold.", partition_by=None)
    assert back.count() == 3
    rows, n = tables.preview(back, 2)
    assert len(rows) == 2 and n == 3
    verdict = quality.verify_seed(tables.row_count_audit({"regions": t["regions"]}), {"regions": 5})
    assert verdict.first()["ok"]


def test_dry_run_finds_problems_without_jobs(spark):
    t = dims(spark)
    good = {"regions": t["regions"]}
    assert quality.validate(good, {"regions": ["region_id", "region_name", "timezone"]}) == []
    bad = {"regions": t["regions"].select("region_id")}
    problems = quality.validate(bad, {"regions": ["region_id", "region_name", "timezone"], "gold": []})
    assert len(problems) == 2


def test_forecast_recovers_a_linear_trend(spark):
    g = gold_for(spark, {"SITE-0001": [10.0 + 2 * d for d in range(21)], "SITE-0002": [5.0]})
    model = forecast.fit_forecast(g)
    m = {r["site_id"]: r for r in model.collect()}
    assert abs(m["SITE-0001"]["slope_kwh_per_day"] - 2.0) < 1e-9
    assert abs(m["SITE-0001"]["intercept_kwh"] - 10.0) < 1e-9
    assert m["SITE-0002"]["slope_kwh_per_day"] == 0.0
    f = {(r["site_id"], r["horizon_day"]): r["forecast_kwh"] for r in forecast.forecast(model, 3).collect()}
    assert abs(f[("SITE-0001", 1)] - (10.0 + 2 * 21)) < 1e-6
    assert f[("SITE-0002", 3)] == 5.0
    one = forecast.forecast(model, 2, ["SITE-0002"]).count()
    assert one == 2


def test_streaming_silver_matches_batch(spark):
    base = tempfile.mkdtemp(prefix="sitewatts-stream-")
    src, sink, ckpt = (os.path.join(base, x) for x in ("src", "sink", "ckpt"))
    t = adapter.load_star(spark, SF_SMALL)
    t["meter_readings"].repartition(3).write.parquet(src)
    stream = silver_stream.read_readings_stream(spark, src, max_files_per_trigger=1)
    q = silver_stream.start_silver_sink(
        silver_stream.silver_stream(stream, t["sites"], t["regions"], t["business_units"]), sink, ckpt
    )
    q.awaitTermination(120)
    got = spark.read.parquet(sink)
    want = pipeline.silver(spark.read.parquet(src), t["sites"], t["regions"], t["business_units"])
    assert got.count() == want.count()
    assert got.select(*schemas.SILVER_COLUMNS).exceptAll(want).count() == 0


def test_seed_and_run_lab_jobs(spark):
    from sitewatts.plans import jobs

    audit = {r["table_name"]: r["row_count"] for r in jobs.seed_lab(
        spark, "sw_job", AS_OF, dt.datetime(2024, 1, 30, 9), days=30).collect()}
    assert audit == {"regions": 5, "business_units": 5, "sites": 10, "meter_readings": 28_800}
    out = jobs.run_pipeline(spark, "sw_job")
    assert out["expectations"]["rows"] > 28_000
    assert out["expectations"]["non_negative_kwh__failed"] == 0
    a = out["audit"]
    assert a["sites_covered"] == 10 and a["total_rows"] == 310 and a["anomaly_rows"] > 0
    flagged = {r["site_id"] for r in spark.table("sw_job.daily_site_consumption").filter("anomaly_flag").collect()}
    assert set(generate.LAB_ANOMALOUS_SITES) <= flagged
    # the lab's own checks: the table function for SITE-0005 over 14 days, a two-site forecast
    from sitewatts.functions import sql_functions

    sql_functions.register_get_site_anomalies(spark, "sw_job.daily_site_consumption")
    rows = spark.sql("SELECT * FROM get_site_anomalies('SITE-0005', 14, DATE'2024-01-30')").collect()
    assert rows and all(r["site_id"] == "SITE-0005" and r["anomaly_flag"] for r in rows)
    model = forecast.fit_forecast(spark.table("sw_job.daily_site_consumption"))
    sample = forecast.forecast(model, 7, ["SITE-0005", "SITE-0010"]).collect()
    assert len(sample) == 14 and {r["site_id"] for r in sample} == {"SITE-0005", "SITE-0010"}


def test_checkpointed_cuts_lineage(spark):
    g = gold_for(spark, {"SITE-0001": [1.0, 2.0, 3.0]})
    c = tables.checkpointed(g)
    assert c.count() == 3
    plan = c._jdf.queryExecution().logical().toString()
    assert "Window" not in plan


def test_overview_and_exploration_composites(spark):
    from sitewatts.plans import questions

    t = adapter.load_star(spark, SF_SMALL)
    gold = pipeline.build(t)
    ov = questions.overview(gold, AS_OF)
    assert set(ov) == {"kpi", "per_day", "bu_type", "top_deviation"}
    assert ov["kpi"].count() == 1 and ov["top_deviation"].count() == 10
    ranged = questions.overview(gold, AS_OF, "2024-01-16", "2024-01-30")
    assert ranged["per_day"].count() <= ov["per_day"].count()
    ex = {p: questions.exploration(t["meter_readings"], t["sites"], t["regions"], lambda: gold, p) for p in questions.EXPLORATION}
    counts = {k: v.count() for k, v in ex.items()}
    assert counts["span"] == 1 and counts["profile"] == 4 and counts["hourly_utc"] > 0
    assert all(n > 0 for n in counts.values())
