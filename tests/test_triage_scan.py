"""Triage straight from the readings: one scan, the same rows as from a gold table."""

import random

from sitewatts.operators import filters
from sitewatts.plans import catalog, pipeline, triage
from tests.conftest import SF_SMALL
from tests.helpers import AS_OF, DAY0, dims, readings_df


def test_one_scan(spark):
    plan = catalog.cmp5_triage(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("events.parquet") == 1


def test_equals_triage_of_gold(spark):
    import datetime as dt

    t = dims(spark)
    rng = random.Random(3)
    rows = [
        {"site_id": rng.choice(["SITE-0001", "SITE-0002", "nowhere", None]), "reading_timestamp": DAY0 + dt.timedelta(days=d, minutes=m),
         "kwh_consumed": rng.choice([1.0, 1.0, 2.0, 90.0, -1.0, None, float("nan") if d == 3 else 5.0]),
         "status": rng.choice(["normal"] * 6 + ["warning", "error", None]), "temperature_c": rng.choice([10.0, 20.0, 30.0, None])}
        for d in range(25) for m in (0, 15, 30)
    ]
    # a day of errors only
    rows += [{"site_id": "SITE-0002", "reading_timestamp": DAY0 + dt.timedelta(days=26), "status": "error"}]
    rows += [{"site_id": s, "reading_timestamp": DAY0 + dt.timedelta(days=27), "kwh_consumed": 900.0} for s in ("SITE-0002", "SITE-0005")]
    r = readings_df(spark, rows)
    window = (DAY0.date(), AS_OF)
    gold = pipeline.build_gold(r, t["sites"], t["regions"], t["business_units"])
    want = triage.triage(gold, t["sites"], r, window)
    got = triage.triage_readings(r, t["sites"], t["regions"], t["business_units"], window)
    assert got.columns == want.columns and list(map(repr, got.collect())) == list(map(repr, want.collect()))
    assert filters.anomalies(gold).count() > 0 and got.count() > 0
