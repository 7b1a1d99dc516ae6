"""Tiny hand-made inputs for fixture and property tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sitewatts import schemas
from sitewatts.plans import pipeline
from sitewatts.sources.generate import seed_dimensions

AS_OF = dt.date(2024, 1, 30)
DAY0 = dt.datetime(2024, 1, 1, 12, 0)


def dims(spark):
    return seed_dimensions(spark, AS_OF)


def readings_df(spark, rows):
    """rows: dicts with any of the reading columns; the rest get defaults."""
    out = []
    for i, r in enumerate(rows):
        out.append(
            (
                r.get("reading_id", f"R-{i + 1:08d}"),
                r.get("site_id", "SITE-0001"),
                r.get("reading_timestamp", DAY0),
                r.get("kwh_consumed", 1.0),
                r.get("kw_demand", 4.0),
                r.get("voltage", 480.0),
                r.get("temperature_c", 20.0),
                r.get("status", "normal"),
            )
        )
    return spark.createDataFrame(out, schemas.METER_READINGS)


def series_readings(spark, series: dict[str, list[float]], start: dt.datetime = DAY0):
    """One reading per day per site, kWh = the day's total."""
    rows = []
    for site, values in series.items():
        for d, v in enumerate(values):
            rows.append({"site_id": site, "reading_timestamp": start + dt.timedelta(days=d), "kwh_consumed": v})
    return readings_df(spark, rows)


def gold_for(spark, series: dict[str, list[float]]):
    t = dims(spark)
    return pipeline.build_gold(series_readings(spark, series), t["sites"], t["regions"], t["business_units"])


def daily_cents(spark, series: dict[str, list[int]]):
    """(site_id, total_cents) rows, for the baseline/flag rule alone."""
    rows = [(s, d, int(c)) for s, values in series.items() for d, c in enumerate(values)]
    df = spark.createDataFrame(rows, "site_id string, day int, total_cents long")
    return df.withColumn("total_kwh", F.col("total_cents") / F.lit(100.0))


def flags_by_site(df):
    return {
        r["site_id"]: r["n"]
        for r in df.groupBy("site_id").agg(F.count_if("anomaly_flag").alias("n")).collect()
    }
