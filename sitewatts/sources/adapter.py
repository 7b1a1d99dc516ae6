"""Driver tables -> the meter star schema (FIXTURES.md section 3).

The test tables are TPC-H-like (`region`, `nation`, `customer`) plus an
`events` stream. Each base table of the meter model is a projection of them;
every expression is a built-in Column, so the scans keep column pruning, and
filters on columns that are taken over as they are (``kwh_consumed``) are pushed to
the Parquet scan. Derived columns (status, the timestamp) hide theirs; a date range
of the readings is therefore put on the stored ``ts`` by ``meter_readings`` itself.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession


# The four time zones of the reference regions, in order of
# first appearance; a driver region takes the zone at r_regionkey mod 4.
TIMEZONES = ["America/New_York", "America/Chicago", "America/Los_Angeles", "America/Phoenix"]

# The five site types; a driver site takes c_custkey mod 5.
SITE_TYPES = ["factory", "warehouse", "office", "data_center", "retail"]

INSTALL_EPOCH = dt.date(2020, 1, 1)
NOMINAL_VOLTAGE = 480

# Reader schemas of the driver tables (only the columns the adapter uses).
# Passing them skips Parquet footer inference on every read.
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def _pick_sql(index_sql: str, values: list[str]) -> str:
    """SQL CASE choosing ``values[i]`` where ``index_sql`` = i."""
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index_sql} {whens} END"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "region").selectExpr(
        "CAST(r_regionkey AS STRING) AS region_id",
        "r_name AS region_name",
        f"{_pick_sql('r_regionkey % 4', TIMEZONES)} AS timezone",
    )


def business_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = read_table(spark, sf_dir, "customer").selectExpr("c_mktsegment AS business_unit_id").distinct()
    return segments.selectExpr(
        "business_unit_id",
        "business_unit_id AS business_unit_name",
        "CAST(NULL AS STRING) AS description",
    )


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    # nation is a 25-row file: the planner broadcasts it from its file-size statistics
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    return j.selectExpr(
        "CAST(c_custkey AS STRING) AS site_id",
        "c_name AS site_name",
        f"{_pick_sql('c_custkey % 5', SITE_TYPES)} AS site_type",
        "c_mktsegment AS business_unit_id",
        "CAST(n_regionkey AS STRING) AS region_id",
        "n_name AS city",
        "CAST(n_nationkey AS STRING) AS state",
        "CAST(1000 + (c_custkey % 97) * 100 AS INT) AS square_footage",
        f"date_add(DATE'{INSTALL_EPOCH.isoformat()}', CAST(c_custkey % 1000 AS INT)) AS installation_date",
        f"CAST({NOMINAL_VOLTAGE} AS INT) AS voltage_nominal",
    )


def meter_readings(
    spark: SparkSession, sf_dir: str, since: dt.date | None = None, until: dt.date | None = None
) -> DataFrame:
    """The readings; with ``since`` / ``until`` (UTC dates, both included) only those, cut at the scan."""
    events = read_table(spark, sf_dir, "events")
    if since is not None:
        events = events.where(f"ts >= TIMESTAMP_NTZ'{since.isoformat()} 00:00:00'")
    if until is not None:
        events = events.where(f"ts < TIMESTAMP_NTZ'{(until + dt.timedelta(days=1)).isoformat()} 00:00:00'")
    return events.selectExpr(
        "CAST(event_id AS STRING) AS reading_id",
        "CAST(user_id AS STRING) AS site_id",
        # NTZ wall clock read as a UTC instant, whatever the session zone
        "timestamp_micros(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)) AS reading_timestamp",
        "value AS kwh_consumed",
        "value * 4 AS kw_demand",
        "50.0D + 6.0D * CAST(get_json_object(props, '$.k') AS DOUBLE) AS voltage",
        "CAST(15 + event_id % 20 AS DOUBLE) AS temperature_c",
        "CASE WHEN event_type = 'error' THEN 'error' WHEN event_type = 'signup' THEN 'warning' "
        "ELSE 'normal' END AS status",
    )


def load_star(spark: SparkSession, sf_dir: str, **bounds: dt.date) -> dict[str, DataFrame]:
    """The four base tables of the meter model; ``bounds`` are those of ``meter_readings``."""
    return {
        "regions": regions(spark, sf_dir),
        "business_units": business_units(spark, sf_dir),
        "sites": sites(spark, sf_dir),
        "meter_readings": meter_readings(spark, sf_dir, **bounds),
    }
