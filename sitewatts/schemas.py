"""Schemas of the four base tables and the two derived tables.

Column names and types are fixed by the data model (see FIXTURES.md): every
field is nullable, timestamps are UTC instants at the start of the 15-minute
interval.
"""

from __future__ import annotations

from pyspark.sql import types as T

REGIONS = T.StructType(
    [
        T.StructField("region_id", T.StringType()),
        T.StructField("region_name", T.StringType()),
        T.StructField("timezone", T.StringType()),
    ]
)

BUSINESS_UNITS = T.StructType(
    [
        T.StructField("business_unit_id", T.StringType()),
        T.StructField("business_unit_name", T.StringType()),
        T.StructField("description", T.StringType()),
    ]
)

SITES = T.StructType(
    [
        T.StructField("site_id", T.StringType()),
        T.StructField("site_name", T.StringType()),
        T.StructField("site_type", T.StringType()),
        T.StructField("business_unit_id", T.StringType()),
        T.StructField("region_id", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("square_footage", T.IntegerType()),
        T.StructField("installation_date", T.DateType()),
        T.StructField("voltage_nominal", T.IntegerType()),
    ]
)

METER_READINGS = T.StructType(
    [
        T.StructField("reading_id", T.StringType()),
        T.StructField("site_id", T.StringType()),
        T.StructField("reading_timestamp", T.TimestampType()),
        T.StructField("kwh_consumed", T.DoubleType()),
        T.StructField("kw_demand", T.DoubleType()),
        T.StructField("voltage", T.DoubleType()),
        T.StructField("temperature_c", T.DoubleType()),
        T.StructField("status", T.StringType()),
    ]
)

SITE_DIM_COLUMNS = [
    "site_id",
    "site_type",
    "business_unit_id",
    "business_unit_name",
    "region_id",
    "region_name",
    "voltage_nominal",
    "square_footage",
]

SILVER_COLUMNS = [
    "site_id",
    "reading_id",
    "reading_timestamp",
    "kwh_consumed",
    "kw_demand",
    "voltage",
    "temperature_c",
    "status",
    "site_type",
    "business_unit_id",
    "business_unit_name",
    "region_id",
    "region_name",
    "voltage_nominal",
    "square_footage",
    "reading_date",
]

_TYPES = {f.name: f.dataType for table in (REGIONS, BUSINESS_UNITS, SITES, METER_READINGS) for f in table}
_TYPES["reading_date"] = T.DateType()
SITE_DIM = T.StructType([T.StructField(c, _TYPES[c]) for c in SITE_DIM_COLUMNS])
SILVER = T.StructType([T.StructField(c, _TYPES[c]) for c in SILVER_COLUMNS])

# Attributes of a site carried into gold; (site_id, reading_date) is the key.
GOLD_ATTRIBUTES = [
    "site_type",
    "business_unit_id",
    "business_unit_name",
    "region_id",
    "region_name",
]

GOLD = T.StructType(
    [
        T.StructField("site_id", T.StringType()),
        T.StructField("site_type", T.StringType()),
        T.StructField("business_unit_id", T.StringType()),
        T.StructField("business_unit_name", T.StringType()),
        T.StructField("region_id", T.StringType()),
        T.StructField("region_name", T.StringType()),
        T.StructField("reading_date", T.DateType()),
        T.StructField("total_kwh", T.DoubleType()),
        T.StructField("peak_kw", T.DoubleType()),
        T.StructField("avg_voltage", T.DoubleType()),
        T.StructField("warning_count", T.LongType()),
        T.StructField("site_mean_kwh", T.DoubleType()),
        T.StructField("site_stddev_kwh", T.DoubleType()),
        T.StructField("deviation_pct", T.DoubleType()),
        T.StructField("anomaly_flag", T.BooleanType()),
    ]
)
GOLD_COLUMNS = GOLD.fieldNames()

GOLD_AUDIT = T.StructType(
    [
        T.StructField("total_rows", T.LongType()),
        T.StructField("anomaly_rows", T.LongType()),
        T.StructField("sites_covered", T.LongType()),
        T.StructField("first_date", T.DateType()),
        T.StructField("last_date", T.DateType()),
    ]
)

BASE_TABLES = ("regions", "business_units", "sites", "meter_readings")

# Table and column descriptions attached by the sinks.
TABLE_COMMENTS = {
    "regions": "Where sites lie, with the clock that applies there.",
    "business_units": "The organisation's units that run sites.",
    "sites": "Master data of every metered place.",
    "meter_readings": "What each meter reported, a row per quarter of an hour.",
    "silver_readings": "Usable readings, each with the master data of its site.",
    "daily_site_consumption": "A row per site and day: consumption, the site's usual level, and whether the day stands out.",
}

COLUMN_COMMENTS = {
    "regions": {
        "region_id": "Identifies the region",
        "region_name": "Display name",
        "timezone": "Zone name for converting UTC to wall-clock time",
    },
    "business_units": {
        "business_unit_id": "Identifies the unit",
        "business_unit_name": "Display name",
        "description": "Free text about its work",
    },
    "sites": {
        "site_id": "Identifies the site and its meter",
        "site_name": "Display name",
        "site_type": "What the place is used for: one of five kinds",
        "business_unit_id": "Unit that runs it",
        "region_id": "Region it lies in",
        "city": "Town",
        "state": "State or nation code",
        "square_footage": "Size in ft²; divisor of the intensity measure",
        "installation_date": "Since when it has been metered",
        "voltage_nominal": "Rated volts of its connection",
    },
    "meter_readings": {
        "reading_id": "Identifies the row",
        "site_id": "Which site reported",
        "reading_timestamp": "When the quarter hour began; an instant, shown as UTC",
        "kwh_consumed": "Energy of the quarter hour",
        "kw_demand": "Highest load within it",
        "voltage": "Mean volts measured",
        "temperature_c": "Degrees Celsius outside the meter",
        "status": "The meter's own verdict; error rows don't count as consumption",
    },
}
