"""SQL table function over the gold table (UDF1) and its DataFrame form.

``get_site_anomalies(site_id, days [, as_of])`` returns the site's flagged
rows within the past ``days`` days. The parameter shares the column's name,
so the body qualifies it as ``get_site_anomalies.site_id`` (T7: written
``WHERE site_id = site_id`` it would compare the column with itself and
return every site's rows). Order is left to the calling query (D17).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewatts.operators import filters

GOLD_VIEW = "daily_site_consumption"

_RETURNS = (
    "site_id STRING, site_type STRING, business_unit_id STRING, business_unit_name STRING, "
    "region_id STRING, region_name STRING, reading_date DATE, total_kwh DOUBLE, peak_kw DOUBLE, "
    "avg_voltage DOUBLE, warning_count BIGINT, site_mean_kwh DOUBLE, site_stddev_kwh DOUBLE, "
    "deviation_pct DOUBLE, anomaly_flag BOOLEAN"
)


def _plain(name: str) -> str:
    if not name.replace("_", "").replace(".", "").isalnum():
        raise ValueError(f"bad name {name!r}")
    return name


def _definition(create: str, function: str, gold: str) -> str:
    return f"""
        {create} {_plain(function)}(site_id STRING, days INT, as_of DATE DEFAULT current_date())
        RETURNS TABLE ({_RETURNS})
        COMMENT 'Flagged daily rows of one site within the past N days (as_of - N .. as_of and later).'
        RETURN
          SELECT {', '.join('g.' + c.split()[0] for c in _RETURNS.split(', '))} FROM {_plain(gold)} g
          WHERE g.site_id = get_site_anomalies.site_id
            AND g.anomaly_flag = TRUE
            AND g.reading_date >= date_sub(get_site_anomalies.as_of, get_site_anomalies.days)
        """


def register_get_site_anomalies(spark: SparkSession, gold_view: str = GOLD_VIEW) -> None:
    """Create the temporary SQL table function over the view ``gold_view``."""
    spark.sql(_definition("CREATE OR REPLACE TEMPORARY FUNCTION", "get_site_anomalies", gold_view))


def create_get_site_anomalies(spark: SparkSession, namespace: str) -> str:
    """Create the table function in the catalog, over the namespace's gold *table*; returns its name.

    Call it after ``USE <namespace>``: SQL takes no schema's name before a table function. It lives as long
    as the catalog: every session of the application sees it, and with a metastore every later application. Without one it is gone with the application, as the tables are.
    """
    name = f"{namespace}.get_site_anomalies"
    spark.sql(_definition("CREATE OR REPLACE FUNCTION", name, f"{namespace}.{GOLD_VIEW}"))
    return name


def site_anomalies(gold: DataFrame, site_id: str, days: int, as_of: dt.date) -> DataFrame:
    """DataFrame form of UDF1, by deviation descending."""
    rows = filters.since(filters.anomalies(filters.for_site(gold, site_id)), as_of, days)
    return rows.orderBy(F.desc_nulls_last("deviation_pct"), F.asc("reading_date"))
