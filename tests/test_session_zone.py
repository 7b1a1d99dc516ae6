"""Results do not depend on spark.sql.session.timeZone (trap T2 at query level)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

DATE_SENSITIVE = [
    "cmp2_gold",
    "agg12_status_counts",
    "agg15_hourly_profile_utc",
    "agg15_hourly_profile_local",
    "agg6_anomalies_per_day_30d",
    "udf4_forecast",
]


@pytest.mark.parametrize("name", DATE_SENSITIVE)
def test_same_rows_in_any_session_zone(spark, name):
    q = E.queries()[name]
    utc = sorted(map(repr, q(spark, SF_SMALL).collect()))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        other = sorted(map(repr, q(spark, SF_SMALL).collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert utc == other
