"""With broadcasting disabled (as for dimensions past the bound), every
query that joins the raw readings must return the same rows."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

FACT_JOINS = [
    "cmp1_silver",
    "join3_enrich",
    "join8_explore_view",
    "agg15_hourly_profile_local",
    "agg15_hourly_profile_utc",
    "cmp5_triage",
    "join7_warnings_for_top_sites",
    "dq3_expectation_metrics",
]


@pytest.mark.parametrize("name", FACT_JOINS)
def test_same_rows_without_broadcast(spark, name):
    q = E.queries()[name]
    small = q(spark, SF_SMALL).collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        rows = q(spark, SF_SMALL).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert sorted(map(repr, small)) == sorted(map(repr, rows))
