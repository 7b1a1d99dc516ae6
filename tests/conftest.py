import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sitewatts import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="sitewatts-wh-")
    s = get_session(
        "local[4]",
        app_name="sitewatts-tests",
        shuffle_partitions=8,
        extra_conf={
            "spark.sql.warehouse.dir": warehouse,
            "spark.driver.memory": "4g",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    sf = os.environ.get("SITEWATTS_ORACLE_SF", SF_SMALL)
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con
