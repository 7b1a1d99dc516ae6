"""Every registered query vs its DuckDB oracle (sf0.001 by default; SITEWATTS_ORACLE_SF overrides)."""

import hashlib
import math
import os

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


ORACLE = {name: sql for name, sql in E.oracle_sql().items() if not name.startswith("op") and name != "pipeline"}
SF = os.environ.get("SITEWATTS_ORACLE_SF", SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(rows, df.columns) == _digest(orows, ocols)


def test_every_query_has_an_oracle_or_is_rows_only():
    own = {name for name in E.queries() if not name.startswith("op") and name != "pipeline"}
    assert own - set(ORACLE) <= {"lim1_preview"}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["site_id", "site_type"]
    assert df.count() > 0
