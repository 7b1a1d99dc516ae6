"""Ranking operators against a pandas brute force over the collected gold (sf0.001)."""

import pandas as pd

from sitewatts.operators import topk, windows
from sitewatts.plans import pipeline
from sitewatts.sources import adapter
from tests.conftest import SF_SMALL


def _gold(spark):
    return pipeline.build(adapter.load_star(spark, SF_SMALL))


def test_top_consumers_per_unit(spark):
    g = _gold(spark)
    got = {(r["business_unit_name"], r["rank"]): r["site_id"] for r in windows.top_consumers(g, "2024-01", 3).collect()}
    pdf = g.select("business_unit_name", "site_id", "reading_date", "total_kwh").toPandas()
    pdf["cents"] = (pdf.total_kwh * 100).round().astype("int64")
    per = pdf.groupby(["business_unit_name", "site_id"], as_index=False).cents.sum()
    want = {}
    for bu, grp in per.groupby("business_unit_name"):
        ordered = grp.sort_values(["cents", "site_id"], ascending=[False, True]).site_id.tolist()[:3]
        for i, site in enumerate(ordered, 1):
            want[(bu, i)] = site
    assert got == want


def test_top_deviation(spark):
    g = _gold(spark)
    got = [(r["site_id"], r["reading_date"]) for r in topk.top_deviation(g, 10).collect()]
    pdf = g.select("site_id", "reading_date", "deviation_pct").toPandas()
    pdf = pdf.sort_values(["deviation_pct", "site_id", "reading_date"], ascending=[False, True, True], na_position="last")
    want = list(pdf.head(10).itertuples(index=False, name=None))
    assert got == [(s, d) for s, d, _ in want]
    assert isinstance(pdf, pd.DataFrame)
