import corpus_pipeline as cp
from sitewatts.llm import decontaminate, near_dups, pii, toxicity
from sitewatts.llm import packing as pk
from tests.llm import helpers as h
from tests.llm.test_decontaminate import contained
from tests.llm.test_near_dups import brute
from tests.llm.test_packing import check
from tests.llm.test_pii import base


def test_stages_against_their_own_inputs(spark):
    import pandas as pd

    sf = h.SF
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in cp.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, sf)
        rows = out.collect()
        if name == "toxicity":
            scores = {r.doc_id: r.predicted for r in toxicity.op7_toxicity(spark, sf).collect()}
            assert {r.doc_id for r in rows} == {i for i in before if not scores[i]}
        if name == "near_duplicates":
            classes = brute([(i, r.text) for i, r in before.items()])
            assert {r.doc_id for r in rows} == {i for i, c in classes.items() if i == c}
        if name == "decontamination":
            items = pd.read_parquet(f"{sf}/benchmark.parquet")
            pool = list(zip(items.item_id, items.text, strict=True))
            leaks = {i for i, _ in contained([(i, r.text) for i, r in before.items()], pool)}
            gone = set(before) - {r.doc_id for r in rows}
            pairs = decontaminate.contaminated(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()
            assert leaks <= gone == {p.doc_id for p in pairs}
        if name == "personal_data":
            assert {r.doc_id for r in rows} == set(before)
            assert all(r.n_chars == len(r.text) and not base(r.text) for r in rows)
            assert all(r.text == before[r.doc_id].text or pii.CERTAIN for r in rows)
        if name == "packing":
            check([(i, r.text) for i, r in before.items()], rows, pk.WINDOW)
        else:
            assert out.columns == columns
            assert all(r == before[r.doc_id] for r in rows) or name == "personal_data"
        kept[name] = len(rows)
        docs = spark.createDataFrame(rows, out.schema)
    assert kept["decontamination"] > 0.6 * len(h.documents())


def test_run_is_the_stages_one_after_the_other(spark):
    rows = cp.run(spark, h.SF).collect()
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} == set(rows[0].asDict())
    assert cp.ORACLE_SQL is None and len(cp.STAGES) == 5


def test_copies_and_odd_rows(spark, extra):
    rows = [*h.odd_rows(), (40, "one two three four five six"), (41, "one two three four five six!"), (None, "")]
    docs = extra(h.frame(spark, rows))
    out = near_dups.without_copies(docs)
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.collect()]
    assert ids.count(None) == 2 and ids.count(5) == 1 and 40 in ids and 41 not in ids and 6 not in ids
