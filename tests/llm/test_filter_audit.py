"""Filter audit: transducer and hash table against re and sets, replay against brute force."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from sitewatts.llm import filter_audit
from tests.llm.helpers import ODD_TEXTS, SF, documents

DOCS = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality int, toxic int"


def brute_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return (len(words), len(set(words)), sum("A" <= c <= "Z" for c in text), len(text), sum(c in "#$%&*|" for c in text))


def brute(docs, labels):
    """By the contract, row by row and order by order."""
    good, toxic = ({i for i, *marks in labels if marks[k] == 1 and i is not None} for k in (0, 1))
    smallest = {}
    for i, text, _ in docs:
        if i is not None:
            smallest[text or ""] = min(i, smallest.get(text or "", i))
    rows = []
    for i, text, lang in docs:
        n, d, caps, points, symbols = brute_measures(text)
        fails = {
            "A": n < 200, "B": 100 * d < 50 * n, "C": 100 * caps > 3 * points, "D": symbols > 0,
            "E": i is not None and i > smallest[text or ""],
        }
        rows.append((lang or "", fails, i in good, i in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        share = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            alive = mine
            for step, f in enumerate(order, 1):
                lost = [r for r in alive if r[1][f]]
                alive = [r for r in alive if not r[1][f]]
                out[part, order, step] = [
                    len(alive), len(lost), sum(r[1][f] for r in mine) - len(lost),
                    sum(r[1][f] and sum(r[1].values()) == 1 for r in mine), sum(r[2] for r in lost), sum(r[3] for r in lost),
                ]
                share[f] += len(lost)
        for (p, order, step), row in out.items():
            if p == part:
                row.append(share[order[step - 1]])
    return out


def got(df):
    rows = df.collect()
    found = {tuple(r[:3]): list(r[3:]) for r in rows}
    assert len(found) == len(rows)
    return found


def audit(spark, docs, labels):
    rows = filter_audit.verdicts(docs if hasattr(docs, "columns") else spark.createDataFrame(docs, DOCS))
    return filter_audit.replay(filter_audit.with_labels(rows, spark.createDataFrame(labels, LABELS)))


def measured(texts):
    found = filter_audit.measured(pa.array(texts, pa.string()))
    return list(zip(*(found[c].tolist() for c in ("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")), strict=True))


def test_measures_of_odd_and_random_texts():
    rng = random.Random(1)
    alphabet = "aabbAB \t\n\x0b\x1cé日🙂#$%&*|x\xa0\x85"
    texts = [*ODD_TEXTS, *("".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(3000)), "", "end"]
    assert measured(texts) == [brute_measures(t) for t in texts]
    assert measured(texts[7:9]) == [brute_measures(t) for t in texts[7:9]]
    assert measured([]) == [] and measured([None, ""]) == [(0,) * 5] * 2


def test_measures_of_a_slice_of_an_array():
    whole = pa.array(["one two", "two two", None, "THREE # three"])
    found = filter_audit.measured(whole.slice(1, 3))
    assert found["n_words"].tolist() == [2, 0, 3] and found["n_distinct"].tolist() == [1, 0, 3]


def test_words_that_share_a_hash_are_told_apart_by_bytes(monkeypatch):
    monkeypatch.setattr(filter_audit, "_hashes", lambda data, start, length: np.zeros(len(start), np.uint64))
    texts = ["ab cd ab ef cd gh", "ab ab xy", "a b c a b c"]
    assert measured(texts) == [brute_measures(t) for t in texts]


def test_query_equals_brute_force_on_the_whole_table(spark):
    import pandas as pd

    docs = list(documents(SF)[["doc_id", "text", "lang"]].itertuples(index=False, name=None))
    labels = list(pd.read_parquet(f"{SF}/labels.parquet")[["doc_id", "quality", "toxic"]].itertuples(index=False, name=None))
    found = filter_audit.op13_filter_audit(spark, SF)
    assert found.columns == [
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley",
    ]
    assert [t for _, t in found.dtypes] == ["string", "string", "int"] + ["bigint"] * 7
    assert got(found) == brute(docs, labels)


def test_odd_rows(spark, extra):
    long = " ".join(f"w{k}" for k in range(250))
    docs = [
        *((k, t, (None, "", "en")[k % 3]) for k, t in enumerate(ODD_TEXTS)),
        (3, long, "en"), (20, long, "de"), (21, long + " #", "de"), (3, long, "en"), (None, long, "de"), (None, None, None),
        (22, "word " * 300, "de"), (23, "UP " + long, "fr"),
    ]
    labels = [(20, 1, 0), (20, 0, 1), (3, 1, None), (None, 1, 1), (22, None, 1), (99, 1, 1), (0, 1, 0)]
    df = extra(spark.createDataFrame(docs, DOCS))
    for c in ("fails", "digest", "first", "toxic", "good", "step"):
        df = df.selectExpr("*", f"'x' AS {c}")
    assert got(audit(spark, df, labels)) == brute(docs, labels)


def test_empty_tables(spark):
    assert audit(spark, [], [(1, 1, 1)]).count() == 0
    assert got(audit(spark, [(1, "a", "en")], [])) == brute([(1, "a", "en")], [])


@pytest.mark.parametrize("filters", ["A", "ABC"])
def test_replay_of_other_filters(spark, filters):
    counted = spark.createDataFrame([("p", 0, 5, 1, 0), ("p", 1, 7, 0, 1)], "part string, fails int, n long, good int, toxic int")
    found = {r.filter_order: r for r in filter_audit.replay(counted, filters).where("step = 1").collect()}
    assert found[filters].removed == 7 and found[filters].kept == 5 and found[filters].toxic_lost == 7
