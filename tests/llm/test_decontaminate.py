import random

import pytest

from sitewatts.llm import decontaminate as dc
from tests.llm import helpers as h


def contained(rows, items):
    """(doc, item) whose words stand in the document one after the other."""
    out = set()
    for i, text in rows:
        doc = f" {' '.join(h.words(text))} "
        out |= {(i, k) for k, item in items if len(h.words(item)) >= dc.LEAST_WORDS and f" {' '.join(h.words(item))} " in doc}
    return out


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = _step(row, x, b)
    return row[-1]


def _step(row, x, b):
    new = [0]
    for k, y in enumerate(b):
        new.append(row[k] + 1 if x == y else max(row[k + 1], new[k]))
    return new


def test_common_subsequence():
    rng = random.Random(4)
    for _ in range(50):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(30))] for _ in range(2))
        assert dc.common_subsequence(a, b) == lcs(a, b)


def test_every_planted_copy_is_found_and_nothing_else(spark):
    import pandas as pd

    sf = "/root/testdata/sf0.01"
    docs, items = h.documents(sf), pd.read_parquet(f"{sf}/benchmark.parquet")
    rows, pool = (list(zip(t.iloc[:, 0].tolist(), t.text.tolist(), strict=True)) for t in (docs, items))
    got = {(r.doc_id, r.item_id) for r in dc.op4_decontamination(spark, sf).collect()}
    want = contained(rows, pool)
    assert want and want <= got
    for i, k in got - want:  # anything more has to hold most of the item in order
        item, doc = h.words(dict(pool)[k]), h.words(dict(rows)[i])
        assert lcs(item, doc) >= dc.PARAPHRASE * len(item)


def test_recall_of_copies_at_any_place_and_of_paraphrases(spark):
    """Brute force over 300 planted items: recall of the latent search is at least 0.9 (measured: 1.0)."""
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(4000)]
    common = [f"c{k}" for k in range(30)]
    prose = lambda n: [rng.choice(common) if rng.random() < 0.4 else rng.choice(vocabulary) for _ in range(n)]
    items = [(k, prose(rng.randrange(10, 60))) for k in range(300)]
    rows = []
    for k, words in items:
        before, after = prose(rng.randrange(200)), prose(rng.randrange(200))
        changed = [x for w in words for x in ([w] if rng.random() > 0.1 else [w, rng.choice(vocabulary)])]
        rows.append((k, " ".join([*before, *words, *after])))
        rows.append((1000 + k, " ".join([*before, *changed, *after])))
        rows.append((2000 + k, " ".join([*before, *after])))
    bench = h.frame(spark, [(k, " ".join(w)) for k, w in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in dc.contaminated(h.frame(spark, rows), bench).collect()}
    assert sum((k, k) in got for k, _ in items) >= 0.99 * len(items)
    paraphrases = sum((1000 + k, k) in got for k, _ in items)
    print(f"{paraphrases} of {len(items)} paraphrases found")
    assert paraphrases >= 0.9 * len(items)
    assert not any(i >= 2000 for i, _ in got)


def test_answers_decide_on_paraphrases():
    item = list(range(20))
    need = dc.Counter(item)
    around = [*range(14), 90, 91]
    assert dc.checked(item, need, [12, 13], around) == (0.7, 1.0, True)
    assert dc.checked(item, need, [18, 19], around) == (0.7, 0.0, False)
    assert dc.checked(item, need, [18, 19], list(range(18))) == (0.9, 0.0, True)
    assert dc.checked(item, need, [], [5, 4, 3]) == (0.15, 0.0, False)


def test_blocks_bound_the_query_set(monkeypatch):
    monkeypatch.setattr(dc, "BLOCK_PASSAGES", 5)
    rows = [(k, "w " * n, "") for k, n in enumerate((10, 60, 60, 3, 500, 10))]
    blocks = list(dc.blocks(iter(rows)))
    assert [r for b in blocks for r in b] == rows
    assert all(len(b) == 1 or sum(len(dc.item_windows(len(r[1].split()))) for r in b) <= 5 for b in blocks)


@pytest.mark.parametrize("stage", [False, True])
def test_odd_rows(spark, extra, stage):
    item = "the very long question about seven green apples has the answer ten."
    items = [(1, item), (2, None), (3, ""), (4, "two words"), (1, item)]
    bench = h.frame(spark, items, "item_id long, text string")
    rows = [*h.odd_rows(), (70, f"see: {item.upper()} end"), (70, f"see: {item.upper()} end"), (None, item)]
    docs = extra(h.frame(spark, rows))
    if stage:
        out = dc.without_contaminated(docs, bench)
        assert out.columns == docs.columns
        assert sorted((r.doc_id or -1, r.text or "") for r in out.collect()) == sorted((i or -1, t or "") for i, t in h.odd_rows())
    else:
        got = sorted(((r.doc_id or -1), r.item_id) for r in dc.contaminated(docs, bench).collect())
        assert got == [(-1, 1)] * 2 + [(70, 1)] * 4
        empty = h.frame(spark, [])
        assert dc.contaminated(empty, bench).count() == 0
        assert dc.contaminated(docs, h.frame(spark, [], "item_id long, text string")).count() == 0


def test_repeated_and_templated_items_are_found_in_other_prose(spark):
    """Words that many items hold weigh nothing; items made of them have to be found all the same."""
    rng = random.Random(9)
    vocabulary = [f"w{k}" for k in range(4000)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    repeated = "which seven green apples did the old farmer sell before noon today"
    items = [(k, repeated) for k in range(5)]
    items += [(10 + k, f"what is the capital of the country named x{k}") for k in range(10)]
    items += [(100 + k, prose(20)) for k in range(85)]
    rows = [(k, prose(300)) for k in range(200)]
    for k, item in items:
        rows += [(1000 + 10 * k + c, f"{prose(20 + c)} {item} {prose(60)}") for c in range(3)]
    bench = h.frame(spark, items, "item_id long, text string")
    want = contained(rows, items)
    assert len(want) == 3 * (5 * 5 + 95)
    docs = h.frame(spark, rows)
    got = {(r.doc_id, r.item_id) for r in dc.contaminated(docs, bench).collect()}
    assert want <= got
    assert all(i >= 1000 for i, _ in got)
    assert {r.doc_id for r in dc.without_contaminated(docs, bench).collect()} == set(range(200))


def test_short_items_are_found_exactly(spark):
    items = [(1, "who wrote the red book", None), (2, "seven green apples", "ten"), (3, "seven green apples", None), (4, "why?", "because"),
             (5, "who wrote the red book", "nobody knows")]
    bench = h.frame(spark, items, "item_id long, text string, answer string")
    filler = " ".join(f"f{k}" for k in range(80))
    texts = {
        1: f"{filler} Who wrote the RED book? {filler}", 2: f"{filler} who wrote the old red book {filler}", 3: "who wrote the red book",
        4: f"{filler} seven green apples make ten. {filler}", 5: f"seven green apples {filler} ten", 6: "why, because", 7: "why not",
        8: f"who wrote the red book: nobody knows {filler}", 9: "who wrote the", 10: "red book",
    }
    got = {(r.doc_id, r.item_id) for r in dc.contaminated(h.frame(spark, list(texts.items())), bench).collect()}
    assert got == {(1, 1), (3, 1), (4, 2), (6, 4), (8, 1), (8, 5)}
    left = {r.doc_id for r in dc.without_contaminated(h.frame(spark, list(texts.items())), bench).collect()}
    assert left == {2, 5, 7, 9, 10}


def test_the_best_place_counts(spark):
    rng = random.Random(21)
    item = [f"w{rng.randrange(4000)}" for _ in range(40)]
    filler = lambda n: [f"f{rng.randrange(4000)}" for _ in range(n)]
    text = [*filler(100), *item[:35], *filler(200), *item, *filler(50)]
    bench = h.frame(spark, [(1, " ".join(item))], "item_id long, text string")
    got = dc.contaminated(h.frame(spark, [(1, " ".join(text))]), bench).collect()
    assert [(r.lcs, r.answer, r.contaminated) for r in got] == [(1.0, 1.0, True)]


@pytest.mark.parametrize(("size", "passes"), [(1 << 30, 1), (1, 6)])
def test_blocks_of_the_benchmark_share_passes(spark, monkeypatch, size, passes):
    monkeypatch.setattr(dc, "BLOCK_PASSAGES", 5)
    monkeypatch.setattr(dc, "PASS_BYTES", size)
    rng = random.Random(23)
    items = [(k, " ".join(f"w{rng.randrange(4000)}" for _ in range(20))) for k in range(30)]
    docs = h.frame(spark, [(k, f"before {t} after") for k, t in items] + [(99, "nothing")])
    bench = h.frame(spark, items, "item_id long, text string")
    assert len(list(dc.indexed(docs, bench))) == passes
    assert {(r.doc_id, r.item_id) for r in dc.contaminated(docs, bench).collect()} == {(k, k) for k, _ in items}
    assert [r.doc_id for r in dc.without_contaminated(docs, bench).collect()] == [99]


def test_directions_come_to_the_driver_without_rows(spark, monkeypatch):
    """The sums reach the driver as Arrow; the directions are the right singular vectors."""
    import numpy as np
    from pyspark.sql.classic.dataframe import DataFrame

    rng = np.random.default_rng(3)
    height, dense = 1100, np.zeros((9, 1100))
    matrix = []
    for k in range(9):
        at = np.sort(rng.choice(height, 40, replace=False))
        matrix.append((at, rng.random(40) + 1 + k))
        dense[k, at] = matrix[-1][1]

    def refuse(self):
        raise AssertionError("rows were collected")

    monkeypatch.setattr(DataFrame, "collect", refuse)
    got = dc.basis(spark, matrix, height)
    want = np.linalg.svd(dense, full_matrices=False)[2][: got.shape[1]]
    assert np.allclose(np.abs((got.T * want).sum(axis=1)), 1)
