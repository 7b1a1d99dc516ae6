import random

import numpy as np
import pyarrow as pa
import pytest

from sitewatts.llm import near_dups as nd
from sitewatts.llm.components import components
from tests.llm import helpers as h


def test_similarity_matches_definition():
    rng = random.Random(3)
    for _ in range(30):
        a = {rng.randrange(40): rng.randrange(1, 5) for _ in range(25)}
        b = {rng.randrange(40): rng.randrange(1, 5) for _ in range(25)}
        want = h.similarities(h.Counter(a), h.Counter(b))
        ka, kb = np.array(sorted(a)), np.array(sorted(b))
        got = nd.similarity(ka, np.array([a[k] for k in ka]), kb, np.array([b[k] for k in kb]))
        assert got == pytest.approx(want)


def test_registers_estimate_probability_jaccard():
    rng = random.Random(5)
    base = [f"w{rng.randrange(3000)}" for _ in range(400)]
    errors = []
    for k in range(40):
        other = list(base)
        for _ in range(k):
            other[rng.randrange(400)] = f"x{rng.randrange(9999)}"
        a, b = " ".join(base), " ".join(other + other[:50])
        row, shingle, count = nd.weighted(pa.array([a, b]))
        sig = nd.signatures(row, shingle, count, 2)
        want = h.similarities(h.shingle_counts(a), h.shingle_counts(b))[0]
        errors.append((sig[0] == sig[1]).mean() - want)
    assert abs(np.mean(errors)) < 0.03 and np.abs(errors).max() < 0.2


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(5, 3), (3, 5), (7, 7), (9, 3)]
    got = dict(components(h.frame(spark, edges, "u long, v long")).collect())
    assert all(got[i] == 100 for i in range(100, 141)) and got[9] == got[5] == got[3] == 3 and 7 not in got
    assert components(h.frame(spark, [], "u long, v long")).count() == 0


def brute(rows):
    counts = [(i, h.shingle_counts(t)) for i, t in rows]
    links = [
        (a, b)
        for k, (a, x) in enumerate(counts)
        for b, y in counts[:k]
        if x and y and len(x.keys() & y.keys()) and max(h.similarities(x, y)) >= nd.THRESHOLD
    ]
    return h.classes(links, [i for i, _ in rows])


def test_matches_brute_force_on_documents(spark):
    docs = h.documents()
    rows = list(zip(docs.doc_id.tolist(), docs.text.tolist(), strict=True))
    got = {r.doc_id: r.class_id for r in nd.op9_near_dups(spark, h.SF).collect()}
    assert got == brute(rows)


def test_family_blocks_find_links_that_the_pivot_misses(spark, monkeypatch):
    """Near copies that drift away from each other: pivots alone can't see all links."""
    monkeypatch.setattr(nd, "BLOCK", 8)
    rng = random.Random(11)
    base = [f"w{rng.randrange(999)}" for _ in range(150)]
    rows, i = [], 0
    for _ in range(12):
        text = list(base)
        for _ in range(6):  # a chain of copies, each a few words off the one before
            text[rng.randrange(150)] = f"x{rng.randrange(9999)}"
            rows.append((i, " ".join(text)))
            i += 1
    rng.shuffle(rows)
    got = {r.doc_id: r.class_id for r in nd.near_dups(h.frame(spark, rows)).collect()}
    assert got == brute(rows)


def test_a_large_group_with_few_strays_is_not_compared_with_itself(spark, monkeypatch):
    """Rows that the block step takes in: the group's members once for each block of strays."""
    monkeypatch.setattr(nd, "BLOCK", 10)
    taken = []
    blocks = nd._block_links

    def counted(group):
        return nd.pd.DataFrame([(len(group), 0)], columns=["u", "v"], dtype="int64")

    rng = random.Random(19)
    base = [f"w{rng.randrange(999)}" for _ in range(200)]
    rows = [(k, " ".join([*base, f"end{k}"])) for k in range(300)]
    for k in range(6):  # strays: near enough to meet the pivot, too far to be linked to it
        text = list(base)
        for j in range(4):
            text[20 + 45 * j + k] = f"x{rng.randrange(9999)}"
        rows.append((1000 + k, " ".join(text + [f"y{j}{k}" for j in range(25)])))
    sets = {i: set(h.shingle_counts(t)) for i, t in rows}  # no shingle repeats: both similarities are the same
    links = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= nd.THRESHOLD * len(sets[a] | sets[b])]
    want = h.classes(links, list(sets))
    real = nd._family_links

    def spied(*tables):
        monkeypatch.setattr(nd, "_block_links", counted)
        taken.extend(r.u for r in real(*tables).collect())
        monkeypatch.setattr(nd, "_block_links", blocks)
        return real(*tables)

    monkeypatch.setattr(nd, "_family_links", spied)
    assert {r.doc_id: r.class_id for r in nd.near_dups(h.frame(spark, rows)).collect()} == want
    assert sum(taken) <= 4 * len(rows)


def test_copies_with_a_line_repeated_many_times(spark):
    """Plain Jaccard stays high and the weighted similarity falls: the plain registers have to find them."""
    rng = random.Random(13)
    rows = []
    for k in range(12):
        base = [f"w{rng.randrange(9999)}" for _ in range(304)]
        line = base[96:108]
        rows.append((10 * k, " ".join(base)))
        rows += [(10 * k + c, " ".join([*base[:108], *line * n, *base[108:]])) for c, n in ((1, 40), (2, 100), (3, 400))]
    got = {r.doc_id: r.class_id for r in nd.near_dups(h.frame(spark, rows)).collect()}
    assert got == brute(rows) and set(got.values()) == set(range(0, 120, 10))


def test_odd_rows(spark, extra):
    long = " ".join(f"v{k}" for k in range(60_000))
    rows = [(1, None), (2, ""), (3, " ,.\n"), (4, "a b"), (5, "A b!"), (6, long), (7, long + " end"), (8, "a c"), (4, "a b"), (None, "zz top")]
    out = nd.near_dups(extra(h.frame(spark, rows)))
    got = sorted((r.doc_id or 0, r.class_id or 0, r.class_size) for r in out.collect())
    assert got == [(0, 0, 1), (1, 1, 1), (2, 2, 1), (3, 3, 1), (4, 4, 3), (4, 4, 3), (5, 4, 3), (6, 6, 2), (7, 6, 2), (8, 8, 1)]
    assert nd.near_dups(h.frame(spark, [])).count() == 0


def test_rows_that_share_an_id_are_judged_each_on_its_own(spark):
    rng = random.Random(17)
    x, y = ([f"{c}{rng.randrange(9999)}" for _ in range(120)] for c in "xy")
    near = lambda t: " ".join([*t[:60], "changed", *t[61:]])
    rows = [(1, " ".join(x)), (1, " ".join(y)), (2, near(y)), (3, near(x)), (3, near(x)), (4, ""), (4, None), (None, " ".join(x)), (None, "")]
    schema = "doc_id long, text string, text_key string, `class` string, row string, __copy string, id string"
    df = spark.createDataFrame([(*r, *"abcde") for r in rows], schema)
    got = sorted((r.doc_id or 0, r.class_id or 0, r.class_size, r.kept) for r in nd.near_dups(df).collect())
    assert got == [(0, 0, 1, True)] * 2 + [(1, 1, 2, True), (1, 1, 3, True), (2, 1, 2, False)] + [(3, 1, 3, False)] * 2 + [(4, 4, 2, True)] * 2
    left = nd.without_copies(df)
    assert left.columns == df.columns
    kept = sorted(((r.doc_id or 0, r.text or "") for r in left.collect()))
    assert kept == sorted([(1, " ".join(x)), (1, " ".join(y)), (4, ""), (0, " ".join(x)), (0, "")])
    assert nd.without_copies(df.limit(0)).count() == 0


def test_one_id_in_most_rows(spark):
    rows = [(7, f"words of text number {k % 5} " + " ".join(f"t{k % 5}w{j}" for j in range(30))) for k in range(200)] + [(8, "alone")]
    left = nd.without_copies(h.frame(spark, rows)).collect()
    assert len(left) == 6 and {r.doc_id for r in left} == {7, 8}


def test_recall_and_copies_below_the_threshold(spark):
    """All links of plain Jaccard 0.8 or more on 10,000 documents, from an inverted index of all shingles."""
    docs = h.documents("/root/testdata/sf0.1")
    sets = {i: set(h.shingle_counts(t)) for i, t in zip(docs.doc_id, docs.text, strict=True)}
    index = {}
    for i, shingles in sets.items():
        for e in shingles:
            index.setdefault(hash(e), []).append(i)
    common = h.Counter()
    for ids in index.values():
        if len(ids) > 1:
            common.update((a, b) for k, a in enumerate(ids) for b in ids[:k])
    alike = {p: n / (len(sets[p[0]]) + len(sets[p[1]]) - n) for p, n in common.items()}
    got = {r.doc_id: r.class_id for r in nd.op9_near_dups(spark, "/root/testdata/sf0.1").collect()}
    linked = [p for p, j in alike.items() if j >= nd.THRESHOLD]
    assert len(linked) > 1000 and all(got[a] == got[b] for a, b in linked)
    below = [p for p, j in alike.items() if 0.5 <= j < nd.THRESHOLD]
    print(f"{len(linked)} pairs from 0.8 on, all found; {len(below)} from 0.5 to 0.8, {sum(got[a] == got[b] for a, b in below)} in one class")


def test_star_steps_read_their_join_once(spark, monkeypatch):
    """Each round makes one pass over the joined edges, no union of two."""
    from sitewatts.llm import components as c

    plans = []

    def noted(df, label):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return df.localCheckpoint()

    monkeypatch.setattr(c, "stored", noted)
    chain = [(k, k + 1) for k in range(20)] + [(40, 41), (41, 42), (7, 7)]
    got = dict(c.components(h.frame(spark, chain, "u long, v long")).collect())
    assert got == {k: 0 for k in range(21)} | {k: 40 for k in (40, 41, 42)}
    assert len(plans) > 2 and all("Generate inline" in p for p in plans[1:])
