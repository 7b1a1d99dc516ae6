"""Spelling variants: word counts and neighbours against brute force, odd and long words, ties."""

import random
import re
import zlib
from collections import Counter

import pytest

from sitewatts.llm import spelling
from tests.llm.helpers import SF, documents, frame, odd_rows

RESULT = ("word", "form", "root", "n", "n_near", "form_n")


def brute_counts(rows, damage=None, least_length=5, least_count=3):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if damage and h % damage == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1 :]
            if len(w) >= least_length:
                total[w] += 1
    return {w: n for w, n in total.items() if n >= least_count}


def brute_variants(counts, factor=2):
    """Neighbours by deletion keys; each pair is then compared by its definition."""

    def is_near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    keys = {}
    for w in counts:
        for key in {w, *(w[:k] + w[k + 1 :] for k in range(len(w)))}:
            keys.setdefault(key, set()).add(w)
    near = {w: set() for w in counts}
    for group in keys.values():
        for a in group:
            near[a] |= {b for b in group if b not in near[a] and is_near(a, b)}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return out


def got(df):
    rows = [tuple(r[c] for c in RESULT) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def words(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


def test_query_equals_brute_force_on_the_whole_table(spark):
    rows = documents(SF)[["doc_id", "text"]].itertuples(index=False, name=None)
    counts = brute_counts(list(rows), damage=97)
    found = spelling.op11_spelling_variants(spark, SF)
    assert found.dtypes == [
        ("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint"),
    ]
    want = brute_variants(counts)
    assert any(r[1] for r in want)
    assert got(found) == want


@pytest.mark.parametrize("seed", [1, 2])
def test_random_words(spark, seed):
    rng = random.Random(seed)
    counts = {"".join(rng.choices("abé", k=rng.randint(1, 6))): rng.randint(1, 40) for _ in range(500)}
    assert got(spelling.variants(words(spark, counts))) == brute_variants(counts)


def test_chains_ties_and_doubled_letters(spark):
    counts = {
        "colour": 100, "color": 10, "colo": 4, "col": 2, "co": 1,  # a chain of forms
        "aaaaa": 3, "aaaa": 9, "aaaaaa": 9,  # two neighbours of one count: the smaller word
        "bbccc": 5, "bbcc": 10,  # deleting any of the three letters is one neighbour
        "lonely": 7,
        "zebra": 5, "zebro": 9,  # not twice as common
    }
    found = {r[0]: r for r in got(spelling.variants(words(spark, counts)))}
    assert set(found.values()) == brute_variants(counts)
    assert found["co"][2] == "colour" and found["aaaaa"][1] == "aaaa" and found["bbccc"][4] == 1
    assert found["lonely"] == ("lonely", None, "lonely", 7, 0, None)
    assert found["zebra"][1] is None and found["zebra"][4] == 1


def test_long_words_are_keyed_by_fingerprint(spark):
    rng = random.Random(3)
    base = "".join(rng.choices("abcdeé", k=70))
    counts = {}
    for length in (62, 63, 64, 65, 66, 70):  # on both sides of the limit
        w = base[:length]
        counts |= {w: 50 - length // 2, w[:20] + "z" + w[21:]: 5, w[:20] + "y" + w[21:]: 5, w + w[-1]: 3}
    counts |= {"x" * 3000: 9, "x" * 3001: 3, "x" * 1500 + "y" + "x" * 1499: 4}
    assert got(spelling.variants(words(spark, counts))) == brute_variants(counts)


def test_groups_over_batch_edges(spark):
    counts = {f"w{a}{b}rd": ord(a) + 2 * ord(b) for a in "abcdefgh" for b in "ijklmnop"}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        assert got(spelling.variants(words(spark, counts))) == brute_variants(counts)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_word_counts_of_odd_rows(spark, extra):
    rows = odd_rows() * 2 + [(7, "Straße×ÀÉ÷ naïve NAÏVE 日本 façade-façade"), (8, "ABCDEF abcdef abcdeF")]
    for damage in (None, 2):
        df = spelling.word_counts(extra(frame(spark, rows)), damage=damage, least_length=1, least_count=1)
        assert {r.word: r.n for r in df.collect()} == brute_counts(rows, damage, 1, 1)


def test_counts_are_the_same_when_a_task_passes_partial_ones_on(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 1)
    df = spelling.word_counts(frame(spark, odd_rows()).repartition(3), least_length=1, least_count=1)
    assert {r.word: r.n for r in df.collect()} == brute_counts(odd_rows(), None, 1, 1)


def test_empty_table_and_bad_factor(spark):
    none = spelling.word_counts(frame(spark, []))
    assert spelling.variants(none).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(none, factor=1)
