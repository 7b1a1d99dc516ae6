"""Exact duplicates: directory, collisions, copies and odd rows against brute force."""

import hashlib
import random

import numpy as np
import pytest

from sitewatts.llm import extendible
from tests.llm.helpers import SF, documents, frame, odd_rows

RESULT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        spare = True
        for i in ids:
            kept = spare and i == keep
            spare &= not kept
            out.append((i, keep, len(ids), kept, sha))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r[c] for c in RESULT) for r in df.collect()), key=repr)


def random_rows(n=400, seed=5):
    rng = random.Random(seed)
    rows = [(k, rng.choice("abcdefgh") * rng.randint(0, 12)) for k in range(n)]
    return rows + rng.sample(rows, 40) + [(None, rng.choice("abc")) for _ in range(20)]


def test_query_equals_brute_force_on_the_whole_table(spark):
    rows = list(documents(SF)[["doc_id", "text"]].itertuples(index=False, name=None))
    found = extendible.op12_exact_dedup(spark, SF)
    assert [t for _, t in found.dtypes] == ["bigint", "bigint", "bigint", "boolean", "string"]
    assert got(found) == brute(rows)


@pytest.mark.parametrize("key_bits", [1, 3, 64])
def test_colliding_keys_are_told_apart_by_bytes(spark, key_bits):
    rows = random_rows() + odd_rows()
    df = extendible.duplicates(frame(spark, rows).repartition(5), key_bits=key_bits, bucket_bytes=200)
    assert got(df) == brute(rows)


def test_copies_over_several_folds_and_tasks(spark, monkeypatch):
    monkeypatch.setattr(extendible, "HELD_BYTES", 500)
    rows = [(k, "same text" if k % 3 else f"text {k}") for k in range(900)]
    assert got(extendible.duplicates(frame(spark, rows).repartition(7), bucket_bytes=1000)) == brute(rows)


def test_many_repeated_rows_are_numbered_in_runs(spark, monkeypatch):
    monkeypatch.setattr(extendible, "RUN", 4)
    rows = [(1, "a")] * 23 + [(None, "a")] * 9 + [(None, None)] * 5 + [(None, "")] * 3
    assert got(extendible.duplicates(frame(spark, rows))) == brute(rows)


def test_directory_splits_and_doubles():
    found = extendible.Directory()
    keys = np.array([0, -1, 1 << 62, -(1 << 62), 1 << 61], np.int64)
    assert found.buckets(keys).tolist() == [0] * 5
    found.split(0, 0)  # doubled: one bit
    assert found.depth == 1 and found.buckets(keys).tolist() == [0, 1, 0, 1, 0]
    found.split(0, 1)  # keys from 01...: a bucket of their own, the other half of the directory keeps its bucket
    assert found.depth == 2 and found.buckets(keys).tolist() == [0, 1, 2, 1, 0]
    found.split(1, 1)  # no doubling
    assert found.depth == 2 and found.buckets(keys).tolist() == [0, 3, 2, 3, 0]
    found.split(0, 2)
    assert found.depth == 3 and found.buckets(keys).tolist() == [0, 3, 2, 3, 4]
    assert found.bits == [3, 2, 2, 2, 3]
    with pytest.raises(ValueError):
        found.split(0, 1)


def test_no_bucket_of_several_keys_is_overfull(spark):
    rows = frame(spark, [(k, f"{k:040d}") for k in range(2000)])
    index = extendible.build(rows, bucket_bytes=4000)
    sizes = {}
    for e in index.entries.collect():
        sizes[e.bucket] = sizes.get(e.bucket, 0) + len(e.text)
    assert sum(sizes.values()) == 80_000 and max(sizes.values()) <= 4000 and len(sizes) > 20
    depth = index.directory.count().bit_length() - 1
    assert 2**depth == index.directory.count()
    assert {(r.bucket, r.n) for r in index.directory.groupBy("bucket").count().withColumnRenamed("count", "n").collect()} == {
        (r.bucket, 2 ** (depth - r.bits)) for r in index.directory.collect()
    }


def test_index_is_opened_again_and_asked_for_other_texts(spark):
    built = extendible.build(frame(spark, [(1, "a"), (2, "a"), (3, "b")]), key_bits=1)
    index = extendible.open_index(spark, built.path)
    found = extendible.lookup(index, frame(spark, [(10, "a"), (11, "new"), (12, None), (13, "b"), (14, "c")]))
    assert {(r.doc_id, r.keep_id, r.group_size) for r in found.collect()} == {
        (10, 2, 2), (11, None, None), (12, None, None), (13, 3, 1), (14, None, None)
    }


def test_rows_that_stay_keep_their_columns(spark):
    schema = "doc_id long, text string, key string, row string, keep_id string, copy string, text_sha256 string, bucket string"
    rows = [(1, "a", *"pqrstu"), (2, "a", *"pqrstv"), (2, "a", *"pqrstv"), (3, "", *"pqrstw"), (None, None, *"pqrstx"), (None, "z", *"pqrsty")]
    kept = extendible.without_copies(spark.createDataFrame(rows, schema))
    assert kept.columns == [f.split()[0] for f in schema.split(", ")]
    assert {(r.doc_id, r.text, r.bucket) for r in kept.collect()} == {(2, "a", "v"), (3, "", "w"), (None, "z", "y")}
    assert kept.count() == 3


def test_empty_table(spark):
    assert extendible.duplicates(frame(spark, [])).count() == 0
    assert extendible.without_copies(frame(spark, [])).count() == 0
