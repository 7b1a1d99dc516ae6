"""MinHash near-duplicates: ProbMinHash signatures, banding, exact verification, classes.

Two texts are linked if the probability Jaccard similarity of their
count-weighted five-word shingles, or the plain Jaccard similarity of the
shingle sets, is at least the threshold (0.8). For texts without repeated
shingles both are the same number. A class is a connected component of links
and exact copies; its id is the smallest doc_id in it. Texts are told apart by their
words, not by doc_id: rows that share a doc_id but not a text are judged each on its own
(so two classes may have one id as their smallest).

Steps (everything stays in Spark tables; nothing of a document comes to the driver):

1. Texts with equal words collapse to one representative (map-side combine).
2. Each shingle with weight w is a Poisson process of rate w; its arrivals fall
   on random registers, and a register keeps its earliest arrival. Registers
   agree with a chance of the probability Jaccard similarity. Arrivals later
   than a time by which all registers are almost surely filled are never
   generated (the time doubles where a register stayed empty, so the result is
   exact). A text with repeated shingles has a second set of registers, drawn with
   all weights 1, which agree with a chance of the plain Jaccard similarity. (For
   other texts both sets are the same.)
3. Bands of registers of both sets are bucket keys. In a bucket every member is compared
   exactly with one pivot, the member that meets the most others; the pivot's
   side of the join is salted.
4. What is then still open is a family (all that met one pivot) that is in two
   or more components. Its members outside the pivot's component are compared with each other
   and with those inside, block by block (members inside it need no comparing with one
   another, so a large group with few strays costs no more than its members times the
   strays): pairs of blocks of bounded size are spread over tasks, a pair is skipped if it's already
   connected, if the triangle inequality through the pivot rules it out, or if
   both sets of registers are far apart; the others are verified exactly. Only links
   leave the task, never pairs.

Null and empty texts, and texts without words, have no shingles: each doc_id of such is a
class of its own. Rows that repeat doc_id and text fall into one class and give one
row each, with equal results. A row without doc_id has a null class_id, size 1, and is kept. An
empty table gives an empty result. Other columns, however named, are ignored, and kept by
``without_copies``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitewatts.llm.common import (
    columns,
    hashed_words,
    map_rows,
    mix,
    read,
    shingles,
    stored,
    uniform,
)
from sitewatts.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 25
ROWS = 5
REGISTERS = BANDS * ROWS
#: All registers of a row are full by this many mean waiting times with a chance of 0.92; else the time doubles.
PATIENCE = np.log(REGISTERS) + 2.5
#: Members of a family, and shingles of theirs, that one block of the pairwise step holds.
BLOCK = 256
BLOCK_SHINGLES = 500_000
#: Five standard deviations below the expected agreement at the threshold.
LEAST_AGREE = THRESHOLD - 5 * (THRESHOLD * (1 - THRESHOLD) / REGISTERS) ** 0.5


def weighted(column: pa.Array, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, count), sorted by row and shingle."""
    row, shingle = shingles(*hashed_words(column), n)
    order = np.lexsort((shingle, row))
    row, shingle = row[order], shingle[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (shingle[1:] != shingle[:-1])
    first = np.flatnonzero(new)
    return row[first], shingle[first], np.diff(np.append(first, len(row)))


def signatures(row: np.ndarray, shingle: np.ndarray, weight: np.ndarray, rows: int) -> np.ndarray:
    """ProbMinHash registers (rows x REGISTERS, 64-bit) of weighted shingles; 0 where a row has none.

    Rows are taken sorted. The k-th arrival of a shingle is the sum of k
    exponentials of its rate; its register and its name are hashes of (shingle, k).
    """
    out = np.zeros((rows, REGISTERS), np.uint64)
    total = np.bincount(row, weight, rows)
    open_rows = total > 0
    patience = PATIENCE
    while open_rows.any():
        limit = np.where(open_rows, REGISTERS * patience / np.maximum(total, 1), 0.0)
        live = open_rows[row]
        r, s, w = row[live], shingle[live], weight[live].astype(np.float64)
        clock = np.zeros(len(r))
        k = 0
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(r):
            k += 1
            h = mix(s + np.uint64(k * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF))
            clock = clock - np.log(uniform(h)) / w
            early = clock < limit[r]  # all later arrivals of a late shingle are later still
            r, s, w, clock, h = r[early], s[early], w[early], clock[early], h[early]
            found.append((r * REGISTERS + (mix(h) % np.uint64(REGISTERS)).astype(np.int64), clock, h))
        slot, when, name = (np.concatenate(x) for x in zip(*found, strict=True))
        earliest = np.full(rows * REGISTERS, np.inf)
        np.minimum.at(earliest, slot, when)
        won = when == earliest[slot]
        fresh = np.zeros(rows * REGISTERS, np.uint64)
        fresh[slot[won]] = name[won] | np.uint64(1)
        fresh = fresh.reshape(rows, REGISTERS)
        full = open_rows & (fresh != 0).all(axis=1)
        out[full] = fresh[full]
        open_rows &= ~full
        patience *= 2
    return out


def _text_keys(row: np.ndarray, word: np.ndarray, rows: int) -> pa.Array:
    """A 128-bit hash of each row's words in their order; null where a row has none."""
    start = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
    place = np.arange(len(row)) - np.repeat(start, np.diff(np.append(start, len(row))))
    key = np.zeros((rows, 2), np.uint64)
    for k, salt in enumerate((np.uint64(11), np.uint64(13))):
        if len(row):
            key[row[start], k] = np.add.reduceat(mix(word + mix(place.astype(np.uint64) * salt + salt)), start)
    has = np.bincount(row, minlength=rows) > 0
    return pa.array([x.tobytes() if ok else None for x, ok in zip(key, has, strict=True)], pa.binary())


def text_keys(docs: DataFrame) -> DataFrame:
    """``docs`` (row, doc_id, text) as row, doc_id and text_key."""

    def fn(batch: pa.RecordBatch) -> dict:
        keys = _text_keys(*hashed_words(batch.column("text")), batch.num_rows)
        return {"row": batch.column("row"), "doc_id": batch.column("doc_id"), "text_key": keys}

    schema = T.StructType([docs.schema["row"], docs.schema["doc_id"], T.StructField("text_key", T.BinaryType())])
    return map_rows(docs, fn, schema)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_key (hash of the words), bands, signature (two bytes a register), plain; nulls without words.

    ``bands`` are the different keys of both sets of registers, the band's number
    in them. ``plain`` is the signature of the second set, null where it's the same.
    """

    def fn(batch: pa.RecordBatch) -> dict:
        n = batch.num_rows
        column = batch.column("text")
        row, word = hashed_words(column)
        srow, shingle, count = weighted(column)
        sig = signatures(srow, shingle, count, n)
        has = sig.any(axis=1)
        repeats = np.bincount(srow, count > 1, n) > 0
        twice = repeats[srow]
        flat = sig.copy()
        flat[repeats] = signatures(srow[twice], shingle[twice], np.ones(int(twice.sum()), np.int64), n)[repeats]
        bands = [b if ok else None for b, ok in zip(_bands(sig).view(np.int64), has, strict=True)]
        for r, more in zip(np.flatnonzero(repeats).tolist(), _bands(flat[repeats]).view(np.int64), strict=True):
            bands[r] = np.union1d(bands[r], more)
        low, flat_low = (x.astype(np.uint16).astype("<u2") for x in (sig, flat))
        return {
            "doc_id": batch.column("doc_id"),
            "text_key": _text_keys(row, word, n),
            "bands": pa.array(bands, pa.list_(pa.int64())),
            "signature": pa.array([s.tobytes() if ok else None for s, ok in zip(low, has, strict=True)], pa.binary()),
            "plain": pa.array([s.tobytes() if ok else None for s, ok in zip(flat_low, repeats, strict=True)], pa.binary()),
        }

    return map_rows(docs, fn, "doc_id long, text_key binary, bands array<long>, signature binary, plain binary")


def _bands(sig: np.ndarray) -> np.ndarray:
    """Rows x BANDS keys; a key tells its band."""
    band = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(sig), BANDS)).copy()
    for i in range(ROWS):
        band = mix(band * np.uint64(31) + sig[:, i::ROWS][:, :BANDS])
    return band


def shingle_sets(docs: DataFrame) -> DataFrame:
    """text_key, shingles (sorted), counts."""

    def fn(batch: pa.RecordBatch) -> dict:
        row, shingle, count = weighted(batch.column("text"))
        ends = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
        return {
            "text_key": _text_keys(*hashed_words(batch.column("text")), batch.num_rows),
            "shingles": pa.ListArray.from_arrays(ends, pa.array(shingle.view(np.int64))),
            "counts": pa.ListArray.from_arrays(ends, pa.array(count.astype(np.int32))),
        }

    return map_rows(docs, fn, "text_key binary, shingles array<long>, counts array<int>")


def similarity(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> tuple[float, float]:
    """(probability Jaccard, Jaccard) of two sets of distinct shingles with counts.

    J_P = sum over common d of 1 / sum over all e of max(x_e / x_d, y_e / y_d).
    With the ratios t = x / y sorted, the inner sum splits at t_d into a sum of
    x and a sum of y, so it's O(n log n).
    """
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0, 0.0
    x, y = wa[i].astype(np.float64), wb[j].astype(np.float64)
    only_x, only_y = wa.sum() - x.sum(), wb.sum() - y.sum()
    ratio = x / y
    order = np.argsort(ratio)
    x, y, ratio = x[order], y[order], ratio[order]
    # max(x_e / x_d, y_e / y_d) is x_e / x_d where x_e / y_e >= x_d / y_d
    split = np.searchsorted(ratio, ratio, side="left")
    above = only_x + x.sum() - np.append(0.0, np.cumsum(x))[split]
    below = only_y + np.append(0.0, np.cumsum(y))[split]
    weighted_j = float((1.0 / (above / x + below / y)).sum())
    return weighted_j, len(i) / (len(a) + len(b) - len(i))


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Exact similarities of (id, pivot). A pivot with many pairs is salted: 64 pairs share a copy of it."""
    # per-pivot tables are stored, so that both sides of a join are dealt anew and a hot pivot can be split
    parts = stored(pairs.groupBy("pivot").agg(F.ceil(F.count("*") / 64).cast("int").alias("salts")), "parts")
    left = (
        pairs.join(parts, "pivot")
        .withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int"))
        .join(sets, "id")
    )
    right = (
        parts.join(sets.select(F.col("id").alias("pivot"), F.col("shingles").alias("ps"), F.col("counts").alias("pc")), "pivot")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        .drop("salts")
    )

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [
                similarity(*(x.values.to_numpy() for x in four))
                for four in zip(*(b.column(c) for c in ("shingles", "counts", "ps", "pc")), strict=True)
            ]
            yield pa.RecordBatch.from_pydict(
                {
                    "id": b.column("id"),
                    "pivot": b.column("pivot"),
                    "weighted": pa.array([x for x, _ in got], pa.float64()),
                    "plain": pa.array([x for _, x in got], pa.float64()),
                }
            )

    joined = left.join(right, ["pivot", "salt"]).select("id", "pivot", "shingles", "counts", "ps", "pc")
    return joined.mapInArrow(fn, "id long, pivot long, weighted double, plain double")


def _block_links(group: pd.DataFrame) -> pd.DataFrame:
    """Links inside one pair of blocks: a few that connect what the block pair connects."""
    n = len(group)
    label = {c: k for k, c in enumerate(dict.fromkeys(group["component"]))}
    parent = list(range(len(label)))

    def find(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    comp = np.array([label[c] for c in group["component"]])
    ids = group["id"].to_numpy()
    side = group["side"].to_numpy()
    diagonal = bool((group["a"] == group["b"]).all())
    sig = np.stack([np.frombuffer(s, "<u2") for s in group["signature"]])
    flat = np.stack([np.frombuffer(f or s, "<u2") for f, s in zip(group["flat"], group["signature"], strict=True)])
    near = np.stack([group["weighted"].to_numpy(), group["plain"].to_numpy()], axis=1)
    sets = [(np.asarray(s), np.asarray(c)) for s, c in zip(group["shingles"], group["counts"], strict=True)]
    links = []
    for i in range(n):
        other = np.arange(i + 1, n)
        if not diagonal:
            other = other[side[other] != side[i]]
        other = other[comp[other] != comp[i]]
        if not len(other):
            continue
        # d(i, j) >= |d(i, pivot) - d(j, pivot)| for either distance
        gap = np.abs(near[other] - near[i]).min(axis=1)
        other = other[gap <= 1 - THRESHOLD + 1e-9]
        agree = np.maximum((sig[other] == sig[i]).mean(axis=1), (flat[other] == flat[i]).mean(axis=1))
        other = other[agree >= LEAST_AGREE]
        for j in other.tolist():
            if find(comp[i]) != find(comp[j]) and max(similarity(*sets[i], *sets[j])) >= THRESHOLD:
                parent[find(comp[i])] = find(comp[j])
                links.append((ids[i], ids[j]))
    return pd.DataFrame(links, columns=["u", "v"], dtype="int64")


def _family_links(compared: DataFrame, prints: DataFrame, sets: DataFrame, comp: DataFrame) -> DataFrame:
    """Links between components of one family, found block by block."""
    members = compared.union(
        compared.select(F.col("pivot").alias("id"), "pivot", F.lit(1.0).alias("weighted"), F.lit(1.0).alias("plain"))
    ).distinct()
    members = members.join(comp, "id", "left").withColumn("component", F.coalesce("component", "id"))
    lengths = sets.select("id", F.size("shingles").alias("length"))
    center = members.where("id = pivot").select("pivot", F.col("component").alias("center"))
    members = stored(members.join(lengths, "id").join(center, "pivot").withColumn("inside", F.col("component") == F.col("center")), "members")

    def blocks(inside: Column) -> Column:
        count, total = F.count(F.when(inside, 1)), F.coalesce(F.sum(F.when(inside, F.col("length"))), F.lit(0))
        return F.ceil(F.greatest(count / BLOCK, total / BLOCK_SHINGLES)).cast("int")

    families = members.groupBy("pivot").agg(
        F.count("*").alias("n"), blocks(F.col("inside")).alias("inner"), blocks(~F.col("inside")).alias("outer")
    )
    # a family of two has been compared already
    families = stored(families.where("outer > 0 and n > 2").select("pivot", "inner", "outer"), "families")
    # blocks from 0: the pivot's component, from ``inner`` on: the others, which meet all blocks
    place = F.pmod(F.xxhash64("id", "pivot"), F.when(F.col("inside"), F.col("inner")).otherwise(F.col("outer"))).cast("int")
    others = F.sequence(F.when(F.col("inside"), F.col("inner")).otherwise(F.lit(0)), F.col("inner") + F.col("outer") - 1)
    open_rows = (
        members.join(families, "pivot")
        .withColumn("block", F.when(F.col("inside"), place).otherwise(F.col("inner") + place))
        .join(prints.select("id", "signature", F.col("plain").alias("flat")), "id")
        .join(sets, "id")
        .withColumn("with", F.explode(others))
        .select(
            "id", "component", "weighted", "plain", "signature", "flat", "shingles", "counts", "pivot",
            F.least("block", "with").alias("a"), F.greatest("block", "with").alias("b"), F.col("block").alias("side"),
        )
    )
    return open_rows.groupBy("pivot", "a", "b").applyInPandas(_block_links, "u long, v long")


def _repeated(prints: DataFrame) -> DataFrame:
    """doc_ids of several rows."""
    return prints.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")


def _classed(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, class_id, class_size, kept for each row; rows that repeat doc_id and text have equal results."""
    prints = stored(fingerprints(docs), "prints")
    worded = prints.where("text_key is not null and doc_id is not null")
    reps = worded.groupBy("text_key").agg(
        F.min("doc_id").alias("doc_id"), *[F.any_value(c).alias(c) for c in ("bands", "signature", "plain")]
    )
    # stored, so that a text keeps its number
    reps = stored(reps.withColumn("id", F.monotonically_increasing_id()), "reps")
    # one row per band and representative
    keys = reps.select("id", F.explode("bands").alias("bucket"))
    shared = keys.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    met = stored(keys.join(shared, "bucket"), "met")
    score = met.groupBy("id").agg(F.sum("n").alias("score"))
    pivots = (
        met.join(score, "id").groupBy("bucket").agg(F.max(F.struct("score", (-F.col("id")).alias("minus"))).alias("top"))
        .select("bucket", (-F.col("top.minus")).alias("pivot"))
    )
    # stored, so that both sides of the next join are dealt anew and a hot bucket can be split
    pairs = stored(met.join(stored(pivots, "pivots"), "bucket").where("id <> pivot").select("id", "pivot").distinct(), "pairs")
    wanted = reps.join(pairs.select("id").union(pairs.select("pivot")).distinct(), "id", "left_semi")
    wanted = stored(wanted.select("id", "text_key", "doc_id"), "wanted")
    sources = docs.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    repeated = stored(_repeated(prints), "repeated")
    if not repeated.isEmpty():
        again = sources.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
        sources = sources.join(repeated, "doc_id", "left_anti").unionByName(again)
    # of several texts under one doc_id those that are wanted; of several spellings of the same words one
    sets = shingle_sets(sources).join(wanted.select("text_key", "id"), "text_key").drop("text_key")
    if not repeated.isEmpty():
        sets = sets.dropDuplicates(["id"])
    sets = stored(sets.select("id", "shingles", "counts"), "sets")
    compared = stored(_compared(pairs, sets), "compared")
    links = compared.where(F.greatest("weighted", "plain") >= THRESHOLD).select(F.col("id").alias("u"), F.col("pivot").alias("v"))
    first = components(links)
    more = stored(_family_links(compared, reps, sets, first), "links")
    final = components(first.select(F.col("id").alias("u"), F.col("component").alias("v")).union(more))

    texts = reps.select("text_key", "id").join(final, "id", "left").select("text_key", F.coalesce("component", "id").alias("class"))
    found = prints.select("doc_id", "text_key").join(texts, "text_key", "left")
    # a class's first row; texts without words are classes by doc_id. Stored, so that a large class can be split in the join
    top = F.min(F.struct("doc_id", "text_key"))
    sizes = found.where("doc_id is not null").groupBy("class", F.when(F.col("class").isNull(), F.col("doc_id")).alias("alone"))
    sizes = stored(sizes.agg(F.count("*").alias("class_size"), top.alias("top")), "sizes")
    some = sizes.where("class is not null").select("class", "class_size", "top")
    none = sizes.where("class is null").select(F.col("alone").alias("doc_id"), "class_size")
    with_words = found.where("class is not null and doc_id is not null").join(some, "class").select(
        "doc_id", "text_key", F.col("top.doc_id").alias("class_id"), "class_size",
        ((F.col("doc_id") == F.col("top.doc_id")) & (F.col("text_key") == F.col("top.text_key"))).alias("kept"),
    )
    without = found.where("class is null and doc_id is not null").join(none, "doc_id").select(
        "doc_id", "text_key", F.col("doc_id").alias("class_id"), "class_size", F.lit(True).alias("kept")
    )
    nameless = prints.where("doc_id is null").select(
        "doc_id", "text_key", F.lit(None).cast("long").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept")
    )
    return with_words.unionByName(without).unionByName(nameless)


def near_dups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, class_id, class_size, kept.

    ``kept`` is true for the row whose doc_id is the class id (of several the one with the smallest hash of
    its words). See the module text for the definition of a class and for odd inputs.
    """
    return _classed(columns(docs, "doc_id", "text")).drop("text_key")


def without_copies(docs: DataFrame) -> DataFrame:
    """One row of each class of ``docs`` (any columns, among them doc_id and text): its smallest doc_id's.

    Rows without doc_id stay. Of rows that repeat doc_id and words one stays.
    """
    judged = stored(_classed(columns(docs, "doc_id", "text")), "classed")
    whole = docs.select(F.struct("*").alias("row"), "doc_id", "text")
    nameless = whole.where("doc_id is null").select("row.*")
    named = whole.where("doc_id is not null")
    repeated = stored(_repeated(judged), "repeated")
    gone = judged.where("not kept").select("doc_id")
    if repeated.isEmpty():
        return named.join(gone, "doc_id", "left_anti").select("row.*").unionByName(nameless)
    once = named.join(repeated, "doc_id", "left_anti").join(gone, "doc_id", "left_anti").select("row.*")
    # an id of several rows: which of its texts stays
    stay = judged.where("kept").join(repeated, "doc_id", "left_semi").select("doc_id", F.coalesce("text_key", F.lit(b"")).alias("text_key"))
    again = text_keys(named.join(repeated, "doc_id", "left_semi")).withColumn("text_key", F.coalesce("text_key", F.lit(b"")))
    again = again.join(stay.distinct(), ["doc_id", "text_key"], "left_semi").dropDuplicates(["doc_id", "text_key"])
    return once.unionByName(again.select("row.*")).unionByName(nameless)


def op9_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups(read(spark, sf_dir, "documents"))


QUERIES = {"op9_near_dups": op9_near_dups}
