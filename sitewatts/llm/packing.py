"""Packing into fixed windows by non-negative least squares.

Every document becomes token ids plus an end id and is cut into full windows
and one tail shorter than a window. The histogram of tail lengths (at most
window - 1 numbers) is all that the driver sees. There

1. all combinations of up to three lengths that fill a window exactly are
   enumerated,
2. non-negative least squares finds how often to repeat each so that the
   histogram is used up,
3. the repeat counts are rounded down and then up greedily where lengths are left.

A tail's rank among all tails of its length tells its place in a combination.
Tails that no combination takes are packed greedily end to end, cut where a
window ends; so only the very last sequence is padded.

Null and empty texts are the end id alone. Repeated rows are packed each on its
own; an empty table gives no pieces. Ties have no meaning here: tails of one
length are interchangeable and ranked by input partition and row.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitewatts.llm import vocab
from sitewatts.llm.common import columns, read, slices, stored, texts

WINDOW = 1024
END_ID = 0
VOCABULARY = "byte_bpe_50k.json"


def tokenized(docs: DataFrame, file: str, end_id: int, window: int) -> DataFrame:
    """Per document its full windows (crc32 each) and its tail (ids, length), with task-local running counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, windows, row, rank = TaskContext.get().partitionId(), 0, 0, Counter()
        for batch in slices(batches):
            out: dict[str, list] = {k: [] for k in ("part", "row", "doc_tokens", "windows_before", "crcs", "tail", "tail_rank", "tail_crc", "tail_ids")}
            for ids in vocab.encode_bytes(file, texts(batch)):
                data = np.array([*ids, end_id], "<u4")
                n = len(data)
                full, tail = n // window, n % window
                raw = data.tobytes()
                step = 4 * window
                out["part"].append(part)
                out["row"].append(row)
                out["doc_tokens"].append(n)
                out["windows_before"].append(windows)
                out["crcs"].append([zlib.crc32(raw[k * step : (k + 1) * step]) for k in range(full)])
                out["tail"].append(tail)
                out["tail_rank"].append(rank[tail])
                out["tail_crc"].append(zlib.crc32(raw[full * step :]))
                out["tail_ids"].append(raw[full * step :])
                rank[tail] += 1
                windows += full
                row += 1
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "part": pa.array(out["part"], pa.int32()),
                    "row": pa.array(out["row"], pa.int64()),
                    "doc_tokens": pa.array(out["doc_tokens"], pa.int64()),
                    "windows_before": pa.array(out["windows_before"], pa.int64()),
                    "crcs": pa.array(out["crcs"], pa.list_(pa.int64())),
                    "tail": pa.array(out["tail"], pa.int32()),
                    "tail_rank": pa.array(out["tail_rank"], pa.int64()),
                    "tail_crc": pa.array(out["tail_crc"], pa.int64()),
                    "tail_ids": pa.array(out["tail_ids"], pa.binary()),
                }
            )

    schema = (
        "doc_id long, part int, row long, doc_tokens long, windows_before long, crcs array<long>, "
        "tail int, tail_rank long, tail_crc long, tail_ids binary"
    )
    return docs.mapInArrow(run, schema)


def combinations(window: int, present: np.ndarray) -> np.ndarray:
    """All a <= b <= c of present lengths with a + b + c = window; a = 0 for pairs."""
    a, b = np.meshgrid(np.arange(window // 3 + 1), np.arange(window // 2 + 1), indexing="ij")
    a, b = a.ravel(), b.ravel()
    c = window - a - b
    ok = (a <= b) & (b >= 1) & (b <= c) & (c < window)
    a, b, c = a[ok], b[ok], c[ok]
    ok = present[b] & present[c] & (present[a] | (a == 0))
    return np.stack([a[ok], b[ok], c[ok]], axis=1)


def repeats(combos: np.ndarray, histogram: np.ndarray, steps: int = 400) -> np.ndarray:
    """Whole repeat counts: projected gradient with momentum for least squares, rounded to fit the histogram.

    Minimises |A x - h|^2 over x >= 0, where column k of A counts the lengths
    of combination k. Length 0 (the missing third of a pair) is ignored.
    """
    n = len(histogram)
    if not len(combos):
        return np.zeros(0, np.int64)
    h = histogram.astype(np.float64)
    h[0] = 0
    scale = h.max() or 1.0
    used = np.bincount(combos.ravel(), minlength=n).astype(np.float64)
    used[0] = 1
    # Lipschitz bound of the gradient: row sums times column sums of A
    rate = 1.0 / (3.0 * used.max())
    x = np.zeros(len(combos))
    y, t = x.copy(), 1.0
    for _ in range(steps):
        fill = sum(np.bincount(combos[:, j], y, n) for j in range(3))
        gap = fill - h / scale
        gap[0] = 0
        new = np.maximum(0, y - rate * gap[combos].sum(axis=1))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    x *= scale
    left = histogram.astype(np.int64).copy()
    left[0] = np.iinfo(np.int64).max // 4
    out = np.zeros(len(combos), np.int64)
    # largest first: whole parts as far as the histogram allows, then one more where all lengths are left
    for more in (False, True):
        for k in np.argsort(-(x - out), kind="stable").tolist():
            lengths, need = np.unique(combos[k], return_counts=True)
            room = int((left[lengths] // need).min())
            take = min(room, 1 if more else int(x[k]))
            if more and x[k] - int(x[k]) < 1e-3:
                continue
            if take > 0:
                left[lengths] -= take * need
                out[k] += take
    return out


def slots(combos: np.ndarray, counts: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, one past the last rank, first sequence, offset) for each place in a combination."""
    out, used, sequence = [], Counter(), 0
    for combo, count in zip(combos.tolist(), counts.tolist(), strict=True):
        if count:
            offset = 0
            for length in (x for x in combo if x):
                out.append((length, used[length], used[length] + count, sequence, offset))
                used[length] += count
                offset += length
            sequence += count
    return out


def _cut_crcs(df: DataFrame) -> DataFrame:
    """crc32 of both sides of the cut of each tail."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = [
                (zlib.crc32(raw[: 4 * cut]), zlib.crc32(raw[4 * cut :]))
                for raw, cut in zip(b.column("tail_ids").to_pylist(), b.column("cut").to_pylist(), strict=True)
            ]
            kept = {c: b.column(c) for c in ("doc_id", "doc_tokens", "tail", "at", "cut")}
            yield pa.RecordBatch.from_pydict(
                kept | {f"crc{k}": pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)}
            )

    return df.select("doc_id", "doc_tokens", "tail", "at", "cut", "tail_ids").mapInArrow(
        run, "doc_id long, doc_tokens long, tail int, at long, cut long, crc0 long, crc1 long"
    )


def pack(docs: DataFrame, file: str | None = None, end_id: int = END_ID, window: int = WINDOW) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    docs = columns(docs, "doc_id", "text")
    pieces = stored(tokenized(docs, file or vocab.path(VOCABULARY), end_id, window), "tails")
    histogram = np.zeros(window, np.int64)
    for r in pieces.groupBy("tail").count().collect():  # at most one row per length
        histogram[r["tail"]] = r["count"]
    combos = combinations(window, histogram > 0)
    counts = repeats(combos, histogram)
    places = slots(combos, counts)
    n_combined = int(counts.sum())

    by_part = pieces.groupBy("part").agg(F.sum(F.size("crcs")).alias("windows"))
    # one row per task of the tokenizing stage
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_part = by_part.select("part", F.coalesce(F.sum("windows").over(before), F.lit(0)).alias("base"))
    n_windows = pieces.agg(F.coalesce(F.sum(F.size("crcs")), F.lit(0)).cast("long")).first()[0]
    full = (
        pieces.where(F.size("crcs") > 0)
        .select("doc_id", "part", "doc_tokens", "windows_before", F.posexplode("crcs").alias("k", "ids_crc32"))
        .join(by_part, "part")
        .select(
            "doc_id", (F.col("k") * window).cast("long").alias("start"), F.lit(window).cast("long").alias("length"), "ids_crc32",
            "doc_tokens", (F.col("base") + F.col("windows_before") + F.col("k")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        )
    )

    tails = pieces.where("tail > 0").select("doc_id", "part", "row", "doc_tokens", "tail", "tail_rank", "tail_crc", "tail_ids")
    each = tails.groupBy("part", "tail").count()
    earlier = Window.partitionBy("tail").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    each = each.select("part", "tail", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("base"))
    table = spark.createDataFrame(places, "length int, lo long, hi long, sequence long, at long")
    ranked = tails.join(each, ["part", "tail"]).withColumn("rank", F.col("base") + F.col("tail_rank"))
    # at most three rows per combination that is in use: bounded by the window, not by the data
    placed = ranked.join(
        F.broadcast(table), (F.col("tail") == F.col("length")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")), "left"
    )
    placed = placed.drop("base", "tail_rank", "length")
    start = F.col("doc_tokens") - F.col("tail")
    combined = placed.where("sequence is not null").select(
        "doc_id", start.alias("start"), F.col("tail").cast("long").alias("length"), F.col("tail_crc").alias("ids_crc32"),
        "doc_tokens", (F.col("sequence") + F.col("rank") - F.col("lo") + n_windows).alias("sequence_id"), F.col("at").alias("offset"),
    )

    rest = stored(placed.where("sequence is null").select("doc_id", "part", "row", "doc_tokens", "tail", "tail_crc", "tail_ids"), "rest")
    totals = rest.groupBy("part").agg(F.sum("tail").alias("total"))
    totals = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    running = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    tape = rest.join(totals, "part").withColumn("at", F.col("base") + F.coalesce(F.sum("tail").over(running), F.lit(0)))
    tape = tape.withColumn("cut", window - F.col("at") % window)  # tokens up to the window's end
    first = n_windows + n_combined
    whole = tape.where("tail <= cut").select(
        "doc_id", start.alias("start"), F.col("tail").cast("long").alias("length"), F.col("tail_crc").alias("ids_crc32"),
        "doc_tokens", (F.floor(F.col("at") / window) + first).alias("sequence_id"), (F.col("at") % window).alias("offset"),
    )
    cut = _cut_crcs(tape.where("tail > cut"))
    sides = F.explode(
        F.array(
            F.struct(start.alias("start"), F.col("cut").alias("length"), F.col("crc0").alias("ids_crc32"), F.col("at").alias("at")),
            F.struct((start + F.col("cut")).alias("start"), (F.col("tail") - F.col("cut")).alias("length"), F.col("crc1").alias("ids_crc32"), (F.col("at") + F.col("cut")).alias("at")),
        )
    )
    cut = cut.select("doc_id", "doc_tokens", sides.alias("s")).select(
        "doc_id", "s.start", "s.length", "s.ids_crc32", "doc_tokens",
        (F.floor(F.col("s.at") / window) + first).alias("sequence_id"), (F.col("s.at") % window).alias("offset"),
    )
    return full.unionByName(combined).unionByName(whole).unionByName(cut)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))


QUERIES = {"op3_packing": op3_packing}
