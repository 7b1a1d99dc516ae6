"""Token ids as binary blocks under a canonical length-limited Huffman code.

Format, two Parquet tables in one folder of the caller's:

``codebook``  one row: max_bits int, lengths binary (one byte per id: its code
              length, 0 if it doesn't occur). Codes are canonical: shorter codes
              first, equal lengths in order of id.
``blocks``    shard int, block int (ascending doc_id order), first_id long (ids of
              the shard before the block), n_ids long, n_bits long, doc_ids
              array<long>, doc_tokens array<long>, payload binary, checkpoints
              array<long> (bit offset of every STEP-th id).

``max_bits`` is 16, more only if more than 65,536 ids occur (25 at most). Every block is decoded
on its own by table look-up of the next ``max_bits`` bits; checkpoints let any id be reached, and many places be decoded at a time.

Counts come from all ids; only the counts (bounded by the vocabulary) reach the
driver. Null and empty texts are the end id alone. Repeated rows are written
each; rows without doc_id come first, ties in doc_id in input order. A single
document stays in one block. An empty table gives an empty file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitewatts.llm import vocab
from sitewatts.llm.common import columns, read, scratch, slices, stored, texts

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
MAX_BITS = 16
STEP = 512
#: Ids after which a block is closed, at the end of a document.
BLOCK_IDS = 1 << 15
#: Ids that one decoding round of a task holds.
ROUND_IDS = 1 << 21


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits, by package-merge."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        out[used] = 1
        return out
    if len(used) > 1 << limit or limit > 25:
        raise ValueError(f"{len(used)} ids don't fit {min(limit, 25)} bits")
    weight = counts[used].astype(np.float64)
    leaves = np.argsort(weight, kind="stable")
    sorted_weight = weight[leaves]
    n = len(used)
    # each level: merged list of leaves (index < n) and pairs of the level below
    levels = []
    below = sorted_weight
    kinds = np.arange(n)
    levels.append(kinds)
    for _ in range(limit - 1):
        pairs = below[: len(below) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([sorted_weight, pairs])
        order = np.argsort(both, kind="stable")
        levels.append(np.where(order < n, order, -1))
        below = both[order]
    lengths = np.zeros(n, np.int64)
    take = 2 * n - 2
    for kinds in reversed(levels):
        chosen = kinds[:take]
        lengths[chosen[chosen >= 0]] += 1
        take = 2 * int((chosen < 0).sum())
    out[used[leaves]] = lengths
    return out


def limit_for(counts: np.ndarray) -> int:
    """Bits that codes are limited to: MAX_BITS, more if more ids occur than it has codes for."""
    return max(MAX_BITS, int(np.count_nonzero(counts) - 1).bit_length())


def _reach(max_bits: int) -> int:
    """Bytes that hold any code, wherever in the first of them it begins."""
    return 3 if max_bits <= 17 else 4


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each id, from the lengths alone."""
    codes = np.zeros(len(lengths), np.int64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    code, last = 0, 0
    for i in order.tolist():
        code <<= int(lengths[i]) - last
        last = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def decoding_table(lengths: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(id, length) for every value of the next ``max_bits`` bits."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    span = 1 << (max_bits - lengths[order].astype(np.int64))
    ids = np.repeat(order, span)
    pad = (1 << max_bits) - len(ids)
    return np.append(ids, np.zeros(pad, np.int64)).astype(np.int32), np.append(
        np.repeat(lengths[order], span), np.ones(pad, np.uint8)
    ).astype(np.int64)


def encode(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray, step: int = STEP) -> tuple[bytes, int, np.ndarray]:
    """(payload, bits, bit offset of every step-th id)."""
    size = lengths[ids].astype(np.int64)
    reach = _reach(int(lengths.max(initial=0)))
    end = np.cumsum(size)
    bits = int(end[-1]) if len(end) else 0
    at = end - size
    value = codes[ids] << (8 * reach - size - (at & 7))  # each code lies in so many bytes from its first
    where = at >> 3
    n = (bits + 7) // 8 + reach - 1
    payload = np.zeros(n, np.int64)
    for k, shift in enumerate(range(8 * reach - 8, -1, -8)):
        payload += np.bincount(where + k, (value >> shift) & 255, n).astype(np.int64)
    return payload.astype(np.uint8)[: (bits + 7) // 8].tobytes(), bits, at[::step]


def decode(payloads: list[bytes], n_ids: list[int], checkpoints: list[np.ndarray], table: tuple[np.ndarray, np.ndarray], max_bits: int, step: int = STEP) -> np.ndarray:
    """Ids of several blocks, one after the other; all checkpoints advance together."""
    total = sum(n_ids)
    out = np.zeros(total, np.int32)
    if not total:
        return out
    base = np.cumsum([0, *(len(p) + 4 for p in payloads)])
    reach = _reach(max_bits)
    data = np.frombuffer(b"".join(p + b"\0\0\0\0" for p in payloads), np.uint8).astype(np.int32 if reach == 3 else np.int64)
    ahead = np.zeros(len(data), data.dtype)  # the next ``reach`` bytes of each place
    for k in range(reach):
        ahead[: len(data) - reach + 1] |= data[k : len(data) - reach + 1 + k] << (8 * (reach - 1 - k))
    lanes = [np.asarray(c, np.int64) + 8 * b for c, b in zip(checkpoints, base.tolist(), strict=False)]
    at = np.concatenate(lanes)
    first = np.cumsum([0, *n_ids])[:-1]
    target = np.concatenate([f + step * np.arange(len(c)) for f, c in zip(first.tolist(), lanes, strict=True)])
    left = np.concatenate([np.minimum(step, n - step * np.arange(len(c))) for n, c in zip(n_ids, lanes, strict=True)])
    order = np.argsort(-left, kind="stable")  # lanes that end early lie at the back
    at, target, left = at[order], target[order], left[order]
    ids, sizes = table
    mask = (1 << max_bits) - 1
    shift = 8 * reach - max_bits
    for k in range(step):
        live = int(np.searchsorted(-left, -k, side="left"))
        if not live:
            break
        now = at[:live]
        peek = (ahead[now >> 3] >> (shift - (now & 7))) & mask
        out[target[:live] + k] = ids[peek]
        now += sizes[peek]
    return out


def raw_kind(file: str, end_id: int) -> str:
    """The type that raw ids are kept in."""
    return "<u4" if max(vocab.library(file).get_vocab_size(), end_id + 1) > 1 << 16 else "<u2"


def id_blocks(docs: DataFrame, file: str, end_id: int) -> DataFrame:
    """Whole documents in ascending doc_id order, as blocks of raw ids (16 or 32 bits each)."""
    kind = raw_kind(file, end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocab.word_ids(file)
        end = np.array([end_id], "<u4").tobytes()
        shard, block, before = TaskContext.get().partitionId(), 0, 0
        names: list = []
        sizes: list[int] = []
        parts: list[bytes] = []

        def close() -> pa.RecordBatch:
            nonlocal block, before, names, sizes, parts
            ids = np.frombuffer(b"".join(parts), "<u4")
            row = {
                "shard": pa.array([shard], pa.int32()),
                "block": pa.array([block], pa.int32()),
                "first_id": pa.array([before], pa.int64()),
                "doc_ids": pa.array([names], pa.list_(pa.int64())),
                "doc_tokens": pa.array([sizes], pa.list_(pa.int64())),
                "ids": pa.array([ids.astype(kind).tobytes()], pa.binary()),
            }
            block, before, names, sizes, parts = block + 1, before + len(ids), [], [], []
            return pa.RecordBatch.from_pydict(row)

        held = 0
        for batch in slices(batches):
            for name, raw in zip(batch.column("doc_id").to_pylist(), words.encode(texts(batch)), strict=True):
                names.append(name)
                sizes.append(len(raw) // 4 + 1)
                parts += (raw, end)
                held += sizes[-1]
                if held >= BLOCK_IDS:
                    yield close()
                    held = 0
        if names:
            yield close()

    # the place in the input spreads a doc_id that many rows share; finding the ranges reads no text
    ordered = docs.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange("doc_id", "tie")
    ordered = ordered.sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    return ordered.mapInArrow(
        run, "shard int, block int, first_id long, doc_ids array<long>, doc_tokens array<long>, ids binary"
    )


def id_counts(blocks: DataFrame, size: int, kind: str) -> np.ndarray:
    """How often each id occurs in all blocks; at most one row per id comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for raw in batch.column("ids"):
                total += np.bincount(np.frombuffer(raw.as_buffer(), kind), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": pa.array(used, pa.int32()), "n": pa.array(total[used], pa.int64())})

    found = blocks.select("ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(size, np.int64)
    counts[found["id"].to_numpy()] = found["n"].to_numpy()
    return counts


def write_ids(docs: DataFrame, folder: str, file: str | None = None, end_id: int = END_ID) -> None:
    """Encode the texts of ``docs`` (doc_id, text) and write codebook and blocks below ``folder``."""
    spark = docs.sparkSession
    file = file or vocab.path(VOCABULARY)
    blocks = stored(id_blocks(columns(docs, "doc_id", "text"), file, end_id), "ids")
    size = max(vocab.library(file).get_vocab_size(), end_id + 1)
    kind = raw_kind(file, end_id)
    counts = id_counts(blocks, size, kind)
    max_bits = limit_for(counts)
    lengths = code_lengths(counts, max_bits)
    codes = canonical(lengths)
    book = spark.createDataFrame([(max_bits, bytearray(lengths.tobytes()))], "max_bits int, lengths binary")
    book.write.parquet(f"{folder}/codebook")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                ids = np.frombuffer(row.column("ids")[0].as_buffer(), kind)
                payload, bits, points = encode(ids, codes, lengths)
                kept = {c: row.column(c) for c in ("shard", "block", "first_id", "doc_ids", "doc_tokens")}
                yield pa.RecordBatch.from_pydict(
                    kept
                    | {
                        "n_ids": pa.array([len(ids)], pa.int64()),
                        "n_bits": pa.array([bits], pa.int64()),
                        "payload": pa.array([payload], pa.binary()),
                        "checkpoints": pa.array([points], pa.list_(pa.int64())),
                    }
                )

    schema = (
        "shard int, block int, first_id long, doc_ids array<long>, doc_tokens array<long>, "
        "n_ids long, n_bits long, payload binary, checkpoints array<long>"
    )
    blocks.mapInArrow(run, schema).write.parquet(f"{folder}/blocks")


def read_ids(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """One row per document, decoded: doc_id, start, n_tokens, ids_crc32, and ids if asked for."""
    book = spark.read.parquet(f"{folder}/codebook").first()
    max_bits, lengths = book["max_bits"], np.frombuffer(bytes(book["lengths"]), np.uint8)
    blocks = spark.read.parquet(f"{folder}/blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decoding_table(lengths, max_bits)

        def out(rows: list[dict]) -> pa.RecordBatch:
            ids = decode(
                [r["payload"] for r in rows], [r["n_ids"] for r in rows], [r["checkpoints"] for r in rows], table, max_bits
            ).astype("<u4")
            sizes = np.concatenate([np.asarray(r["doc_tokens"], np.int64) for r in rows])
            ends = np.cumsum(sizes)
            raw = ids.tobytes()
            spans = list(zip((4 * (ends - sizes)).tolist(), (4 * ends).tolist(), strict=True))
            starts = [r["first_id"] + np.cumsum([0, *r["doc_tokens"][:-1]]) for r in rows]
            got = {
                "shard": pa.array(np.repeat([r["shard"] for r in rows], [len(r["doc_ids"]) for r in rows]), pa.int32()),
                "doc_id": pa.array([d for r in rows for d in r["doc_ids"]], pa.int64()),
                "at": pa.array(np.concatenate(starts), pa.int64()),
                "n_tokens": pa.array(sizes, pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(raw[a:b]) for a, b in spans], pa.int64()),
            }
            if with_ids:
                got["ids"] = pa.array([ids[a // 4 : b // 4] for a, b in spans], pa.list_(pa.int32()))
            return pa.RecordBatch.from_pydict(got)

        held: list[dict] = []
        for batch in batches:
            for k in range(batch.num_rows):
                held.append({c: batch.column(c)[k].as_py() for c in batch.schema.names})
                if sum(r["n_ids"] for r in held) >= ROUND_IDS:
                    yield out(held)
                    held = []
        if held:
            yield out(held)

    wanted = blocks.select("shard", "first_id", "doc_ids", "doc_tokens", "n_ids", "payload", "checkpoints")
    schema = "shard int, doc_id long, at long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    docs = wanted.mapInArrow(run, schema)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    shards = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    kept = ["n_tokens", "ids_crc32"] + (["ids"] if with_ids else [])
    return docs.join(shards, "shard").select("doc_id", (F.col("base") + F.col("at")).alias("start"), *kept)


def op6_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "huffman")
    write_ids(read(spark, sf_dir, "documents"), folder)
    return read_ids(spark, folder, with_ids=False)


QUERIES = {"op6_huffman_ids": op6_huffman_ids}
