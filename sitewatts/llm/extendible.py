"""Exact duplicates by an extendible-hash index on shared files (operator 12).

A text's key is a 64-bit hash; a bucket is a range of keys, all that begin with
some bits. The directory starts as one bucket; while a bucket is overfull (its
distinct keys stand for more than ``BUCKET_BYTES`` of text) it is split by its next
bit, and where that bucket already used all bits of the directory, the directory is
doubled. What comes to the driver are the prefixes of overfull buckets; the
directory holds at most 2^``MOST_BITS`` slots of four bytes (4 MB), whatever the
input; a bucket that is overfull at that depth just stays longer, since buckets
are worked through in key order and never held whole.

Rows go to the index in three steps:

* each task folds equal texts (compared byte by byte) among the rows it has read
  into one entry, holding at most ``HELD_BYTES`` of texts, so that copies don't pile
  up in the shuffle;
* entries are dealt by bucket and sorted by key; an owner task walks its buckets,
  compares the texts of equal keys byte by byte and chains those that differ;
* the entries are written as Parquet, beside the directory, to the shared folder.

To find the entry of a row that was indexed, its key is enough unless the chain of that
key has more than one text; then, and for rows of other tables, the texts themselves
are compared. Nothing relies on the key being free of collisions (tests cut it to a
few bits).

Null text counts as empty. Of equal texts the row with the largest ``doc_id`` stays; a
null id is smaller than any other. Rows that repeat text and id are one row each in the
result, and one of them stays. An empty table gives an empty result. Other
columns, however named, are ignored, and kept by ``without_copies``.
"""

from __future__ import annotations

import dataclasses
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewatts.llm.common import columns, read, scratch, slices, stored

KEY_BITS = 64
#: Text of a bucket's distinct keys beyond which it is split.
BUCKET_BYTES = 8 << 20
#: Most bits of the directory.
MOST_BITS = 20
#: Text that a task holds while it folds equal texts.
HELD_BYTES = 16 << 20
#: Repeated rows are laid out in runs of so many.
RUN = 4096

_ENTRY = "bucket int, key long, text string, keep_id long, n long"
_INDEX = "bucket int, key long, chain int, chain_length int, keep_id long, group_size long, text_sha256 string, text string"


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def keyed(docs: DataFrame, key_bits: int = KEY_BITS) -> DataFrame:
    """doc_id, text (never null) and key; fewer ``key_bits`` make collisions, for tests."""
    key = F.shiftleft(F.shiftrightunsigned(F.xxhash64(_text()), 64 - key_bits), 64 - key_bits)
    return columns(docs, "doc_id", "text").select("doc_id", _text().alias("text"), key.alias("key"))


# -- directory ----------------------------------------------------------------


class Directory:
    """Slots by the first ``depth`` bits of a key, each with the number of its bucket.

    A bucket has its own depth, ``bits``: it is all keys that share that many
    first bits, and takes 2^(depth - bits) slots.
    """

    def __init__(self, slots: np.ndarray | None = None, bits: list[int] | None = None):
        self.slots = np.zeros(1, np.int32) if slots is None else slots
        self.bits = [0] if bits is None else bits

    @property
    def depth(self) -> int:
        return int(len(self.slots)).bit_length() - 1

    def split(self, prefix: int, bits: int) -> None:
        """Split the bucket of the keys whose first ``bits`` bits are ``prefix``."""
        if bits == self.depth:
            self.slots = np.repeat(self.slots, 2)  # doubled: every slot becomes two of the same bucket
        spread = self.depth - bits
        bucket = int(self.slots[prefix << spread])
        if self.bits[bucket] != bits:
            raise ValueError("not the prefix of a bucket")
        half = 1 << (spread - 1)
        self.bits[bucket] = bits + 1
        self.bits.append(bits + 1)
        begin = (prefix << spread) + half
        self.slots[begin : begin + half] = len(self.bits) - 1

    def buckets(self, keys: np.ndarray) -> np.ndarray:
        """Bucket of each (signed) 64-bit key."""
        if not self.depth:
            return np.zeros(len(keys), np.int32)
        return self.slots[keys.view(np.uint64) >> np.uint64(64 - self.depth)]


def directory(rows: DataFrame, bucket_bytes: int = BUCKET_BYTES, most_bits: int = MOST_BITS) -> Directory:
    """The directory for ``keyed`` rows: buckets are split level by level until none is overfull."""
    per_key = rows.groupBy("key").agg(F.max(F.octet_length("text")).alias("size"))
    slot = F.shiftrightunsigned("key", 64 - most_bits)
    sizes = stored(
        per_key.groupBy(slot.alias("slot")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("keys")), "slots"
    )
    found = Directory()
    for bits in range(most_bits):
        prefix = F.shiftright("slot", most_bits - bits).alias("prefix")
        level = sizes.groupBy(prefix).agg(F.sum("size").alias("size"), F.sum("keys").alias("keys"))
        # a bucket of one key can't be split
        overfull = level.where((F.col("size") > bucket_bytes) & (F.col("keys") > 1)).select("prefix").collect()
        if not overfull:
            break
        for row in overfull:
            found.split(row.prefix, bits)
    return found


# -- entries ------------------------------------------------------------------


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    arrays = [pa.array(v, t) for v, t in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays([a.cast(pa.string()) if n == "text" else a for n, a in zip(names, arrays, strict=True)], names)


def _later(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else max(a, b)


def _chained(chain: list[list], text: bytes, keep: int | None, n: int) -> bool:
    """Add a row to the chain of its key; whether its text is a new one."""
    for entry in chain:
        if entry[0] == text:
            entry[1] = _later(entry[1], keep)
            entry[2] += n
            return False
    chain.append([text, keep, n])
    return True


def entries(rows: DataFrame, found: Directory) -> DataFrame:
    """``keyed`` rows folded task by task: one (bucket, key, text, keep_id, n) per text held."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[list]] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            buckets = found.buckets(np.fromiter(held, np.int64, len(held))).tolist()
            rows = [(b, key, *entry) for b, (key, chain) in zip(buckets, held.items(), strict=True) for entry in chain]
            for k in range(0, len(rows), 1000):
                yield _batch(
                    rows[k : k + 1000], ["bucket", "key", "text", "keep_id", "n"],
                    [pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64()],
                )

        for part in slices(batches):
            texts = part.column("text").cast(pa.binary()).to_pylist()
            for doc_id, key, text in zip(part.column("doc_id").to_pylist(), part.column("key").to_pylist(), texts, strict=True):
                if _chained(held.setdefault(key, []), text, doc_id, 1):
                    size += len(text) + 100
            if size >= HELD_BYTES:
                yield from out()
                held.clear()
                size = 0
        yield from out()

    return rows.mapInArrow(fold, _ENTRY)


def _own(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """An owner's walk over its buckets, in key order: chains of equal keys, by bytes."""
    names = ["bucket", "key", "chain", "chain_length", "keep_id", "group_size", "text_sha256", "text"]
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    done: list[tuple] = []
    size = 0
    at: tuple | None = None
    chain: list[list] = []

    def close() -> None:
        nonlocal size
        for k, (text, keep, n) in enumerate(sorted(chain)):
            done.append((*at, k, len(chain), keep, n, hashlib.sha256(text).hexdigest(), text))
            size += len(text)

    for part in slices(batches):
        texts = part.column("text").cast(pa.binary()).to_pylist()
        rest = [part.column(c).to_pylist() for c in ("bucket", "key", "keep_id", "n")]
        for bucket, key, keep, n, text in zip(*rest, texts, strict=True):
            if at != (bucket, key):
                if chain:
                    close()
                at, chain = (bucket, key), []
                if len(done) >= 1000 or size >= 1 << 20:
                    yield _batch(done, names, kinds)
                    done, size = [], 0
            _chained(chain, text, keep, n)
    if chain:
        close()
    if done:
        yield _batch(done, names, kinds)


# -- index --------------------------------------------------------------------


@dataclasses.dataclass(frozen=True)
class Index:
    """An index on shared files: ``entries`` and ``directory`` below ``path``.

    ``entries`` has one row per distinct text, in ranges of keys (``bucket``): keep_id, group_size,
    text_sha256, the text, and its place in the ``chain`` of its key.
    """

    path: str
    entries: DataFrame
    directory: DataFrame
    key_bits: int


def build(
    docs: DataFrame, path: str | None = None, bucket_bytes: int = BUCKET_BYTES, key_bits: int = KEY_BITS
) -> Index:
    """Index every row of ``docs``; ``path`` is a new folder that all executors share."""
    spark = docs.sparkSession
    path = path or scratch(spark, "index")
    rows = keyed(docs, key_bits)
    found = directory(rows, bucket_bytes)
    dealt = entries(rows, found).repartition("bucket").sortWithinPartitions("bucket", "key")
    dealt.mapInArrow(_own, _INDEX).write.option("compression", "zstd").parquet(f"{path}/entries")
    slots = [(k, int(b), found.bits[b]) for k, b in enumerate(found.slots.tolist())]
    slots = spark.createDataFrame(pa.table({
        "slot": pa.array([s[0] for s in slots], pa.int64()), "bucket": pa.array([s[1] for s in slots], pa.int32()),
        "bits": pa.array([s[2] for s in slots], pa.int32()), "key_bits": pa.array([key_bits] * len(slots), pa.int32()),
    }))
    slots.coalesce(1).write.parquet(f"{path}/directory")
    return open_index(spark, path)


def open_index(spark: SparkSession, path: str) -> Index:
    """An index that ``build`` has written, maybe in another session."""
    slots = spark.read.schema("slot long, bucket int, bits int, key_bits int").parquet(f"{path}/directory")
    return Index(path, spark.read.schema(_INDEX).parquet(f"{path}/entries"), slots, slots.first().key_bits)


_FOUND = ("keep_id", "group_size", "text_sha256")


def lookup(index: Index, docs: DataFrame, indexed: bool = False) -> DataFrame:
    """Every row of ``docs`` as (doc_id, copy, keep_id, group_size, text_sha256) of its entry, null if
    the index has no such text. ``copy`` numbers rows that repeat doc_id and text, from 1.

    ``indexed``: the index was built from these rows. Then a key of one text can
    only be that text, and texts are compared for chained keys alone; else for all.
    """
    rows = keyed(docs, index.key_bits)
    texts = index.entries.select("key", "text", *_FOUND)
    if not indexed:
        return _numbered(_repeats(rows, "key", "text").join(texts, ["key", "text"], "left"))
    alone = index.entries.where("chain_length = 1").select("key", *_FOUND)
    chained = index.entries.where("chain_length > 1")
    if chained.isEmpty():
        return _numbered(_repeats(rows, "key").join(alone, "key", "left"))
    many = chained.select("key").distinct()
    by_key = _repeats(rows, "key").join(many, "key", "left_anti").join(alone, "key", "left")
    by_text = _repeats(rows.join(many, "key", "left_semi"), "key", "text").join(texts, ["key", "text"], "left")
    return _numbered(by_key.unionByName(by_text.drop("text")))


def _repeats(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy("doc_id", *by).agg(F.count(F.lit(1)).alias("m"))


def _numbered(rows: DataFrame) -> DataFrame:
    """``m`` rows for each row, numbered by ``copy``; in runs, so that no array grows with ``m``."""
    runs = F.sequence(F.lit(0).cast("long"), F.expr(f"(m - 1) div {RUN}"))
    rows = rows.withColumn("run", F.explode(runs))
    first, last = F.col("run") * RUN + 1, F.least(F.col("m"), F.col("run") * RUN + RUN)
    return rows.withColumn("copy", F.explode(F.sequence(first, last))).select("doc_id", "copy", *_FOUND)


def duplicates(docs: DataFrame, **options) -> DataFrame:
    """Every row as doc_id, keep_id, group_size, kept, text_sha256."""
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    found = lookup(build(docs, **options), docs, indexed=True)
    return found.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def without_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; one row of those that repeat text and id.

    The rows are found again by their id and the text's SHA-256."""
    whole = docs.select(
        F.struct("*").alias("row"), F.col("doc_id"), F.sha2(_text(), 256).alias("text_sha256")
    )
    stay = duplicates(docs, **options).where("kept").select(F.col("keep_id"), F.col("text_sha256").alias("stays"))
    same = whole["doc_id"].eqNullSafe(stay["keep_id"]) & (whole["text_sha256"] == stay["stays"])
    rows = whole.join(stay, same, "left_semi").dropDuplicates(["doc_id", "text_sha256"])
    return rows.select("row.*")


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the one of its equals that stays (contract: op12)."""
    return duplicates(read(spark, sf_dir, "documents"))


#: The same result by grouping whole texts.
ORACLE = {
    "op12_exact_dedup": """
SELECT doc_id, MAX(doc_id) OVER (PARTITION BY COALESCE(text, '')) AS keep_id,
       COUNT(*) OVER (PARTITION BY COALESCE(text, '')) AS group_size,
       doc_id = MAX(doc_id) OVER (PARTITION BY COALESCE(text, '')) AS kept,
       sha256(COALESCE(text, '')) AS text_sha256
FROM documents
"""
}

QUERIES = {"op12_exact_dedup": op12_exact_dedup}
