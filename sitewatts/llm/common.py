"""Helpers shared by the llm operators: stored tables, Arrow batches, word hashes."""

from __future__ import annotations

import itertools
import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of text that a Python worker looks at in one go; its arrays take some fifty times that.
SLICE_BYTES = 1 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors share.

    Where a local session names none (tests), a temporary folder is used; on a
    cluster without a shared folder this raises.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-", dir=os.environ.get("TMPDIR", "/tmp"))
    return f"{base.rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, computes once."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns; other columns, however named, don't matter to an operator."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def slices(
    batches: Iterable[pa.RecordBatch], column: str = "text", max_bytes: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``max_bytes`` of text, or one row.

    ``column`` is the text column, or a struct that has a field ``text``.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = pc.fill_null(pc.binary_length(field(batch, column, "text")), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(size.astype(np.int64)) // max_bytes
        cuts = np.flatnonzero(np.diff(group)) + 1
        for a, b in itertools.pairwise([0, *cuts.tolist(), batch.num_rows]):
            yield batch.slice(a, b - a)


def field(batch: pa.RecordBatch, column: str, name: str) -> pa.Array:
    """The column, or if it's a struct its field ``name``."""
    whole = batch.column(column)
    return whole.field(name) if pa.types.is_struct(whole.type) else whole


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column as Python strings; null becomes the empty text."""
    return pc.fill_null(batch.column(column), "").to_pylist()


def map_rows(
    df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str | StructType, column: str = "text"
) -> DataFrame:
    """``mapInArrow`` over slices: ``fn`` gets a record batch and returns arrays by column name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, column):
            yield pa.RecordBatch.from_pydict(fn(part))

    return df.mapInArrow(run, schema)


# -- word hashes ------------------------------------------------------------

_ALNUM = np.zeros(256, bool)
_ALNUM[np.r_[48:58, 65:91, 97:123, 128:256]] = True
#: Multiplier of the polynomial byte hash, and the constants of the 64-bit finalizer (splitmix64).
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scramble."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX[0]
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX[1]
    return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


#: Bytes of words that only ASCII blanks separate.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[*range(9, 14), 32]] = False


def hashed_words(
    column: pa.Array, lower: bool = True, word_bytes: np.ndarray = _ALNUM, prefixes: tuple[int, ...] = ()
) -> tuple[np.ndarray, ...]:
    """Words of every text as (row of each word, 64-bit hash of each word).

    For each length in ``prefixes`` (bytes) an array more: the hash of the word's
    prefix, or 0 where the word isn't longer.

    By default texts are lower-cased and a word is a run of ASCII letters and
    digits and of non-ASCII characters. Null and empty texts have none. Whole
    texts are read; no Python loop.
    """
    column = pc.fill_null(column, "").cast(pa.large_string())
    if lower:
        column = pc.utf8_lower(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    none = (np.zeros(0, np.int64), *[np.zeros(0, np.uint64)] * (1 + len(prefixes)))
    if len(offsets) < 2 or offsets[-1] == offsets[0]:
        return none
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    rows = (offsets - offsets[0])[:-1]
    inside = word_bytes[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edge = rows[rows < len(data)]
    begins[edge] = inside[edge]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return none
    at = np.flatnonzero(inside)
    first = np.searchsorted(at, starts)
    length = np.diff(np.append(first, len(at)))
    place = np.arange(len(at)) - np.repeat(first, length)
    power = np.full(int(length.max()), _PRIME, np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    value = (data[at].astype(np.uint64) + np.uint64(1)) * power[place]
    hashes = mix(np.add.reduceat(value, first) + length.astype(np.uint64) * _MIX[0])
    heads = []
    for k in prefixes:
        part = np.add.reduceat(np.where(place < k, value, np.uint64(0)), first) + np.uint64(k * int(_MIX[1]) & 0xFFFFFFFFFFFFFFFF)
        heads.append(np.where(length > k, mix(part), np.uint64(0)))
    return np.searchsorted(rows, starts, side="right") - 1, hashes, *heads


def shingles(row: np.ndarray, word: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every run of ``n`` words; a text of fewer words is one shingle of all of them."""
    if not len(word):
        return row, word
    total = np.zeros(len(word), np.uint64)
    complete = np.ones(len(word), bool)
    head = np.append(True, row[1:] != row[:-1])
    for j in range(n):
        salt = mix(np.asarray([j + 1], np.uint64) * _PRIME)[0] | np.uint64(1)
        moved = np.zeros(len(word), np.uint64)
        if len(word) > j:
            same = np.append(row[j:] == row[: len(row) - j], np.zeros(j, bool))
            moved[: len(word) - j] = word[j:]
        else:
            same = np.zeros(len(word), bool)
        total += np.where(same, mix(moved * salt), np.uint64(0))
        complete &= same
    counts = np.diff(np.append(np.flatnonzero(head), len(word)))
    short = np.repeat(counts < n, counts)
    keep = complete | (short & head)
    return row[keep], mix(total[keep])
