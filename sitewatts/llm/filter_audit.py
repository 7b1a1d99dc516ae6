"""Filter interaction audit with a byte transducer (operator 13).

One finite-state pass over a text's UTF-8 bytes counts its words, capitals, code
points and symbols, and puts every word into a hash table that knows a word again by its
bytes. The automaton has two states, between words and in a word; ``STEP`` gives for a
state and a byte the next state and what to count. The next state depends on the byte
alone, so the states of all places of a batch are known at once and the table is
looked up for all of them together; a text begins between words. The hash table has
open addressing; words that meet in a slot are the same only if their text, length, hash and
then all their bytes are.

The measures decide which of the filters a text fails, as bits. Whether a text is
repeated is told by its SHA-256: the smallest id of each digest comes from an
aggregation that folds copies before they are shuffled; texts aren't. Rows are then
counted by part, failed filters and labels, and the orders of the filters are replayed on
these counts: what a filter removes in an order depends on the bits alone.

Null text counts as empty (it fails A, and E if another such text has a smaller id),
null ``lang`` as the empty string. A row without ``doc_id`` has no labels, and no row has a
smaller id than another by it: it never fails E. Repeated rows count as often as they
stand and aren't copies of themselves. Repeated labels: 1 if any of them is. Other
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewatts.llm.common import columns, map_rows, mix, read, stored

FILTERS = "ABCDE"
LEAST_WORDS = 200
#: Least distinct words in a hundred words, most capitals in a hundred code points.
DISTINCT_SHARE, CAPITAL_SHARE = 50, 3
SYMBOLS = "#$%&*|"

# -- the transducer -----------------------------------------------------------

#: What a step tells.
WORD, POINT, CAPITAL, SYMBOL, END = 1, 2, 4, 8, 16
BETWEEN, INSIDE = 0, 1


def _steps(symbols: str = SYMBOLS) -> tuple[np.ndarray, np.ndarray]:
    """(next state, signals) for each state (row) and byte (column)."""
    state = np.full((2, 256), INSIDE, np.uint8)
    state[:, [*range(9, 14), 32]] = BETWEEN
    tells = np.full((2, 256), POINT, np.uint8)
    tells[:, 0x80:0xC0] = 0  # goes on with a code point
    tells[:, ord("A") : ord("Z") + 1] |= CAPITAL
    tells[:, list(symbols.encode())] |= SYMBOL
    tells[BETWEEN] |= np.where(state[BETWEEN] == INSIDE, WORD, 0).astype(np.uint8)
    tells[INSIDE] |= np.where(state[INSIDE] == BETWEEN, END, 0).astype(np.uint8)
    return state, tells


STEP, TELL = _steps()


def transduce(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signals of each byte, first byte of each word, byte after each word).

    ``begins`` are the places where texts begin.
    """
    after = STEP[BETWEEN][data]  # the same in both rows of STEP
    before = np.append(np.uint8(BETWEEN), after[:-1])
    starts = begins[begins < len(data)]
    ended = starts[before[starts] == INSIDE]  # words that end with their text
    before[starts] = BETWEEN
    tells = TELL[before, data]
    word = np.flatnonzero(tells & WORD)
    end = np.union1d(np.flatnonzero(tells & END), ended)
    if len(end) < len(word):
        end = np.append(end, len(data))
    return tells, word, end


# -- the hash table -----------------------------------------------------------

_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _places(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All places of the spans, one span after the other."""
    total = np.cumsum(length)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(start - (total - length), length)


def _hashes(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    at = _places(start, length)
    first = np.cumsum(length) - length
    power = np.full(int(length.max()), _PRIME, np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    value = (data[at].astype(np.uint64) + np.uint64(1)) * power[np.arange(len(at)) - np.repeat(first, length)]
    return np.add.reduceat(value, first)


def _equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the spans that start at ``a`` and ``b`` hold the same bytes."""
    differ = data[_places(a, length)] != data[_places(b, length)]
    return np.add.reduceat(differ.astype(np.int64), np.cumsum(length) - length) == 0 if len(length) else np.zeros(0, bool)


def distinct(data: np.ndarray, row: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Which words are the first of their bytes in their row; spans are put into a table with open addressing."""
    n = len(row)
    first = np.zeros(n, bool)
    if not n:
        return first
    value = _hashes(data, start, length)
    size = 1 << int(2 * n).bit_length()
    slot = mix(value ^ mix(row.astype(np.uint64) * _PRIME)) & np.uint64(size - 1)
    table = np.full(size, -1, np.int64)
    left = np.arange(n)
    while len(left):
        at = slot[left]
        free = table[at] < 0
        table[at[free][::-1]] = left[free][::-1]  # of several words at a free slot the first takes it
        holder = table[at]
        mine = holder == left
        first[left[mine]] = True
        known = mine.copy()
        maybe = np.flatnonzero(~mine & (row[holder] == row[left]) & (length[holder] == length[left]) & (value[holder] == value[left]))
        known[maybe] = _equal(data, start[left[maybe]], start[holder[maybe]], length[left[maybe]])
        left = left[~known]
        slot[left] = (slot[left] + np.uint64(1)) & np.uint64(size - 1)
    return first


# -- measures -----------------------------------------------------------------

MEASURES = "n_words long, n_distinct long, n_capitals long, n_points long, n_symbols long"


def measured(column: pa.Array) -> dict[str, np.ndarray]:
    """The measures of every text of an Arrow string column; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    rows = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + rows + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    tells, start, end = transduce(data, offsets[:-1]) if len(data) else (np.zeros(0, np.uint8), *[np.zeros(0, np.int64)] * 2)

    def per_row(signal: int) -> np.ndarray:
        total = np.append(0, np.cumsum((tells & signal) != 0))
        return total[offsets[1:]] - total[offsets[:-1]]

    row = np.searchsorted(offsets[1:], start, side="right")
    new = distinct(data, row, start, end - start)
    return {
        "n_words": per_row(WORD),
        "n_distinct": np.bincount(row[new], minlength=rows),
        "n_capitals": per_row(CAPITAL),
        "n_points": per_row(POINT),
        "n_symbols": per_row(SYMBOL),
    }


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, digest (SHA-256 of the text) and the measures of every row."""

    def look(part: pa.RecordBatch) -> dict:
        text = pc.fill_null(part.column("text"), "")
        digests = [hashlib.sha256(t).digest() for t in text.cast(pa.binary()).to_pylist()]
        lang = pc.fill_null(part.column("lang"), "")
        found = {k: pa.array(v, pa.int64()) for k, v in measured(text).items()}
        return {"doc_id": part.column("doc_id"), "lang": lang, "digest": pa.array(digests, pa.binary()), **found}

    rows = columns(docs, "doc_id", "text", "lang").select(F.col("doc_id").cast("long"), "text", "lang")
    return map_rows(rows, look, f"doc_id long, lang string, digest binary, {MEASURES}")


def failed_alone() -> list[Column]:
    """Failure conditions of the filters that look at one text, in the order of FILTERS."""
    words = F.col("n_words")
    return [
        words < LEAST_WORDS,
        100 * F.col("n_distinct") < DISTINCT_SHARE * words,
        100 * F.col("n_capitals") > CAPITAL_SHARE * F.col("n_points"),
        F.col("n_symbols") > 0,
    ]


def verdicts(docs: DataFrame) -> DataFrame:
    """(doc_id, part, fails, n): rows with the bits of the filters they fail (A is 1, B is 2, ...)."""
    bits = sum((F.when(c, F.lit(1 << k)).otherwise(F.lit(0)) for k, c in enumerate(failed_alone())), F.lit(0))
    texts = stored(measures(docs).select("doc_id", F.col("lang").alias("part"), "digest", bits.cast("int").alias("fails")), "verdicts")
    first = texts.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    rows = texts.groupBy("doc_id", "digest", "part", "fails").agg(F.count(F.lit(1)).alias("n"))
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return rows.join(first, ["doc_id", "digest"], "left").select(
        "doc_id", "part", F.when(copy, F.col("fails") + F.lit(1 << (len(FILTERS) - 1))).otherwise(F.col("fails")).alias("fails"), "n"
    )


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``verdicts`` with good and toxic (0 or 1) from the labels."""
    one = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c)
    known = columns(labels, "doc_id", "quality", "toxic").where("doc_id is not null")
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(one("quality"), one("toxic"))
    return rows.join(known, "doc_id", "left").select(
        "part", "fails", "n", F.coalesce("quality", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")
    )


# -- replay -------------------------------------------------------------------


def replay(rows: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Every order of the filters on counted verdicts (part, fails, n, good, toxic).

    One row per part, order and step. Filters are letters; the k-th has bit k. Counts
    per part and bits are at most 2^len(filters) rows a part, whatever the input.
    """
    counted = rows.groupBy("part", "fails").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
    )
    orders = ["".join(p) for p in itertools.permutations(filters)]
    steps = counted.withColumn("filter_order", F.explode(F.lit(orders))).withColumn(
        "step", F.explode(F.lit(list(range(1, len(filters) + 1))))
    )
    before = "+".join(f"IF(instr(filter_order, '{f}') < step, {1 << k}, 0)" for k, f in enumerate(filters))
    steps = steps.withColumns({"letter": F.expr("substr(filter_order, step, 1)"), "before": F.expr(before)})
    steps = steps.withColumn("bit", F.expr(f"shiftleft(1, instr('{filters}', letter) - 1)"))
    there, fails = (F.col("fails").bitwiseAND(F.col(c)) != 0 for c in ("before", "bit"))
    only = F.col("fails") == F.col("bit")
    total = lambda cond, c="n": F.sum(F.when(cond, F.col(c)).otherwise(F.lit(0))).cast("long")
    told = steps.groupBy("part", "filter_order", "step", "letter").agg(
        total(~there & ~fails).alias("kept"),
        total(~there & fails).alias("removed"),
        total(there & fails).alias("redundant"),
        total(only).alias("unique_fails"),
        total(~there & fails, "good").alias("good_lost"),
        total(~there & fails, "toxic").alias("toxic_lost"),
    )
    shares = told.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    return told.join(shares, ["part", "letter"]).select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), "kept", "removed", "redundant", "unique_fails",
        "good_lost", "toxic_lost", "shapley",
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all orders over all documents (contract: op13)."""
    rows = with_labels(verdicts(read(spark, sf_dir, "documents")), read(spark, sf_dir, "labels"))
    counted = rows.groupBy("part", "fails", "good", "toxic").agg(F.sum("n").alias("n"))
    return replay(stored(counted, "verdict-counts"))


ORACLE = {
    "op13_filter_audit": r"""
WITH texts AS (
  SELECT doc_id, COALESCE(text, '') AS t, COALESCE(lang, '') AS part,
         regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), marks AS (
  SELECT max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic, doc_id FROM labels GROUP BY doc_id
), verdicts AS (
  SELECT part, COALESCE(good, 0) AS good, COALESCE(toxic, 0) AS toxic,
         len(words) < 200 AS A,
         100 * len(list_distinct(words)) < 50 * len(words) AS B,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS C,
         regexp_matches(t, '[#$%&*|]') AS D,
         doc_id > min(doc_id) OVER (PARTITION BY t) AS E
  FROM texts LEFT JOIN marks USING (doc_id)
), bits AS (
  SELECT part, CAST(A AS INT) + 2 * CAST(B AS INT) + 4 * CAST(C AS INT) + 8 * CAST(D AS INT) + 16 * CAST(E AS INT) AS fails,
         count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM verdicts GROUP BY ALL
), letters(f, bit) AS (
  VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), steps AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, s.step, s.f, s.bit, s.before
  FROM letters a, letters b, letters c, letters d, letters e,
  LATERAL (VALUES (1, a.f, a.bit, 0), (2, b.f, b.bit, a.bit), (3, c.f, c.bit, a.bit + b.bit),
                  (4, d.f, d.bit, a.bit + b.bit + c.bit), (5, e.f, e.bit, a.bit + b.bit + c.bit + d.bit)) s(step, f, bit, before)
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31
), told AS (
  SELECT part, filter_order, CAST(step AS INT) AS step, f,
         CAST(sum(CASE WHEN fails & (before | bit) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
         CAST(sum(CASE WHEN fails & before = 0 AND fails & bit <> 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
         CAST(sum(CASE WHEN fails & before <> 0 AND fails & bit <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(sum(CASE WHEN fails = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(sum(CASE WHEN fails & before = 0 AND fails & bit <> 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(sum(CASE WHEN fails & before = 0 AND fails & bit <> 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM bits CROSS JOIN steps GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM told
"""
}

QUERIES = {"op13_filter_audit": op13_filter_audit}
