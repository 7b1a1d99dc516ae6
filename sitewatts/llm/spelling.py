"""Spelling variants by permuterm rotations (operator 11).

A word ``abc`` gets a terminator, ``abc$``, and all rotations of that are sorted.
Cutting the last letter ``c`` off a rotation ``b$ac`` leaves ``b$a``: the rest of the
word round the letter that is skipped. Words that have the same rest differ by the
skipped letter only (a replacement), and a word of which the rest is a whole rotation
has one letter less (an insertion, seen from the other side a deletion). So every
neighbour at distance one stands in the same range of the sorted rotations, and one
scan over the groups of equal prefixes finds them all.

* A group holds at most one word per letter of the alphabet and one whole rotation.
  A member is told how many neighbours it has there and the best of them; pairs
  aren't expanded. Deleting either of two equal letters in a row gives the same
  word, so only the first of them counts for deletions: no pair is met twice.
* The rows of a word are as many as twice its letters. Prefixes longer than
  ``INLINE`` letters are keys by length and a 127-bit polynomial fingerprint instead
  of their letters, so the rows of a word of any length stay small.
* Roots follow the forms by pointer doubling; a form has at least ``factor`` times
  the word's count, so there are no rings and the rounds grow with the logarithm
  of the logarithm of the largest count.

Null and empty texts have no words; repeated rows count as often as they stand;
a null ``doc_id`` reads as an empty one; an empty table gives an empty result;
other columns are ignored. Ties between forms go to the smallest word in code-point
order. Words are runs of ``[A-Za-z\\u00C0-\\u00FF]``, with A-Z (and only these) lowered.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewatts.llm.common import columns, read, slices, stored, texts

LEAST_LENGTH = 5
LEAST_COUNT = 3
FACTOR = 2
#: The contract of op11 damages one of so many (document, word) pairs.
DAMAGE = 97

#: Longest prefix (letters and terminator) that is a key as it stands.
INLINE = 64
#: Words and bytes of them that a task holds before it passes partial counts on.
HELD_WORDS, HELD_BYTES = 100_000, 8 << 20

_END = "$"
#: One byte a letter in Latin-1; bytes.lower() touches A-Z only.
_RUN = re.compile(rb"[a-z\xc0-\xff]+")
_MODULUS = (1 << 127) - 1
_BASE = 0x2545F4914F6CDD1D9E3779B97F4A7C15


# -- word counts --------------------------------------------------------------


def runs(text: str) -> Counter:
    """How often each lower-cased run of letters stands in the text, as Latin-1 bytes."""
    return Counter(_RUN.findall(text.encode("latin-1", "replace").lower()))


def damaged(run: bytes, crc_of_id: int, every: int) -> bytes:
    """The run, without one of its letters if ``every`` divides the checksum of ``<doc_id>:<run>``."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), crc_of_id)
    if h % every:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1 :]


def word_counts(
    docs: DataFrame, damage: int | None = None, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT
) -> DataFrame:
    """(word, n) of all words of at least ``least_length`` letters and ``least_count`` places."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def rows() -> pa.RecordBatch:
            words = [w.decode("latin-1") for w in seen]
            return pa.RecordBatch.from_pydict({"word": pa.array(words, pa.string()), "n": pa.array(seen.values(), pa.int64())})

        for part in slices(batches):
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts(part), strict=True):
                crc = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in runs(text).items():
                    word = damaged(run, crc, damage) if damage else run
                    if len(word) >= least_length:
                        seen[word] += n
            if len(seen) >= HELD_WORDS or sum(map(len, seen)) >= HELD_BYTES:
                yield rows()
                seen.clear()
        if seen:
            yield rows()

    partial = columns(docs, "doc_id", "text").mapInArrow(count, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# -- rotations ----------------------------------------------------------------

_ROTATIONS = "prefix string, skipped string, n long, name string"
#: Marks a skipped letter that is the same as the one before it.
_AGAIN = "="


def name_of(word: str) -> str:
    """What rows of long prefixes call a word by: itself, or its digest if it's long."""
    return word if len(word) <= INLINE else "#" + hashlib.sha256(word.encode()).hexdigest()


def _fingerprints(ring: str, length: int, n: int) -> list[str]:
    """Keys of the ``n`` substrings of ``ring`` of that length, from its start on."""
    sums, power = [0], pow(_BASE, length, _MODULUS)
    for ch in ring:
        sums.append((sums[-1] * _BASE + ord(ch) + 1) % _MODULUS)
    return [f"#{length}:{(sums[k + length] - sums[k] * power) % _MODULUS:032x}" for k in range(n)]


def rotations(words: DataFrame) -> DataFrame:
    """Every rotation of every word as (prefix, skipped, n, name).

    ``skipped`` is the skipped letter, with a mark if it's the same as the one before
    it, and empty for a whole rotation. ``name`` is set for fingerprint keys only.
    """

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix: list[str] = []
        skipped: list[str] = []
        count: list[int] = []
        name: list[str | None] = []

        def rows() -> pa.RecordBatch:
            kinds = (pa.string(), pa.string(), pa.int64(), pa.string())
            arrays = [pa.array(v, t) for v, t in zip((prefix, skipped, count, name), kinds, strict=True)]
            for v in (prefix, skipped, count, name):
                v.clear()
            return pa.RecordBatch.from_arrays(arrays, ["prefix", "skipped", "n", "name"])

        for batch in batches:
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                length = len(word)
                ring = word + _END + word
                keys = (
                    [ring[k : k + length] for k in range(1, length + 1)] if length <= INLINE
                    else _fingerprints(ring[1:], length, length)
                )
                whole = (
                    [ring[k : k + length + 1] for k in range(length + 1)] if length < INLINE
                    else _fingerprints(ring, length + 1, length + 1)
                )
                called = name_of(word)
                prefix += keys
                prefix += whole
                skipped += word[:1]
                skipped += [b + _AGAIN if a == b else b for a, b in itertools.pairwise(word)]
                skipped += [""] * (length + 1)
                count += [n] * (2 * length + 1)
                name += [called if length > INLINE else None] * length
                name += [called if length >= INLINE else None] * (length + 1)
                if len(prefix) >= 20_000:
                    yield rows()
        if prefix:
            yield rows()

    return words.mapInArrow(turn, _ROTATIONS)


def _members(prefix: str, skipped: list[str], names: list[str | None]) -> list[str]:
    """The words (or names) of a group's rows."""
    if names[0] is not None:
        return names
    right, left = prefix.split(_END)
    return [left + c[:1] + right for c in skipped]


def _told(group: tuple, out: tuple[list, list, list, list]) -> None:
    """Neighbours of the members of one group, whose rows are sorted by count downwards, then letter."""
    prefix, skipped, n, names = group
    words = _members(prefix, skipped, names)
    whole = skipped.index("") if "" in skipped else None
    letters = [k for k in range(len(n)) if k != whole]

    def tell(of: int, near: int, best: int) -> None:
        out[0].append(words[of])
        out[1].append(near)
        out[2].append(words[best])
        out[3].append(n[best])

    if len(letters) > 1:
        for k in letters:
            tell(k, len(letters) - 1, letters[0] if k != letters[0] else letters[1])
    if whole is not None:
        longer = [k for k in letters if len(skipped[k]) == 1]
        for k in longer:
            tell(k, 1, whole)
        if longer:
            tell(whole, len(longer), longer[0])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pass over sorted rotations; what is held over a batch's end is one group."""

    def groups(batch: pa.RecordBatch, same: np.ndarray) -> pa.RecordBatch:
        # only members of groups of two or more are looked at one by one
        shared = np.append(False, same) | np.append(same, False)
        rows = batch.filter(pa.array(shared))
        prefix = rows.column("prefix").to_pylist()
        cuts = [*np.flatnonzero(~np.append(False, same)[shared]).tolist(), len(prefix)]
        skipped, n, names = (rows.column(c).to_pylist() for c in ("skipped", "n", "name"))
        out: tuple[list, list, list, list] = ([], [], [], [])
        for a, b in itertools.pairwise(cuts):
            _told((prefix[a], skipped[a:b], n[a:b], names[a:b]), out)
        return pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()), pa.array(out[3], pa.int64())],
            ["word", "near", "other", "other_n"],
        )

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        prefix = batch.column("prefix")
        same = pc.equal(prefix.slice(1), prefix.slice(0, len(prefix) - 1)).to_numpy(zero_copy_only=False).astype(bool)
        edges = np.flatnonzero(~same)
        begin = int(edges[-1]) + 1 if len(edges) else 0
        held = batch.slice(begin)
        if begin:
            yield groups(batch.slice(0, begin), same[: begin - 1])
    if held is not None:
        yield groups(held, np.ones(held.num_rows - 1, bool))


def neighbours(words: DataFrame) -> DataFrame:
    """Words with a neighbour: (word, n_near, other, other_n), ``other`` being the neighbour of the
    largest count (ties: the smallest word). ``words`` has one row (word, n) per word."""
    # a word has many rotations: its rows are made in as many tasks as they are sorted in
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rotations(columns(words, "word", "n").repartition(tasks, "word"))
    ordered = rows.repartition("prefix").sortWithinPartitions("prefix", F.desc("n"), "skipped")
    told = ordered.mapInArrow(_scan, "word string, near long, other string, other_n long")
    long = words.where(F.length("word") > INLINE)
    if not long.isEmpty():  # digests back to words
        names = long.select(F.concat(F.lit("#"), F.sha2(F.col("word"), 256)).alias("name"), F.col("word").alias("full"))
        for c in ("word", "other"):
            told = told.join(names.withColumnRenamed("name", c), c, "left").withColumn(c, F.coalesce("full", c)).drop("full")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    near = told.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best"))
    return near.select("word", "n_near", "best.other", (-F.col("best.less")).alias("other_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the links (word, form): the last of the chain of forms."""
    links = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        next_ = links.select(F.col("word").alias("root"), F.col("root").alias("after"))
        step = links.join(next_, "root", "left").select("word", F.coalesce("after", "root").alias("root"), F.col("after").isNotNull().alias("moved"))
        step = stored(step, "roots")
        links = step.select("word", "root")
        if step.where("moved").isEmpty():
            return links


def variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """word, form, root, n, n_near, form_n for every row (word, n) of ``words``.

    The form is the neighbour of the largest count if that is at least ``factor``
    (above 1) times the word's; the root is the last form of its chain, or the word.
    """
    if factor <= 1:
        raise ValueError("factor must be above 1: a form has to be commoner than the word")
    near = neighbours(words)
    counted = words.select("word", "n").join(near, "word", "left")
    better = F.col("other_n") >= F.lit(factor) * F.col("n")
    linked = stored(
        counted.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(better, F.col("other")).alias("form"), F.when(better, F.col("other_n")).alias("form_n"),
        ),
        "variants",
    )
    last = roots(linked.where("form is not null"))
    return linked.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their neighbours' number, form and root (contract: op11)."""
    words = stored(word_counts(read(spark, sf_dir, "documents"), damage=DAMAGE), "words")
    return variants(words)


QUERIES = {"op11_spelling_variants": op11_spelling_variants}
