"""Quality rules from tokenizer fertility.

Two public vocabularies measure every text: characters per token under each,
the share of byte-fallback tokens under the one that falls back to bytes, and the
entropy of its tokens as a share of the most that so many tokens could have. A
text is rejected if a measure leaves its band. Bands come from the corpus itself:
median and quartile range over all documents of the same language (where that's
null, of the same dominant script) and similar length. A group of n documents counts
with weight n / (n + prior) and the level above it (its language, then the whole
corpus) with the rest, so there is no size at which a group's band changes at once. A
language's spread is that of the mixture, with the distance of the two centres in it: a
small language that lies apart widens its band instead of losing its documents. The
lengths of one language lie within its spread; theirs is the weighted geometric mean of their
own and the language's, so a handful of odd texts among few can't widen it much. Spreads have
a floor, so a group that is mostly copies of one text doesn't reject everything else.

Base rules come first (contract): too few words or too many repeated windows.

Null texts are empty texts; a text without words fails the base rules. Rows with
equal text get equal results. A null language is judged by script. An empty table
gives an empty result.
"""

from __future__ import annotations

import functools
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewatts.llm import vocab
from sitewatts.llm.common import NOT_BLANK, hashed_words, read, shingles, slices, stored, texts

PIECES = "piece_bpe_32k.model"
BYTES = "byte_bpe_50k.json"
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
#: Measure -> (spreads allowed below, above the median; least spread). None: no bound on that side.
BANDS = {
    "piece_chars": (5.0, 8.0, 0.045),
    "byte_chars": (5.0, 8.0, 0.045),
    "fallback_share": (None, 8.0, 0.01),
    "entropy": (5.0, None, 0.012),
}
#: Documents that the level above a language, and above a length of one, weighs.
PRIOR, LENGTH_PRIOR = 50, 300
#: Quartile range of a normal distribution, in standard deviations.
QUARTILE_RANGE = 1.349


@functools.cache
def _pieces(file: str) -> tuple[sentencepiece.SentencePieceProcessor, np.ndarray]:
    model = sentencepiece.SentencePieceProcessor(model_file=file)
    return model, np.array([model.is_byte(i) for i in range(model.vocab_size())])


def script(text: str) -> str:
    """The script that most letters of a text are of, by the first word of their Unicode names."""
    letters = Counter(c for c in text if c.isalpha())
    found: Counter = Counter()
    for c, n in letters.items():
        found[unicodedata.name(c, "OTHER").split(" ")[0].split("-")[0]] += n
    return min(found, key=lambda k: (-found[k], k), default="NONE")


def repeated_words(column: pa.Array, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Per row: words, and words that lie in a window found twice or more in the row."""
    row, word = hashed_words(column, lower=False, word_bytes=NOT_BLANK)
    n = len(column)
    words = np.bincount(row, minlength=n)
    if len(row) < window:
        return words, np.zeros(n, np.int64)
    whole = np.flatnonzero(row[window - 1 :] == row[: len(row) - window + 1])  # starts of complete windows
    if not len(whole):
        return words, np.zeros(n, np.int64)
    inside = words[row] >= window
    wrow, key = shingles(row[inside], word[inside], window)
    order = np.lexsort((key, wrow))
    same = (wrow[order][1:] == wrow[order][:-1]) & (key[order][1:] == key[order][:-1])
    twice = np.zeros(len(whole), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    mark = np.zeros(len(row) + 1, np.int64)
    np.add.at(mark, whole[twice], 1)
    np.add.at(mark, whole[twice] + window, -1)
    covered = np.cumsum(mark[:-1]) > 0
    return words, np.bincount(row[covered], minlength=n)


def measured(docs: DataFrame, language: str | None, pieces: str, byte_level: str) -> DataFrame:
    """doc_id, grp (language or script), the base measures and those of the method."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, is_byte = _pieces(pieces)
        size = len(is_byte)
        for batch in slices(batches):
            rows = texts(batch)
            n = len(rows)
            words, repeated = repeated_words(batch.column("text"))
            chars = np.array([len(t) - sum(map(t.count, BLANKS)) for t in rows], np.int64)
            dup_lines = []
            for t in rows:
                lines = [x for x in t.split("\n") if x.strip(BLANKS)]
                dup_lines.append(len(lines) - len(set(lines)))
            coded = [np.array(ids, np.int64) for ids in model.encode(rows, num_threads=1)]
            sizes = np.array([len(x) for x in coded], np.int64)
            flat = np.concatenate(coded) if coded else np.zeros(0, np.int64)
            owner = np.repeat(np.arange(n), sizes)
            fallback = np.bincount(owner, is_byte[flat], n)
            pair, count = np.unique(owner * size + flat, return_counts=True)
            share = count / sizes[pair // size]
            entropy = -np.bincount(pair // size, share * np.log2(share), n)
            byte_tokens = np.array([len(x) for x in vocab.encode_bytes(byte_level, rows)], np.int64)
            some = np.maximum(sizes, 1)
            out = {
                "doc_id": batch.column("doc_id"),
                "grp": pa.array([g if g is not None else script(t) for g, t in zip(batch.column("lang").to_pylist(), rows, strict=True)], pa.string()),
                "n_words": pa.array(words, pa.int64()),
                "word_chars": pa.array(chars, pa.int64()),
                "n_symbols": pa.array([sum(map(t.count, SYMBOLS)) for t in rows], pa.int64()),
                "n_dup_lines": pa.array(dup_lines, pa.int64()),
                "n_repeat_words": pa.array(repeated, pa.int64()),
                "piece_chars": pa.array(chars / some),
                "byte_chars": pa.array(chars / np.maximum(byte_tokens, 1)),
                "fallback_share": pa.array(fallback / some),
                "entropy": pa.array(entropy / np.log2(np.maximum(sizes, 2))),
            }
            yield pa.RecordBatch.from_pydict(out)

    picked = docs.select("doc_id", "text", F.col(language).alias("lang") if language else F.lit(None).cast("string").alias("lang"))
    return picked.mapInArrow(
        run,
        "doc_id long, grp string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "piece_chars double, byte_chars double, fallback_share double, entropy double",
    )


def _mixed(rows: DataFrame, apart: bool) -> DataFrame:
    """Centre and spread of each group (m_mid, m_spread) mixed with the level above (m_up_mid, m_up_spread).

    ``apart``: as a mixture of two, whose centres may lie apart; else the geometric mean of the spreads.
    """
    w = F.col("docs") / (F.col("docs") + F.lit(PRIOR if apart else LENGTH_PRIOR))
    out = {}
    for m, (_, _, least) in BANDS.items():
        mid, up_mid = F.col(f"{m}_mid"), F.col(f"{m}_up_mid")
        spread, up_spread = (F.greatest(F.col(f"{m}_{c}"), F.lit(least)) for c in ("spread", "up_spread"))
        out[f"{m}_mid"] = w * mid + (1 - w) * up_mid
        between = w * (1 - w) * (mid - up_mid) * (mid - up_mid)
        mixture = F.sqrt(w * spread * spread + (1 - w) * up_spread * up_spread + between)
        out[f"{m}_spread"] = mixture if apart else F.pow(spread, w) * F.pow(up_spread, 1 - w)
    return rows.withColumns(out).select("grp", "size", "docs", *out)


def bands(measures: DataFrame) -> DataFrame:
    """grp, size (of texts of about the same length), docs, and lo and hi of each measure.

    Only rows of texts that pass the base rules are to be given. One pass gives the quartiles of
    all three levels; what is joined afterwards are groups: languages times about 40 lengths.
    """
    quartiles = [F.percentile_approx(m, [0.25, 0.5, 0.75], 1000).alias(m) for m in BANDS]
    levels = measures.rollup("grp", "size").agg(F.grouping_id().alias("level"), F.count(F.lit(1)).alias("docs"), *quartiles)
    shape = {f"{m}_mid": F.get(F.col(m), F.lit(1)) for m in BANDS}
    shape |= {f"{m}_spread": (F.get(F.col(m), F.lit(2)) - F.get(F.col(m), F.lit(0))) / QUARTILE_RANGE for m in BANDS}
    levels = stored(levels.withColumns(shape).drop(*BANDS), "levels")
    whole = levels.where("level = 3").first()
    names = [f"{m}_{c}" for m in BANDS for c in ("mid", "spread")]
    up = {n.replace("_mid", "_up_mid").replace("_spread", "_up_spread"): F.lit(whole[n] if whole else None).cast("double") for n in names}
    by_group = _mixed(levels.where("level = 1").withColumns(up), apart=True)
    above = by_group.select("grp", *[F.col(n).alias(u) for n, u in zip(names, up, strict=True)])
    cells = _mixed(levels.where("level = 0").join(above, "grp"), apart=False)
    limits = []
    for m, (below, over, _) in BANDS.items():
        wide = F.col(f"{m}_spread")
        limits.append((F.col(f"{m}_mid") - below * wide if below else F.lit(float("-inf"))).alias(f"{m}_lo"))
        limits.append((F.col(f"{m}_mid") + over * wide if over else F.lit(float("inf"))).alias(f"{m}_hi"))
    return cells.select("grp", "size", "docs", *limits)


def fertility(
    docs: DataFrame, language: str | None = "lang", pieces: str | None = None, byte_level: str | None = None
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, and the language column if named).

    doc_id, the base measures, base_failed, kept, the method's measures and
    ``failed_measures`` (which left their band, comma-joined; empty for texts like which none passes the base rules).
    """
    measures = stored(
        measured(docs, language, pieces or vocab.path(PIECES), byte_level or vocab.path(BYTES)).withColumn(
            "base_failed",
            (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")),
        ).withColumn("size", F.floor(2 * F.log2(F.greatest("n_words", F.lit(1)))).cast("int")),
        "fertility",
    )
    limits = stored(bands(measures.where("not base_failed")).drop("docs"), "bands")
    joined = measures.join(limits, ["grp", "size"], "left")
    outside = [F.when((F.col(m) < F.col(f"{m}_lo")) | (F.col(m) > F.col(f"{m}_hi")), m) for m in BANDS]
    judged = joined.withColumn("failed_measures", F.concat_ws(",", *outside))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("failed_measures") == "")).alias("kept"), *BANDS, "failed_measures",
    )


def op1_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility(read(spark, sf_dir, "documents"))


QUERIES = {"op1_fertility": op1_fertility}
