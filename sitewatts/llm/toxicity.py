"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a text: densities of the words of a given lexicon, as written and after
undoing look-alike characters; densities of a learned lexicon (words and word
beginnings that toxic texts have far more often); lexicon words near a second
person; second persons; capitals; words all in capitals; exclamation and question
marks; symbols; digits; length. Folds are crc32(doc_id as text) modulo 5: the learned
lexicon comes from folds 2 and 3, the trees (logistic loss) from fold 4, the isotonic
calibration from fold 1, and fold 0 (``held_out``) is never learned from.

Learning takes a bounded sample: of each class at most SAMPLE labelled rows, those
with the smallest hash of doc_id, weighted to stand for all of their class. So the
sample's ids can be broadcast and texts need no shuffle; every row is scored.

Inputs of a score are the text's features only. A null or empty text has all
features 0 and gets the score of such a text. Repeated rows get equal scores. A
doc_id with several labels counts as toxic if one says so; null labels are left out.
A row without doc_id is held out. Without labelled rows of both classes the score
is the share of toxic labels (0 without labels). An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewatts.llm.common import columns, field, hashed_words, read, slices, stored

#: Insults of the languages at hand, lower case.
LEXICON = (
    "idiot idiots moron morons stupid dumb loser losers trash garbage scum pathetic worthless disgusting clown clowns "
    "imbecile fool fools jerk creep freak pig filth filthy vermin parasite coward liar disgrace brainless ugly useless "
    "dummkopf trottel idioten abschaum dreck versager ekelhaft blöd blöder arschloch penner "
    "imbécile crétin débile connard ordure minable dégoûtant nul salaud "
    "idiota estúpido estúpida imbécil basura escoria patético asqueroso inútil payaso"
).split()
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine ihr euch tu toi ton ta tes vous votre vos te ti tú tus usted ustedes"
).split()
#: A lexicon word counts as addressed if a second person is at most so many words away.
NEAR = 5
FOLDS = 5
TREES, DEPTH, SEED = 20, 4, 17
#: Calibration sees margins in bins of this width, so its table doesn't grow with the rows.
BIN = 0.02
#: Labelled rows of each class that learning sees at most.
SAMPLE = 10_000
#: Bytes of word beginnings that the learned lexicon may hold, toxic texts that an entry needs,
#: and its least weighted log odds. (Entries come from the sample, so they are bounded by its words.)
PREFIXES = (5, 7)
LEAST_TEXTS, LEAST_ODDS = 5, 1.5
#: Log odds from which on a word counts as one of the learned lexicon.
STRONG = 2.5
FEATURES = (
    "lexicon", "lexicon_log", "disguised", "learned", "learned_log", "learned_hits", "second", "addressed",
    "capitals", "shouted", "marks", "symbols", "digits", "length",
)

#: Look-alike characters and the letters they stand for.
_ALIKE = bytes.maketrans(b"013457@$!|", b"oieastasil")
_WORD = np.zeros(256, bool)
_WORD[np.r_[48:58, 65:91, 97:123, 128:256]] = True
_CLASSES = {
    "upper": list(range(65, 91)),
    "letter": [*range(65, 91), *range(97, 123), *range(192, 248)],  # one byte of each two-byte letter
    "marks": list(b"!?"),
    "symbols": list(b"#*$%&|<>@^~"),
    "digits": list(range(48, 58)),
}


def _hashes(words: list[str]) -> np.ndarray:
    return np.sort(hashed_words(pa.array(words))[1])


def _replaced(column: pa.Array) -> pa.Array:
    """The texts with look-alike characters undone."""
    whole = column.cast(pa.large_string())
    data = whole.buffers()[2]
    undone = pa.py_buffer((data.to_pybytes() if data else b"").translate(_ALIKE))
    return pa.Array.from_buffers(pa.large_string(), len(whole), [None, whole.buffers()[1], undone], 0, whole.offset)


def _per_row(hit: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(row[hit], minlength=n).astype(np.float64)


def odds_of(units: list[np.ndarray], names: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """For each word the largest log odds of its units (the word, its beginnings); 0 for unknown ones."""
    best = np.zeros(len(units[0]))
    if len(names):
        for unit in units:
            at = np.minimum(np.searchsorted(names, unit), len(names) - 1)
            best = np.maximum(best, np.where(names[at] == unit, odds[at], 0.0))
    return best


def features_of(column: pa.Array, lexicon: np.ndarray, second: np.ndarray, learned: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """rows x FEATURES."""
    column = pc.fill_null(column, "")
    n = len(column)
    row, word, *heads = hashed_words(column, prefixes=PREFIXES)
    odds = odds_of([word, *heads], *learned)
    strong = odds >= STRONG
    words = np.bincount(row, minlength=n).astype(np.float64)
    per_word = 1.0 / np.maximum(words, 1)
    bad, you = np.isin(word, lexicon), np.isin(word, second)
    # nearest second person on either side, within the row
    near = np.zeros(len(word), bool)
    at = np.flatnonzero(bad | strong)
    for d in range(1, NEAR + 1):
        for other in (at - d, at + d):
            ok = (other >= 0) & (other < len(word))
            near[at[ok]] |= you[other[ok]] & (row[other[ok]] == row[at[ok]])
    lrow, loose = hashed_words(_replaced(column), word_bytes=_WORD)
    lexicon_hits = _per_row(bad, row, n)
    disguised = np.maximum(_per_row(np.isin(loose, lexicon), lrow, n) - lexicon_hits, 0)

    whole = column.cast(pa.large_string())
    offsets = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + n + 1]
    raw = whole.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw else np.zeros(0, np.uint8)
    cuts = offsets - offsets[0]
    counts = {}
    for name, members in _CLASSES.items():
        table = np.zeros(256, np.int64)
        table[members] = 1
        running = np.append(0, np.cumsum(table[data]))
        counts[name] = (running[cuts[1:]] - running[cuts[:-1]]).astype(np.float64)
    chars = np.maximum(cuts[1:] - cuts[:-1], 1)
    upper = np.zeros(256, bool)
    upper[65:91] = True
    urow, _ = hashed_words(column, lower=False, word_bytes=upper)
    return np.stack(
        [
            lexicon_hits * per_word,
            np.log1p(lexicon_hits),
            np.log1p(disguised),
            np.bincount(row, odds, n) * per_word,
            np.log1p(np.bincount(row, odds, n)),
            np.log1p(_per_row(strong, row, n)),
            _per_row(you, row, n) * per_word,
            np.log1p(_per_row(near, row, n)),
            counts["upper"] / np.maximum(counts["letter"], 1),
            counts["upper"] / np.maximum(np.bincount(urow, minlength=n), 1),
            counts["marks"] / chars,
            counts["symbols"] / chars,
            counts["digits"] / chars,
            np.log1p(words),
        ],
        axis=1,
    )


def features(docs: DataFrame, learned: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, one column per feature, and ``carried`` if ``docs`` is that struct of whole rows (doc_id, text, more)."""
    carried = ["carried"] if "carried" in docs.columns else []
    source = "carried" if carried else "text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, second = _hashes(LEXICON), _hashes(SECOND_PERSON)
        for batch in slices(batches, source):
            got = features_of(field(batch, source, "text"), lexicon, second, learned)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": field(batch, carried[0] if carried else "doc_id", "doc_id")}
                | {c: batch.column(c) for c in carried}
                | {f: pa.array(got[:, k]) for k, f in enumerate(FEATURES)}
            )

    names = ["carried.doc_id", "carried"] if carried else ["doc_id"]
    schema = docs.select(*names).schema
    for f in FEATURES:
        schema = schema.add(f, "double")
    return docs.mapInArrow(run, schema)


def fold(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS, F.lit(0)).cast("int")


def sample(labels: DataFrame) -> DataFrame:
    """doc_id, label, fold, weight: at most SAMPLE rows of each class, none of fold 0."""
    truth = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("double").alias("label"))
    truth = truth.withColumn("fold", fold()).where("fold <> 0")
    sizes = {r["label"]: r["n"] for r in truth.groupBy("label").agg(F.count("*").alias("n")).where("label in (0, 1)").collect()}
    parts = [
        truth.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).withColumn("weight", F.lit(max(1.0, n / SAMPLE)))
        for k, n in sorted(sizes.items())
    ]
    whole = parts[0] if parts else truth.withColumn("weight", F.lit(1.0))
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def learned_lexicon(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(unit hashes, log odds) from ``texts`` (text, label, weight), sorted by hash.

    Counts are of texts; each task sums up its own before they are shuffled. What reaches the
    driver are units of at least LEAST_TEXTS texts of the sample: at most a LEAST_TEXTS-th of its words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            row, *units = hashed_words(batch.column("text"), prefixes=PREFIXES)
            label, weight = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "weight"))
            pairs = np.unique(np.concatenate([np.stack([row.astype(np.uint64), u])[:, u != 0] for u in units], axis=1), axis=1)
            names, at = np.unique(pairs[1], return_inverse=True)
            owner = pairs[0].astype(np.int64)
            toxic = np.bincount(at, label[owner] == 1, len(names))
            clean = np.bincount(at, np.where(label[owner] == 1, 0, weight[owner]), len(names))
            yield pa.RecordBatch.from_pydict(
                {"unit": pa.array(names.view(np.int64)), "toxic": pa.array(toxic.astype(np.float64)), "clean": pa.array(clean.astype(np.float64))}
            )

    totals = texts.groupBy("label").agg(F.sum("weight").alias("w"), F.count("*").alias("n")).collect()
    n_toxic = sum(r["n"] for r in totals if r["label"] == 1)
    n_clean = sum(r["w"] for r in totals if r["label"] == 0)
    counted = texts.select("text", "label", "weight").mapInArrow(run, "unit long, toxic double, clean double")
    counted = counted.groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(F.col("toxic") >= LEAST_TEXTS)
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (n_clean + 1.0))
    rows = counted.select("unit", odds.alias("odds")).where(F.col("odds") >= LEAST_ODDS).collect()
    names = np.array([r["unit"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(names)
    return names[order], np.array([r["odds"] for r in rows])[order]


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, features, fold and score of every row of ``docs`` (doc_id, text), learned from ``labels`` (doc_id, toxic)."""
    # bounded by 2 x SAMPLE rows, so it may be broadcast
    chosen = stored(sample(labels), "toxic-sample")
    plain = docs.select("carried.doc_id", "carried.text") if "carried" in docs.columns else docs
    known = stored(plain.join(F.broadcast(chosen), "doc_id"), "toxic-known")
    learned = learned_lexicon(known.where("fold in (2, 3)"))
    measured = features(docs, learned)
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="vector", handleInvalid="keep")
    vectors = assembler.transform(measured.withColumn("fold", fold()))
    fit = features(known.where("fold in (1, 4)"), learned).join(F.broadcast(chosen), "doc_id")
    fit = stored(assembler.transform(fit).select("fold", "vector", "label", "weight"), "toxic-fit")
    seen = {(r["fold"] == 1, r["label"]): (r["n"], r["w"]) for r in fit.groupBy("fold", "label").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()}
    if not all((False, k) in seen for k in (0.0, 1.0)):
        total = sum(w for _, w in seen.values())
        share = sum(w for (_, k), (_, w) in seen.items() if k == 1) / total if total else 0.0
        return vectors.withColumn("score", F.lit(share)).drop("vector")
    model = (
        GBTClassifier(
            labelCol="label", featuresCol="vector", predictionCol="guess", weightCol="weight",
            maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, minInstancesPerNode=5, maxMemoryInMB=64, seed=SEED,
        )
        .setRawPredictionCol("raw")
        .setProbabilityCol("chance")
        .fit(fit.where("fold = 4"))
    )
    if not all((True, k) in seen for k in (0.0, 1.0)):
        return model.transform(vectors).withColumn("score", vector_to_array("chance")[1]).drop("raw", "chance", "guess", "vector")

    def margins(df: DataFrame) -> DataFrame:
        return model.transform(df).withColumn("margin", vector_to_array("raw")[1]).drop("raw", "chance", "guess")

    bins = (
        margins(fit.where("fold = 1"))
        .groupBy((F.floor(F.col("margin") / BIN) * BIN + BIN / 2).alias("margin"))
        .agg((F.sum(F.col("label") * F.col("weight")) / F.sum("weight")).alias("label"), F.sum("weight").alias("weight"))
    )
    # a few hundred rows: margins lie within a few units of 0
    steps = IsotonicRegression(featuresCol="margin", labelCol="label", weightCol="weight", predictionCol="score").fit(stored(bins, "toxic-bins"))
    judged = steps.transform(margins(vectors))
    return judged.withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score")))).drop("margin", "vector")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted, and the features."""
    return scored(columns(docs, "doc_id", "text"), columns(labels, "doc_id", "toxic")).select(
        "doc_id", (F.col("fold") == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), *FEATURES
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` (any columns, among them doc_id and text) that aren't predicted toxic; texts aren't shuffled."""
    return scored(docs.select(F.struct("*").alias("carried")), columns(labels, "doc_id", "toxic")).where("score < 0.5").select("carried.*")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES = {"op7_toxicity": op7_toxicity}
