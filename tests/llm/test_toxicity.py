import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sitewatts.llm import toxicity as tx
from tests.llm import helpers as h

NONE = (np.zeros(0, np.uint64), np.zeros(0))


def feature(texts, name):
    got = tx.features_of(pa.array(texts, pa.string()), tx._hashes(tx.LEXICON), tx._hashes(tx.SECOND_PERSON), NONE)
    return got[:, tx.FEATURES.index(name)].tolist()


def test_features():
    texts = ["You are an Idiot!", "an 1d10t and a m0ron", "idiot " + "x " * 9 + "you", None, "", "HELLO you #$%", "Él es 12"]
    assert feature(texts, "lexicon") == [0.25, 0, 1 / 11, 0, 0, 0, 0]
    assert np.allclose(feature(texts, "disguised"), np.log1p([0, 2, 0, 0, 0, 0, 0]))
    assert np.allclose(feature(texts, "addressed"), np.log1p([1, 0, 0, 0, 0, 0, 0]))
    assert np.allclose(feature(texts, "second"), [0.25, 0, 1 / 11, 0, 0, 0.5, 0])
    assert np.allclose(feature(texts, "marks"), [1 / 17, 0, 0, 0, 0, 0, 0])
    assert np.allclose(feature(texts, "symbols")[5], 3 / 13)
    assert feature(texts, "length")[3] == feature(texts, "length")[4] == 0


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("an", "ber", "lo", "mi", "ter", "os") for b in ("da", "no", "ri", "sel", "tum")]
    slurs = [f"grok{b}" for b in ("da", "no", "ri", "sel", "tum")]  # unknown to the given lexicon
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.2
        text = [rng.choice(words) for _ in range(rng.randrange(30, 120))]
        if toxic:
            for _ in range(rng.randrange(2, 6)):
                text[rng.randrange(len(text))] = rng.choice(slurs if i % 2 else tx.LEXICON)
        rows.append((i, " ".join(text)))
        if i % 4:
            labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_calibration(spark):
    rows, labels = corpus(3000, 1)
    truth = dict(labels)
    out = tx.toxicity(h.frame(spark, rows), h.frame(spark, labels, "doc_id long, toxic int")).collect()
    assert len(out) == len(rows)
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) >= 0.97
    assert abs(np.mean([r.score for r in held]) - np.mean([truth[r.doc_id] for r in held])) < 0.05
    again = tx.toxicity(h.frame(spark, rows), h.frame(spark, labels, "doc_id long, toxic int")).collect()
    assert {r.doc_id: r.score for r in out} == {r.doc_id: r.score for r in again}


def test_held_out_labels_are_never_learned_from(spark):
    rows, labels = corpus(400, 3)
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels]
    docs = h.frame(spark, rows)
    one, two = ({r.doc_id: r.score for r in tx.toxicity(docs, h.frame(spark, x, "doc_id long, toxic int")).collect()} for x in (labels, flipped))
    assert one == two


def test_documents_table_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    out = tx.op7_toxicity(spark, sf).collect()
    held = [r for r in out if r.held_out and r.doc_id in labels]
    clean = [r for r in held if labels[r.doc_id] == 0]
    assert len(out) == len(h.documents(sf)) and np.mean([r.predicted for r in clean]) <= 0.05
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) >= 0.9


def test_odd_rows(spark, extra):
    docs = extra(h.frame(spark, h.odd_rows()))
    labels = h.frame(spark, [(3, 1), (3, 0), (4, None), (None, 1), (8, 0)], "doc_id long, toxic int")
    out = tx.toxicity(docs, extra(labels)).collect()
    assert len(out) == len(h.odd_rows()) and len({r.score for r in out}) == 1
    none = tx.toxicity(docs, labels.where("false")).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)} and [r for r in none if r.doc_id is None][0].held_out
    assert tx.toxicity(docs.where("false"), labels).count() == 0
    kept = tx.without_toxic(docs, labels.where("false"))
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_sample_is_bounded_and_weighted(spark, monkeypatch):
    monkeypatch.setattr(tx, "SAMPLE", 20)
    labels = spark.range(1000).select(F.col("id").alias("doc_id"), (F.col("id") % 10 == 0).cast("int").alias("toxic"))
    got = tx.sample(labels).groupBy("label").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()
    sizes = {k: sum(1 for i in range(1000) if (i % 10 == 0) == bool(k) and zlib.crc32(str(i).encode()) % 5) for k in (0, 1)}
    assert {r.label: (r.n, round(r.w)) for r in got} == {float(k): (20, n) for k, n in sizes.items()}
