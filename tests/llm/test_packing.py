import zlib

import numpy as np

from sitewatts.llm import packing as pk
from sitewatts.llm import vocab
from tests.llm import helpers as h


def check(rows, pieces, window):
    """Every id lies in one piece, sequences have no gaps, only one is short."""
    library = vocab.library(vocab.path(pk.VOCABULARY))
    want = []
    for i, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, pk.END_ID]
        want.append((i, np.array(ids, "<u4")))
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for i, ids in want:
        own = sorted((p.start, p.length, p.ids_crc32) for p in by_doc[i] if p.doc_tokens == len(ids))
        copies = sum(1 for j, x in want if j == i and len(x) == len(ids))
        for start, length, crc in own:
            options = {zlib.crc32(x[start : start + length].tobytes()) for j, x in want if j == i and len(x) == len(ids)}
            assert crc in options
        assert sum(x[1] for x in own) == copies * len(ids)
    sizes = []
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        sizes.append(at)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    assert max(sizes, default=0) <= window and sum(s < window for s in sizes) <= 1
    assert sum(sizes) == sum(len(x) for _, x in want)


def test_whole_table_packs_without_gaps(spark):
    docs = h.documents()
    check(list(zip(docs.doc_id, docs.text, strict=True)), pk.op3_packing(spark, h.SF).collect(), pk.WINDOW)


def test_small_window_and_odd_rows(spark, extra):
    rows = h.odd_rows()
    check(rows, pk.pack(extra(h.frame(spark, rows).repartition(3)), window=64).collect(), 64)
    assert pk.pack(h.frame(spark, [])).count() == 0


def test_least_squares_uses_up_a_histogram_that_combines():
    window = 48
    rng = np.random.default_rng(1)
    histogram = np.zeros(window, np.int64)
    for _ in range(3000):
        a = rng.integers(1, window)
        histogram[a] += 1
        histogram[window - a] += 1
    combos = pk.combinations(window, histogram > 0)
    assert (combos.sum(axis=1) == window).all()
    counts = pk.repeats(combos, histogram)
    used = np.zeros(window, np.int64)
    for combo, count in zip(combos, counts, strict=True):
        for length in combo[combo > 0]:
            used[length] += count
    assert (used <= histogram).all() and used.sum() >= 0.98 * histogram.sum()
    for length, lo, hi, _, _ in pk.slots(combos, counts):
        assert 0 <= lo < hi <= used[length]
