import math
import re
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from sitewatts.llm import fertility as fe
from sitewatts.llm import vocab
from tests.llm import helpers as h


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = [False] * len(words)
    for k in range(len(words) - 7):
        if windows[tuple(words[k : k + 8])] > 1:
            covered[k : k + 8] = [True] * 8
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = sum(covered)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, n, len(words) < 20 or 100 * n > 30 * len(words))


def base_of(row):
    return (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed)


def test_base_measures_and_tokens_match_brute_force(spark):
    docs = dict(zip(*h.documents()[["doc_id", "text"]].to_numpy().T, strict=True))
    pieces = sentencepiece.SentencePieceProcessor(model_file=vocab.path(fe.PIECES))
    library = Tokenizer.from_file(vocab.path(fe.BYTES))
    rows = fe.op1_fertility(spark, h.SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        text = docs[r.doc_id]
        assert base_of(r) == base(text)
        ids = pieces.encode(text)
        assert r.piece_chars == pytest.approx(r.word_chars / max(1, len(ids)))
        assert r.fallback_share == pytest.approx(sum(pieces.is_byte(i) for i in ids) / max(1, len(ids)))
        assert r.byte_chars == pytest.approx(r.word_chars / max(1, len(library.encode(text, add_special_tokens=False).ids)))
        assert r.kept == (not r.base_failed and r.failed_measures == "")


def test_symbol_junk_leaves_the_bands_and_clean_texts_stay(spark):
    docs = h.documents("/root/testdata/sf0.01")
    clean = docs[docs.lang == "en"].text.iloc[:200].tolist()
    junk = [" ".join(f"{w}#$%"[:4] + "&&&" for w in t.split()[:60]) for t in clean[:10]]
    rows = [(k, t) for k, t in enumerate(clean)] + [(1000 + k, t) for k, t in enumerate(junk)]
    got = {r.doc_id: r for r in fe.fertility(h.frame(spark, rows), language=None).collect()}
    passed = [r for k, r in got.items() if k < 1000 and not r.base_failed]
    assert sum(r.kept for r in passed) >= 0.93 * len(passed)
    assert not any(got[1000 + k].kept for k in range(10))


def brute_verdicts(rows):
    """Which measures leave their band, by the docstring, from rows of measures: {doc_id: failed measures}."""

    def quartiles(values):
        values = sorted(values)
        return [values[max(0, math.ceil(q * len(values)) - 1)] for q in (0.25, 0.5, 0.75)]

    good = [r for r in rows if not r["base_failed"]]
    limits = {}
    for m, (below, above, least) in fe.BANDS.items():

        def level(of, up, apart, m=m, least=least):
            q = quartiles([r[m] for r in of])
            mid, spread = q[1], max(least, (q[2] - q[0]) / 1.349)
            w = len(of) / (len(of) + (fe.PRIOR if apart else fe.LENGTH_PRIOR))
            if up is None:
                return mid, spread
            mixed = math.sqrt(w * spread**2 + (1 - w) * up[1] ** 2 + w * (1 - w) * (mid - up[0]) ** 2)
            return w * mid + (1 - w) * up[0], mixed if apart else spread**w * up[1] ** (1 - w)

        whole = level(good, None, True)
        for grp in {r["grp"] for r in good}:
            mine = [r for r in good if r["grp"] == grp]
            language = level(mine, whole, True)
            for size in {r["size"] for r in mine}:
                mid, spread = level([r for r in mine if r["size"] == size], language, False)
                limits[grp, size, m] = (mid - below * spread if below else -math.inf, mid + above * spread if above else math.inf)
    out = {}
    for r in rows:
        band = lambda m, r=r: limits.get((r["grp"], r["size"], m), (-math.inf, math.inf))
        out[r["doc_id"]] = ",".join(m for m in fe.BANDS if not band(m)[0] <= r[m] <= band(m)[1])
    return out


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_bands_and_verdicts_match_brute_force(spark, sf):
    langs = dict(h.documents(sf)[["doc_id", "lang"]].itertuples(index=False))
    found = [r.asDict() for r in fe.op1_fertility(spark, sf).collect()]
    rows = [r | {"grp": langs[r["doc_id"]], "size": math.floor(2 * math.log2(max(1, r["n_words"])))} for r in found]
    want = brute_verdicts(rows)
    assert {r["doc_id"]: r["failed_measures"] for r in found} == want
    assert all(r["kept"] == (not r["base_failed"] and not want[r["doc_id"]]) for r in found)
    assert any(want.values())


def test_the_number_of_documents_of_a_language_switches_nothing(spark):
    """A language unlike all others keeps its documents, whether it has 5, 99 or 100."""
    docs = h.documents("/root/testdata/sf0.01")
    rows = [(k, t, "en") for k, t in enumerate(docs[docs.lang == "en"].text.iloc[:400])]
    other = ["".join(chr(0x4E00 + ord(c) * 7) if c.isalpha() else c for c in t) for t in docs[docs.lang == "de"].text]
    other = [t for t in other if len(t.split()) >= 20][:100]
    verdicts = {}
    for n in (5, 99, 100):
        mine = [(10_000 + k, t, "xx") for k, t in enumerate(other[:n])]
        got = fe.fertility(h.frame(spark, rows + mine, "doc_id long, text string, lang string")).where("doc_id >= 10000").collect()
        verdicts[n] = {r.doc_id: r.kept for r in got if not r.base_failed}
        assert sum(verdicts[n].values()) >= 0.9 * len(verdicts[n]) > 0
    assert verdicts[99] == {k: v for k, v in verdicts[100].items() if k in verdicts[99]}


def test_script():
    assert fe.script("abc") == "LATIN" and fe.script("и русский") == "CYRILLIC" and fe.script("日本語") == "CJK" and fe.script("12 !") == "NONE"


def test_odd_rows(spark, extra):
    rows = [(i, t, None) for i, t in h.odd_rows()]
    out = fe.fertility(extra(h.frame(spark, rows, "doc_id long, text string, lang string"))).collect()
    want = sorted((i if i is not None else -1, *base(t)) for i, t, _ in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, *base_of(r)) for r in out) == want
    assert fe.fertility(h.frame(spark, [], "doc_id long, text string, lang string")).count() == 0
