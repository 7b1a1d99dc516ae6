import random

import numpy as np

from sitewatts.llm import prefix_counts as pc
from sitewatts.llm import vocab
from tests.llm import helpers as h

FILE = vocab.path(pc.VOCABULARY)


def brute(text):
    library = vocab.library(FILE)
    return [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(1, len(text) + 1)]


def test_every_prefix_of_random_texts():
    rng = random.Random(1)
    pieces = [
        "hello", "  ", "\n", " ", "'s", "'ll", "'re", " 've", "x'", "!!", "123", " 4", "é", "ü'll", "ß", "<|endoftext|>", "<|endof", "日本", "語 ",
        "\t\t", " \n ", "the", "ation", "$$$", "а б", "'", "½²", "　", "😀", "\x1c", "\x85", "\xa0",
    ]
    count = pc.PrefixCounter(FILE)
    for _ in range(400):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 12)))
        assert count.text(text).tolist() == brute(text), repr(text)


def test_every_prefix_of_a_document():
    text = h.documents().text.iloc[0][:1500]
    assert pc.counter(FILE).text(text).tolist() == brute(text)


def test_whole_table(spark):
    docs = h.documents().set_index("doc_id").text
    library = vocab.library(FILE)
    rows = pc.op10_token_counts(spark, h.SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n = len(library.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 1024)
        cut = docs[r.doc_id][: r.fit_chars]
        assert len(library.encode(cut, add_special_tokens=False).ids) <= 1024 and (r.over_limit or cut == docs[r.doc_id])


def test_longest_prefix():
    assert pc.longest_prefix(np.array([1, 2, 1, 3, 2, 4]), 2) == 5 and pc.longest_prefix(np.array([], int), 2) == 0
    assert pc.longest_prefix(np.array([3]), 2) == 0


def test_odd_rows(spark, extra):
    library = vocab.library(FILE)
    rows = h.odd_rows()
    got = pc.prefix_counts(extra(h.frame(spark, rows)), budget=3).collect()
    key = lambda r: (r[0] if r[0] is not None else -1, *r[1:])
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    assert sorted(key((r.doc_id, r.n_bytes, r.n_tokens)) for r in got) == sorted(map(key, want))
    assert all(len(r.prefix_tokens) == 0 or r.prefix_tokens[-1] == r.n_tokens for r in got)
    assert pc.prefix_counts(h.frame(spark, [])).count() == 0
