import zlib
from itertools import product

import numpy as np
import pytest

from sitewatts.llm import huffman as hf
from sitewatts.llm import vocab
from tests.llm import helpers as h


def want(rows):
    library = vocab.library(vocab.path(hf.VOCABULARY))
    start, out = 0, []
    for i, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, hf.END_ID]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_whole_table_round_trip(spark):
    docs = h.documents().sort_values("doc_id")
    rows = list(zip(docs.doc_id, docs.text, strict=True))
    got = sorted(tuple(r) for r in hf.op6_huffman_ids(spark, h.SF).collect())
    assert got == want(rows)


def test_word_encoder_equals_the_library_on_every_plain_character():
    file = vocab.path(hf.VOCABULARY)
    library, words = vocab.library(file), vocab.word_ids(file)
    assert words.ranked is not None
    texts = ["a{0}b {0} {0}{0} 1{0}2 '{0}s I'LL{0} ".format(chr(c)) for c in range(0x300)]
    texts += ["x<|endoftext|>y <|startoftext|>", "ΟΔΟΣ Σ", "日本 語", "é É", "a\x0bb\x0cc", "", "  "]
    texts += h.documents().text.tolist()
    for text, raw in zip(texts, words.encode(texts), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_byte_encoder_equals_the_library():
    file = vocab.path("byte_bpe_50k.json")
    texts = ["a{0}b {0} {0}{0} 1{0}2 '{0}s".format(chr(c)) for c in range(0x300)] + [t or "" for t in h.ODD_TEXTS] + h.documents().text.tolist()
    for text, ids in zip(texts, vocab.encode_bytes(file, texts), strict=True):
        assert ids == vocab.library(file).encode(text, add_special_tokens=False).ids


def kraft(lengths):
    return sum(2.0 ** -int(n) for n in lengths if n)


@pytest.mark.parametrize("limit", [3, 4, 8])
def test_lengths_are_the_best_within_the_limit(limit):
    rng = np.random.default_rng(limit)
    for _ in range(6):
        counts = rng.integers(1, 60, 6) ** 2
        got = hf.code_lengths(counts, limit)
        best = min(sum(n * c for n, c in zip(ns, counts, strict=True)) for ns in product(range(1, limit + 1), repeat=6) if kraft(ns) <= 1) if limit <= 4 else None
        assert got.max() <= limit and kraft(got) <= 1
        assert best is None or (got * counts).sum() == best


def test_codes_are_canonical_and_decode_from_any_block():
    rng = np.random.default_rng(2)
    ids = rng.zipf(1.3, 40_000) % 5000
    counts = np.bincount(ids, minlength=5001)
    lengths = hf.code_lengths(counts)
    codes = hf.canonical(lengths)
    order = sorted((int(n), i) for i, n in enumerate(lengths) if n)
    texts = [format(codes[i], f"0{n}b") for n, i in order]
    assert texts == sorted(texts) and not any(b.startswith(a) for a, b in zip(texts, texts[1:], strict=False))
    parts = [ids[:1], ids[1:1000], ids[1000:1000], ids[1000:]]
    coded = [hf.encode(p, codes, lengths) for p in parts]
    table = hf.decoding_table(lengths, hf.MAX_BITS)
    got = hf.decode([c[0] for c in coded], [len(p) for p in parts], [c[2] for c in coded], table, hf.MAX_BITS)
    assert (got == ids).all()
    alone = hf.decode([coded[3][0]], [len(parts[3])], [coded[3][2]], table, hf.MAX_BITS)
    assert (alone == parts[3]).all()
    assert sum(c[1] for c in coded) < 0.8 * 16 * len(ids)


def test_one_or_no_symbol():
    assert hf.code_lengths(np.array([0, 5, 0])).tolist() == [0, 1, 0]
    assert hf.code_lengths(np.zeros(3, np.int64)).tolist() == [0, 0, 0]
    with pytest.raises(ValueError):
        hf.code_lengths(np.ones(9), 3)


def test_odd_rows(spark, extra, tmp_path):
    rows = [r for r in h.odd_rows()]
    hf.write_ids(extra(h.frame(spark, rows).repartition(3)), str(tmp_path / "f"))
    got = hf.read_ids(spark, str(tmp_path / "f")).collect()
    every = want(rows)
    # repeated ids and ties: starts are gapless, contents equal
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.ids_crc32) for r in got) == sorted((i if i is not None else -1, n, c) for i, _, n, c in every)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and len(r.ids) == r.n_tokens
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order[0] is None and order[1:] == sorted(order[1:])
    hf.write_ids(h.frame(spark, []), str(tmp_path / "empty"))
    assert hf.read_ids(spark, str(tmp_path / "empty")).count() == 0


@pytest.mark.parametrize("used", [60_000, 70_000, 200_000])
def test_more_ids_than_sixteen_bits_can_tell_apart(used):
    rng = np.random.default_rng(used)
    counts = np.zeros(used + 5, np.int64)
    counts[:used] = rng.integers(1, 1000, used)
    max_bits = hf.limit_for(counts)
    assert max_bits == (16 if used <= 1 << 16 else int(used - 1).bit_length())
    lengths = hf.code_lengths(counts, max_bits)
    assert lengths.max() <= max_bits and sum(2.0 ** -lengths[:used].astype(float)) <= 1.0
    ids = rng.permutation(np.repeat(np.arange(used), 2))
    payload, bits, points = hf.encode(ids, hf.canonical(lengths), lengths)
    assert bits == lengths[ids].sum()
    got = hf.decode([payload, payload], [len(ids)] * 2, [points, points], hf.decoding_table(lengths, max_bits), max_bits)
    assert (got == np.append(ids, ids)).all()
    with pytest.raises(ValueError):
        hf.code_lengths(np.ones(40, np.int64), 5)


def test_an_end_id_beyond_the_vocabulary(spark):
    folder = hf.scratch(spark, "huffman-test")
    hf.write_ids(h.frame(spark, [(1, "some words"), (2, None)]), folder, end_id=70_000)
    got = {r.doc_id: r.ids for r in hf.read_ids(spark, folder).collect()}
    assert got[2] == [70_000] and got[1][-1] == 70_000 and len(got[1]) == 3
