"""Public tokenizer files: loading, and encoders whose ids equal those of the tokenizers library."""

from __future__ import annotations

import functools
import itertools
import json
import re
import struct
import unicodedata

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

#: Up to here the character classes of all regular expression engines agree (tested code point by code point).
PLAIN_END = 0x24F
BEYOND_PLAIN = re.compile(f"[^\x00-{chr(PLAIN_END)}]")


def path(name: str) -> str:
    return public_tokenizers.path(name)


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


def plain_class(*categories: str) -> str:
    """The characters of general categories, up to PLAIN_END, as the inside of a [...] class."""
    return "".join(
        re.escape(chr(c)) for c in range(PLAIN_END + 1) if unicodedata.category(chr(c)).startswith(categories)
    )


@functools.cache
def library(file: str) -> Tokenizer:
    return Tokenizer.from_file(file)


def definition(file: str) -> dict:
    """The file's contents; not remembered, as they take tens of MB."""
    with open(file, encoding="utf-8") as f:
        return json.load(f)


@functools.cache
def special_tokens(file: str) -> dict[str, int]:
    return {t["content"]: t["id"] for t in definition(file)["added_tokens"]}


@functools.cache
def _ranked(file: str) -> tiktoken.Encoding | None:
    """The same byte-level BPE as merge ranks; None if the file isn't of that kind or ranks could differ from pairs."""
    spec = definition(file)
    model, alphabet = spec["model"], byte_alphabet()
    if spec["normalizer"] or spec["pre_tokenizer"].get("type") != "ByteLevel" or model.get("end_of_word_suffix"):
        return None
    specials = special_tokens(file)
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    order = [model["vocab"][a + b] for a, b in merges]
    if order != sorted(order) or not _reproduce_themselves(model, specials):
        return None
    ranks = {bytes(alphabet[c] for c in t): i for t, i in model["vocab"].items() if t not in specials}
    return tiktoken.Encoding(file, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode_bytes(file: str, texts: list[str]) -> list[list[int]]:
    """Ids of texts under a byte-level vocabulary, without added special tokens.

    Texts of plain characters without special strings are merged by rank,
    which is several times faster; the others go to the tokenizers library.
    """
    ranked, specials = _ranked(file), list(special_tokens(file))
    if ranked is None:
        return [e.ids for e in library(file).encode_batch_fast(texts, add_special_tokens=False)]
    out = []
    for text in texts:
        if BEYOND_PLAIN.search(text) or any(s in text for s in specials):
            out.append(library(file).encode(text, add_special_tokens=False).ids)
        else:
            out.append(ranked.encode_ordinary(text))
    return out


def _reproduce_themselves(model: dict, specials: dict[str, int]) -> bool:
    """Whether merging the symbols of each token, earliest merge first, gives that token again.

    Then merging by the rank of joined strings, as rank-based encoders do, never
    differs from merging by the list of pairs.
    """
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    rank = {(a, b): k for k, (a, b) in enumerate(merges)}
    suffix = model.get("end_of_word_suffix") or ""
    for token in model["vocab"]:
        if token in specials:
            continue
        ends = bool(suffix) and token.endswith(suffix) and len(token) > len(suffix)
        parts = list(token[: -len(suffix)] if ends else token)
        if ends:
            parts[-1] += suffix
        while len(parts) > 1:
            pairs = [rank.get(p, 1 << 40) for p in itertools.pairwise(parts)]
            best = min(pairs)
            if best == 1 << 40:
                return False
            k = pairs.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
    return True


class WordIds:
    """Ids under a lower-casing vocabulary of words, remembered word by word.

    For texts of plain characters: lower-cased words between blanks are looked up;
    a new one is split by the vocabulary's rule (letters, single digits, runs of
    others, contractions) and its pieces are merged by rank, the end of a word being a
    byte that no UTF-8 text has. ``limit`` bounds the memory; later words are encoded
    each time. Other texts, and files of another kind, go to the tokenizers library.
    ids are little-endian 32-bit bytes.
    """

    END = b"\xff"
    #: What the library's rules may see differently: blanks and controls beyond ASCII's, a dotted
    #: capital I, and everything from where lower case may leave the plain range.
    ODD = re.compile("[\x1c-\x1f\x85\xa0\u0130\u0180-\U0010ffff]")
    #: The splitting rule that this class follows. Fixed value.
    RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, file: str, limit: int = 300_000):
        self.library, self.limit, self.seen = library(file), limit, {}
        self.parts: dict[str, bytes] = {}
        spec, specials = definition(file), special_tokens(file)
        self.specials = list(specials)
        model, suffix = spec["model"], spec["model"].get("end_of_word_suffix")
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        rules = [p.get("pattern", {}).get("Regex") for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.ranked = None
        if kinds == ["NFC", "Replace", "Lowercase"] and rules == [self.RULE, None] and suffix and _reproduce_themselves(model, specials):
            alphabet = byte_alphabet()
            ranks = {}
            for token, i in model["vocab"].items():
                if token not in specials:
                    ends = token.endswith(suffix) and len(token) > len(suffix)
                    ranks[bytes(alphabet[c] for c in (token[: -len(suffix)] if ends else token)) + (self.END if ends else b"")] = i
            self.ranked = tiktoken.Encoding(file, pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        letter, number = plain_class("L"), plain_class("N")
        self.split = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^\s{letter}{number}]+")

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        got = b""
        for part in self.split.findall(word):
            ids = self.parts.get(part)
            if ids is None:
                raw = self.ranked._core_bpe.encode_single_piece(part.encode() + self.END)
                ids = struct.pack(f"<{len(raw)}I", *raw)
                if len(self.parts) < self.limit // 2 and len(part) < 64:
                    self.parts[part] = ids
            got += ids
        return got

    def encode(self, texts: list[str]) -> list[bytes]:
        out, seen = [], self.seen
        for text in texts:
            if self.ranked is None or self.ODD.search(text) or any(s in text for s in self.specials):
                out.append(self._whole(text))
                continue
            words = text.lower().split()
            found = list(map(seen.get, words))
            if None in found:
                for k, ids in enumerate(found):
                    if ids is None:
                        found[k] = ids = self._word(words[k])
                        if len(seen) < self.limit and len(words[k]) < 64:
                            seen[words[k]] = ids
            out.append(b"".join(found))
        return out


@functools.cache
def word_ids(file: str) -> WordIds:
    """One per Python worker: it lives as long as the worker does."""
    return WordIds(file)
