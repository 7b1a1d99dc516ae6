"""Exact token counts of every prefix of a text, by dynamic programming over byte-pair tokens.

Under byte-pair merging the last token of a prefix decides the rest: if token t
ends prefix i and begins at j, then the encoding of prefix i is that of prefix j
plus t, and t is the only token for which the pair (last token of prefix j, t)
stays as it is under merging. So one pass over a word gives the counts of all its
prefixes; words (the pieces that the vocabulary's splitting rule makes) are
remembered. Over a text the counts of finished words are added up, with the
places where cutting a text changes the splitting (blank runs, contractions,
special strings) put right.

With the counts, "how many tokens has this prefix", "what is the longest prefix
within a budget" and "where do chunks of n tokens end" are look-ups.

Prefixes are counted in code points. Null and empty texts have no tokens.
Repeated rows are counted each. An empty table gives an empty result. Very long
words cost time in proportion to their length times the length of tokens.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from sitewatts.llm import vocab
from sitewatts.llm.common import columns, read, slices, texts

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
#: Contractions that the splitting rule takes as words. Fixed values.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
#: White space as Unicode has it, up to the plain range. Fixed values.
BLANK = r"\t-\r \x85\xa0"


class PrefixCounter:
    """Counts for one byte-level vocabulary file. ``remember`` bounds each cache."""

    def __init__(self, file: str, remember: int = 800_000):
        spec = vocab.definition(file)
        alphabet = vocab.byte_alphabet()
        self.specials = sorted(vocab.special_tokens(file), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, self.specials))) if self.specials else None
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        raw = lambda t: bytes(alphabet[c] for c in t)
        self.rank = {(raw(a), raw(b)): k for k, (a, b) in enumerate(merges)}
        self.tokens = {raw(t) for t in spec["model"]["vocab"] if t not in vocab.special_tokens(file)}
        #: Token -> (rank, pair) of the merge that makes it.
        self.made = {a + b: (k, (a, b)) for (a, b), k in self.rank.items()}
        if len(self.made) != len(self.rank) or any(len(t) > 1 and t not in self.made for t in self.tokens):
            raise ValueError("each token of several bytes has to be made by one merge")
        if any(k <= self.made[t][0] for p, k in self.rank.items() for t in p if len(t) > 1):
            raise ValueError("a token has to be made before it's merged further")
        self.spines: tuple[dict, dict] = ({}, {})
        self.suffixes = {t[k:] for t in self.tokens for k in range(len(t))}
        if len({t for t in self.tokens if len(t) == 1}) < 256:
            raise ValueError("the vocabulary lacks single bytes")
        self.remember = remember
        self.words: dict[str, bytes] = {}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        letter, number = vocab.plain_class("L"), vocab.plain_class("N")
        rule = "{c}| ?[{l}]+| ?[{n}]+| ?[^{b}{l}{n}]+|[{b}]+(?![^{b}])|[{b}]+"
        self.plain = re.compile(rule.format(c="|".join(CONTRACTIONS), l=letter, n=number, b=BLANK))
        self.any = regex.compile(rule.format(c="|".join(CONTRACTIONS), l=r"\p{L}", n=r"\p{N}", b=r"\p{White_Space}"))
        self.runs = regex.compile(r"\p{White_Space}{2,}")

    def _spine(self, token: bytes, side: int) -> list[tuple[bytes, int, int]]:
        """The parts of a token that touch its left (0) or right (1) edge while it is
        merged together, each with the ranks between which it's there."""
        known = self.spines[side].get(token)
        if known is None:
            known, until = [], 1 << 40
            while len(token) > 1:
                rank, pair = self.made[token]
                known.append((token, rank, until))
                token, until = pair[side], rank
            known.append((token, -1, until))
            self.spines[side][known[0][0]] = known
        return known

    def _stays(self, left: bytes, right: bytes) -> bool:
        """Whether merging keeps the two tokens apart.

        Merges run in the order of ranks, leftmost first. They join across the
        border if a part at the right edge of ``left`` and one at the left edge
        of ``right`` are a pair whose rank comes while both are there.
        """
        known = True
        for x, x_from, x_until in self._spine(left, 1):
            for y, y_from, y_until in self._spine(right, 0):
                rank = self.rank.get((x, y))
                if rank is not None and x_from < rank < x_until and y_from < rank <= y_until:
                    known = False
        if len(self.pairs) < self.remember:
            self.pairs[left, right] = known
        return known

    def word(self, word: str) -> bytes:
        """Counts of the word's prefixes of 1, 2, ... code points, as 32-bit integers."""
        data = word.encode()
        last: list[bytes] = [b""]
        count = [0]
        tokens, suffixes, pairs = self.tokens, self.suffixes, self.pairs
        for i in range(1, len(data) + 1):
            j = i - 1
            while j >= 0 and data[j:i] in suffixes:
                j -= 1
            for j in range(j + 1, i):  # noqa: PLR1704
                token = data[j:i]
                if token not in tokens:
                    continue
                if j:
                    stays = pairs.get((last[j], token))
                    if stays is None:
                        stays = self._stays(last[j], token)
                    if not stays:
                        continue
                last.append(token)
                count.append(count[j] + 1)
                break
        if len(data) == len(word):
            ends = count[1:]
        else:
            ends = [count[k] for k in range(1, len(data) + 1) if k == len(data) or data[k] & 0xC0 != 0x80]
        if word in CONTRACTIONS and len(word) == 3:
            ends[1] = 2  # cut short, the quote and the letter are words of their own
        return np.array(ends, "<i4").tobytes()

    def _plain_text(self, text: str) -> np.ndarray:
        """Counts of a text's prefixes, special strings taken as ordinary text."""
        words = (self.any if vocab.BEYOND_PLAIN.search(text) else self.plain).findall(text)
        seen = self.words
        found = []
        for w in words:
            got = seen.get(w)
            if got is None:
                got = self.word(w)
                if len(seen) < self.remember and len(w) < 64:
                    seen[w] = got
            found.append(got)
        inside = np.frombuffer(b"".join(found), "<i4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ends = np.cumsum(sizes)
        before = np.zeros(len(words), np.int64)
        before[1:] = np.cumsum(inside[ends[:-1] - 1])
        counts = np.repeat(before, sizes) + inside
        for run in self.runs.finditer(text):
            # cut inside or right after a run of blanks, the whole run up to there is one word
            a, b = run.span()
            base = int(counts[a - 1]) if a else 0
            counts[a:b] = base + np.frombuffer(self.word(text[a:b]), "<i4")
        return counts

    def text(self, text: str) -> np.ndarray:
        """Token counts of the prefixes of 1, 2, ..., len(text) code points."""
        if not text:
            return np.zeros(0, np.int64)
        if self.special is None or not self.special.search(text):
            return self._plain_text(text)
        out, base, at = [], 0, 0
        for m in self.special.finditer(text):
            head = text[at : m.start()]
            # up to the last character of the special string it's still ordinary text
            out.append(base + self._plain_text(head + m[0][:-1]) if head or len(m[0]) > 1 else np.zeros(0, np.int64))
            if head:
                base += int(self._plain_text(head)[-1])
            base += 1
            out.append(np.array([base]))
            at = m.end()
        if at < len(text):
            out.append(base + self._plain_text(text[at:]))
        return np.concatenate(out)


@functools.cache
def counter(file: str) -> PrefixCounter:
    return PrefixCounter(file)


def longest_prefix(counts: np.ndarray, budget: int) -> int:
    """Code points of the longest prefix that has at most ``budget`` tokens."""
    fits = np.flatnonzero(counts <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def prefix_counts(docs: DataFrame, file: str | None = None, budget: int = LIMIT, keep_counts: bool = True) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text).

    doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > budget), fit_chars
    (code points of the longest prefix within the budget), and with
    ``keep_counts`` prefix_tokens: the count of every prefix.
    """
    file = file or vocab.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(file)
        for batch in slices(batches):
            found, rows = [], texts(batch)
            n_tokens, fit = [], []
            for text in rows:
                counts = count.text(text)
                n_tokens.append(int(counts[-1]) if len(counts) else 0)
                fit.append(longest_prefix(counts, budget))
                if keep_counts:
                    found.append(counts.astype(np.int32))
            out = {
                "doc_id": batch.column("doc_id"),
                "n_bytes": pa.array([len(t.encode()) for t in rows], pa.int64()),
                "n_tokens": pa.array(n_tokens, pa.int64()),
                "over_limit": pa.array([n > budget for n in n_tokens], pa.bool_()),
                "fit_chars": pa.array(fit, pa.int64()),
            }
            yield pa.RecordBatch.from_pydict(out | ({"prefix_tokens": pa.array(found, pa.list_(pa.int32()))} if keep_counts else {}))

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long"
    return columns(docs, "doc_id", "text").mapInArrow(run, schema + (", prefix_tokens array<int>" if keep_counts else ""))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_counts(read(spark, sf_dir, "documents"), keep_counts=False)


QUERIES = {"op10_token_counts": op10_token_counts}
