"""Small inputs and brute-force versions used by the tests of the llm operators."""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def documents(sf: str = SF) -> pd.DataFrame:
    return pd.read_parquet(f"{sf}/documents.parquet")


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())


def shingle_counts(text: str | None, n: int = 5) -> Counter:
    w = words(text)
    if not w:
        return Counter()
    return Counter(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1)))


def similarities(a: Counter, b: Counter) -> tuple[float, float]:
    """(probability Jaccard by its definition, Jaccard)."""
    both = a.keys() & b.keys()
    keys = a.keys() | b.keys()
    if not both:
        return 0.0, 0.0
    p = sum(1 / sum(max(a[e] / a[d], b[e] / b[d]) for e in keys) for d in both)
    return p, len(both) / len(keys)


def classes(links, ids) -> dict:
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


#: Null, empty and blank texts, ties, repeated rows, special strings, other scripts, one very long text.
ODD_TEXTS = (
    None, "", " \n\t ", "a", "A a", "same words here", "same words here", "x" * 5000, "word " * 30_000, "<|endoftext|> in a text",
    "日本語のテキスト и русский", "é" * 300, "1234 5678", "...!!!", "\x0b\x0c\x1c odd blanks\x85\xa0", "it's we'LL they 're",
)


def odd_rows() -> list[tuple]:
    return [(k, t) for k, t in enumerate(ODD_TEXTS)] + [(5, "same words here"), (None, "no id")]
