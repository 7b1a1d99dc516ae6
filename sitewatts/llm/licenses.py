"""License scans by an exact set-similarity join of text blocks with license templates.

A block is a line of a text, or a run of lines that a notice may be wrapped over;
templates are notices, from a line to a whole license text. Both are sets of words.
A block is joined with a template if it holds at least THRESHOLD of the template's
words (containment). The join is exact:

* words of templates are ordered by how many blocks of the corpus have them, rarest
  first (ties by the word); the counts are over all blocks of all texts;
* prefix filter: with t words and at least m = ceil(THRESHOLD t) needed, a block has
  to hold one of the template's first t - m + 1 words in that order;
* length filter: a block of fewer than m different words is out;
* positional filter: if the first common word stands at place i of the template and
  place j of the block's template words, then at most
  1 + min(t - i - 1, k - j - 1) words can be common (k: the block's words that any
  template has);
* what is left is counted exactly.

A run is two or more lines in a row that have words (lines without are passed over).
Of its first line the last and of its last line the first words count, as many as the
longest template has, and no more than so many may stand between: a copy of a
template fits in, wherever it's wrapped. Of overlapping blocks that meet a template
the best counts (largest containment, then most words, fewest lines, the first), so
a notice is one block, and a run counts only if it's better than its lines.

Of the templates that a block meets it takes the label of the one it holds best
(largest containment, then most words; ties: all of them).

Templates are a parameter of bounded size and are sent to all tasks; texts are not
shuffled. Base phrases (contract) are counted beside it over whole texts.

Words are runs of ASCII letters and digits and of non-ASCII characters after A-Z
are lower-cased. Null texts are empty texts. Labels are sets, so ties and repeated
rows don't matter. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewatts.llm.common import columns, read, slices, texts

#: Phrases and their labels. Fixed values.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
THRESHOLD = 0.8
_WARRANTY = (
    "The software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of "
    "merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or copyright holders be liable "
    "for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection "
    "with the software or the use or other dealings in the software."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission. "
)
_BSD_WARRANTY = (
    "This software is provided by the copyright holders and contributors as is and any express or implied warranties, including, but not "
    "limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed. In no event shall the "
    "copyright holder or contributors be liable for any direct, indirect, incidental, special, exemplary, or consequential damages "
    "(including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits; or business interruption) "
    "however caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence or otherwise) "
    "arising in any way out of the use of this software, even if advised of the possibility of such damage."
)


def _gnu(thing: str, name: str, version: str) -> str:
    return (
        f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free "
        f"Software Foundation, either version {version} of the License, or (at your option) any later version. This {thing} is distributed in "
        f"the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a "
        f"particular purpose. See the GNU {name} for more details."
    )


#: Label -> notices as they stand in source files and pages: lines, headers and whole texts (public license texts). Fixed values.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
        "so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. " + _WARRANTY,
    ),
    "isc": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies. The software is provided as is and the author disclaims "
        "all warranties with regard to this software including all implied warranties of merchantability and fitness. In no event shall the "
        "author be liable for any special, direct, indirect, or consequential damages or any damages whatsoever resulting from loss of use, "
        "data or profits, whether in an action of contract, negligence or other tortious action, arising out of or in connection with the use "
        "or performance of this software.",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may "
        "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an as is basis, without warranties or conditions of any kind, either express "
        "or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        _gnu("program", "General Public License", "3"),
    ),
    "lgpl": ("Licensed under the GNU Lesser General Public License, version 3.", _gnu("library", "Lesser General Public License", "2.1")),
    "agpl": ("Licensed under the GNU Affero General Public License, version 3.", _gnu("program", "Affero General Public License", "3")),
    "bsd": (
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "bsd-2-clause": (_BSD + _BSD_WARRANTY,),
    "bsd-3-clause": (_BSD + _BSD_NAMES + _BSD_WARRANTY,),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "epl": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
        "https://www.eclipse.org/legal/epl-2.0/",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
        "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any "
        "means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in "
        "the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and "
        "successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this "
        "software under copyright law.",
    ),
    "zlib": (
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages "
        "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following restrictions",
    ),
    "boost": ("Distributed under the Boost Software License, Version 1.0.",),
    "cc-by": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",),
    "proprietary": ("All rights reserved. No part of this work may be reproduced without permission.",),
}

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.translate(_LOWER))


class Join:
    """The templates with their words in global order, ready to be joined with blocks."""

    def __init__(self, templates: dict[str, tuple[str, ...]], frequency: dict[str, int], threshold: float):
        every = {w for notices in templates.values() for t in notices for w in words_of(t)}
        order = sorted(every, key=lambda w: (frequency.get(w, 0), w))
        self.place = {w: k for k, w in enumerate(order)}
        self.templates: list[tuple[str, frozenset, list[int], int]] = []
        #: Word -> (template, place in it) for words of the prefixes.
        self.prefixes: dict[int, list[tuple[int, int]]] = {}
        for label, notices in templates.items():
            for notice in notices:
                ranks = sorted({self.place[w] for w in words_of(notice)})
                need = math.ceil(threshold * len(ranks) - 1e-9)
                for i, rank in enumerate(ranks[: len(ranks) - need + 1]):
                    self.prefixes.setdefault(rank, []).append((len(self.templates), i))
                self.templates.append((label, frozenset(ranks), ranks, need))
        self.prefix_words = [order[r] for r in self.prefixes]
        #: Words of the longest template, repeated ones too.
        self.longest = max((len(words_of(t)) for notices in templates.values() for t in notices), default=0)

    def match(self, block: set[str]) -> list[tuple[str, float, int]]:
        """(label, containment, common words) of every template that the block meets."""
        ranks = sorted(self.place[w] for w in block if w in self.place)
        out, seen = [], set()
        for j, rank in enumerate(ranks):
            for k, i in self.prefixes.get(rank, ()):
                if k in seen:
                    continue
                seen.add(k)
                label, members, places, need = self.templates[k]
                if len(block) < need or 1 + min(len(places) - i - 1, len(ranks) - j - 1) < need:
                    continue
                common = sum(r in members for r in ranks)
                if common >= need:
                    out.append((label, common / len(places), common))
        return out


def blocks(lines: list[list[str]], join: Join, prefix: frozenset[str]) -> list[list[tuple[str, float, int]]]:
    """What the lines and runs of lines that count meet, one list of matches for each."""
    lines = [line for line in lines if line]
    sets = [set(line) for line in lines]
    hot = [k for k, line in enumerate(sets) if not prefix.isdisjoint(line)]
    found = [(k, k, got) for k in hot if (got := join.match(sets[k]))]
    for first in _run_starts(lines, hot, join.longest):
        words, between, runs = set(lines[first][-join.longest :]), 0, []
        for last in range(first + 1, len(lines)):
            runs.append((last, words.union(lines[last][: join.longest])))
            between += len(lines[last])
            if between > join.longest:
                break
            words = words | sets[last]
        # a shorter run meets nothing if the longest one, which holds its words, meets nothing
        if runs and join.match(words.union(*(r for _, r in runs))):
            found += [(first, last, got) for last, run in runs if (got := join.match(run))]
    top = lambda got: max(g[1:] for g in got)
    found.sort(key=lambda x: (*(-v for v in top(x[2])), x[1] - x[0], x[0]))
    taken: set[int] = set()
    out = []
    for first, last, got in found:
        if taken.isdisjoint(range(first, last + 1)):
            taken.update(range(first, last + 1))
            out.append(got)
    return out


def _run_starts(lines: list[list[str]], hot: list[int], longest: int) -> list[int]:
    """First lines of the runs that can hold one of the lines ``hot``."""
    out: set[int] = set()
    for k in hot:
        out.add(k)
        between = 0
        for first in range(k - 1, -1, -1):
            if between > longest or first in out:
                break
            out.add(first)
            between += len(lines[first])
    return sorted(out)


def block_frequency(docs: DataFrame, vocabulary: frozenset[str]) -> DataFrame:
    """(word, blocks) for the given words over all blocks; each task sums up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in slices(batches):
            for text in texts(batch):
                for line in text.translate(_LOWER).split("\n"):
                    total.update(vocabulary.intersection(_WORD.findall(line)))
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})

    return docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("blocks"))


def scan(
    docs: DataFrame,
    templates: dict[str, tuple[str, ...]] | None = None,
    threshold: float = THRESHOLD,
    phrases: dict[str, str] | None = None,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text).

    doc_id, n_words, n_base, first_word, last_word, base_labels, labels (base and
    joined), score (the best containment, 1 where a phrase stands), n_blocks (blocks
    that count).
    """
    templates, phrases = TEMPLATES if templates is None else templates, PHRASES if phrases is None else phrases
    docs = columns(docs, "doc_id", "text")
    vocabulary = frozenset(w for notices in templates.values() for t in notices for w in words_of(t))
    frequency = {r["word"]: r["blocks"] for r in block_frequency(docs, vocabulary).collect()}  # the templates' words
    parts = [(tuple(words_of(p)), label) for p, label in phrases.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        join = Join(templates, frequency, threshold)
        starts = {p[0] for p, _ in parts}
        prefix = frozenset(join.prefix_words)
        for batch in slices(batches):
            out: dict[str, list] = {k: [] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_blocks")}
            for text in texts(batch):
                lines = [_WORD.findall(line) for line in text.translate(_LOWER).split("\n")]
                words = [w for line in lines for w in line]
                places, base = [], set()
                if not starts.isdisjoint(words):
                    for k, w in enumerate(words):
                        if w in starts:
                            for phrase, label in parts:
                                if tuple(words[k : k + len(phrase)]) == phrase:
                                    places.append(k)
                                    base.add(label)
                found, best, n_blocks = set(base), 1.0 if base else 0.0, 0
                if not prefix.isdisjoint(words):
                    for got in blocks(lines, join, prefix):
                        n_blocks += 1
                        top = max(g[1:] for g in got)
                        found.update(g[0] for g in got if g[1:] == top)
                        best = max(best, top[0])
                row = (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(found)), best, n_blocks)
                for name, value in zip(out, row, strict=True):
                    out[name].append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int64())
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id")} | {c: pa.array(v, t) for (c, v), t in zip(out.items(), kinds, strict=True)}
            )

    return docs.mapInArrow(
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, n_blocks long",
    )


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents"))


QUERIES = {"op5_licenses": op5_licenses}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SPLIT = f"regexp_extract_all({{}}, '{_WORD.pattern}')"


def _oracle() -> str:
    """The same in DuckDB: every line against every template, without filters."""
    templates = ", ".join(f"('{label}', {sorted(set(words_of(t)))})" for label, notices in TEMPLATES.items() for t in notices)
    at = {
        label: f"list_filter(range(len(w)), lambda i: {' AND '.join(f'w[i + {k + 1}] = {chr(39)}{x}{chr(39)}' for k, x in enumerate(words_of(p)))})"
        for p, label in PHRASES.items()
    }
    places = " || ".join(at.values())
    base = ", ".join(f"CASE WHEN len({x}) > 0 THEN '{label}' END" for label, x in at.items())
    return f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}') AS t FROM documents
),
b AS (
  SELECT doc_id, r, len(w) AS n_words, {places} AS places, list_filter([{base}], lambda x: x IS NOT NULL) AS base
  FROM (SELECT doc_id, r, {_SPLIT.format('t')} AS w FROM d)
),
templates(label, words) AS (VALUES {templates}),
lines AS (
  SELECT r, row_number() OVER () AS line, list_distinct({_SPLIT.format('x')}) AS words
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM d)
),
hits AS (
  SELECT r, line, label, len(list_intersect(l.words, s.words)) AS common, common / len(s.words) AS share
  FROM lines l, templates s WHERE len(list_intersect(l.words, s.words)) >= {THRESHOLD} * len(s.words) - 1e-9
),
best AS (
  SELECT * FROM hits
  QUALIFY rank() OVER (PARTITION BY line ORDER BY share DESC, common DESC) = 1
),
found AS (
  SELECT r, list(DISTINCT label) AS labels, max(share) AS score, count(DISTINCT line) AS n_blocks FROM best GROUP BY r
)
SELECT b.doc_id, CAST(b.n_words AS BIGINT) AS n_words, CAST(len(b.places) AS BIGINT) AS n_base,
       CAST(list_min(b.places) AS BIGINT) AS first_word, CAST(list_max(b.places) AS BIGINT) AS last_word,
       array_to_string(list_sort(b.base), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(b.base || coalesce(f.labels, []))), ',') AS labels,
       CAST(greatest(CASE WHEN len(b.base) > 0 THEN 1 ELSE 0 END, coalesce(f.score, 0)) AS DOUBLE) AS score,
       coalesce(f.n_blocks, 0) AS n_blocks
FROM b LEFT JOIN found f ON b.r = f.r
"""


ORACLE = {"op5_licenses": _oracle()}
