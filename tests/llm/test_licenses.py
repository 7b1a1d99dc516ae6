import random
import re
import textwrap
from collections import Counter

from sitewatts.llm import licenses as li
from tests.llm import helpers as h


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def base(text):
    words = plain_words(text)
    places, labels = [], set()
    for phrase, label in li.PHRASES.items():
        p = phrase.split()
        for k in range(len(words)):
            if words[k : k + len(p)] == p:
                places.append(k)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def joined(text, templates=li.TEMPLATES, threshold=li.THRESHOLD):
    """Labels by comparing every line with every template."""
    found, n = set(), 0
    for line in (text or "").split("\n"):
        block = set(plain_words(line))
        hits = []
        for label, notices in templates.items():
            for notice in notices:
                words = set(plain_words(notice))
                common = len(words & block)
                if common >= threshold * len(words) - 1e-9:
                    hits.append((common / len(words), common, label))
        if hits:
            n += 1
            top = max(x[:2] for x in hits)
            found |= {x[2] for x in hits if x[:2] == top}
    return found, n


def check(rows, out):
    key = lambda r: tuple(-1 if x is None else x for x in r)
    want = []
    for i, text in rows:
        b = base(text)
        found, n = joined(text)
        want.append(key((i, *b, ",".join(sorted(found | set(filter(None, b[4].split(","))))), n)))
    got = [key((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.n_blocks)) for r in out]
    assert sorted(got) == sorted(want) and all(0 <= r.score <= 1 for r in out)


def test_whole_table_matches_brute_force(spark):
    docs = h.documents("/root/testdata/sf0.01")
    rows = list(zip(docs.doc_id.tolist(), docs.text.tolist(), strict=True))
    out = li.op5_licenses(spark, "/root/testdata/sf0.01").collect()
    check(rows, out)
    assert any("cc-by-nc" in r.labels for r in out)


def test_join_is_exact_for_random_templates():
    rng = random.Random(6)
    vocabulary = [f"w{k}" for k in range(60)]
    templates = {str(k): (" ".join(rng.sample(vocabulary, rng.randrange(1, 15))),) for k in range(40)}
    for threshold in (0.3, 0.5, 0.8, 1.0):
        join = li.Join(templates, Counter({w: rng.randrange(9) for w in vocabulary}), threshold)
        for _ in range(300):
            block = set(rng.sample(vocabulary, rng.randrange(1, 25)))
            want = {k for k, (t,) in templates.items() if len(set(t.split()) & block) >= threshold * len(set(t.split())) - 1e-9}
            assert {label for label, _, _ in join.match(block)} == want


def test_odd_rows(spark, extra):
    rows = [
        *h.odd_rows(), (50, "The MIT LICENSE and mit license, mit-license\nApache\nLicense"), (51, "general public license\n" * 3),
        (52, "PERMISSION is hereby granted free of charge to any person obtaining a copy of this software and documentation"), (53, "mit\tlicense"),
    ]
    check(rows, li.scan(extra(h.frame(spark, rows))).collect())
    assert li.scan(h.frame(spark, [])).count() == 0


def test_wrapped_notices_are_found(spark):
    """Every template hard-wrapped, in comments, between other lines, and begun in the middle of a line."""
    notices = [(label, t) for label, ts in li.TEMPLATES.items() for t in ts]
    rows, want = [], {}
    wrapped = lambda t, width: textwrap.wrap(t, width, break_long_words=False, break_on_hyphens=False)
    for width in (30, 50, 76):
        for label, t in notices:
            for k, lines in enumerate((wrapped(t, width), wrapped(f"Some other prose stands here first. {t} Then more of it.", width))):
                i = len(rows)
                body = [" * " + line for line in lines] if k else ["#", *lines, "#", "int main"]
                rows.append((i, "\n".join(["first line of a file", *body, "last line of it"])))
                want[i] = label
    got = {r.doc_id: r for r in li.scan(h.frame(spark, rows), phrases={}).collect()}
    assert {i: (r.labels, r.score, r.n_blocks) for i, r in got.items()} == {i: (label, 1.0, 1) for i, label in want.items()}


def test_a_run_replaces_its_lines_only_if_better():
    join = li.Join({"a": ("one two three four five",), "b": ("six seven eight nine ten",)}, {}, 0.8)
    split = lambda text: [li.words_of(line) for line in text.split("\n")]
    met = lambda text: [g for g in li.blocks(split(text), join, frozenset(join.prefix_words))]
    assert met("one two three four five\nsix seven eight nine ten") == [[("a", 1.0, 5)], [("b", 1.0, 5)]]
    assert met("one two three four\n\nfive") == [[("a", 1.0, 5)]]
    assert met("one two\n" + "x " * 6 + "\nthree four five") == []


def brute_blocks(lines, templates, threshold):
    """Every line and every run of lines against every template, then the best of those that overlap."""
    lines = [x for x in lines if x]
    longest = max(len(t.split()) for t in templates.values())
    found = []
    for first in range(len(lines)):
        for last in range(first, len(lines)):
            between = lines[first + 1 : last]
            if sum(map(len, between)) > longest:
                continue
            block = set(lines[first]) if first == last else {*lines[first][-longest:], *lines[last][:longest], *sum(between, [])}
            hits = []
            for label, t in templates.items():
                common = len(set(t.split()) & block)
                if common >= threshold * len(set(t.split())) - 1e-9:
                    hits.append((label, common / len(set(t.split())), common))
            if hits:
                share, common = max(h[1:] for h in hits)
                found.append((-share, -common, last - first, first, last, sorted(hits)))
    out, taken = [], set()
    for *_, first, last, hits in sorted(found):
        if taken.isdisjoint(range(first, last + 1)):
            taken.update(range(first, last + 1))
            out.append(hits)
    return out


def test_runs_of_lines_match_brute_force():
    """Templates of different lengths, cut up, wrapped and mixed with other lines at random."""
    rng = random.Random(12)
    vocabulary = [f"w{k}" for k in range(25)]
    seen = 0
    for _ in range(400):
        templates = {str(k): " ".join(rng.choices(vocabulary, k=rng.randrange(2, 12))) for k in range(rng.randrange(1, 5))}
        join = li.Join({k: (t,) for k, t in templates.items()}, Counter({w: rng.randrange(9) for w in vocabulary}), 0.8)
        words = sum((rng.choice([*templates.values(), " ".join(rng.choices(vocabulary, k=4))]).split() for _ in range(4)), [])
        lines, k = [], 0
        while k < len(words):
            n = rng.randrange(0, 7)
            lines.append(words[k : k + n])
            k += n
        got = [sorted(x) for x in li.blocks(lines, join, frozenset(join.prefix_words))]
        want = brute_blocks(lines, templates, 0.8)
        assert got == want
        seen += len(want)
    assert seen > 400


def test_licenses_that_hold_one_another_are_told_apart(spark):
    full = {label: max(notices, key=len) for label, notices in li.TEMPLATES.items()}
    rows = [(k, "\n".join(["int main", *textwrap.wrap(full[label].upper(), 70), "end"])) for k, label in enumerate(full)]
    got = {r.doc_id: (r.labels, r.n_blocks) for r in li.scan(h.frame(spark, rows), phrases={}).collect()}
    assert got == {k: (label, 1) for k, label in enumerate(full)}
    assert len(full) == 19 and sum(len(t.split()) > 60 for t in full.values()) >= 9
