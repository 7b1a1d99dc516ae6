import hashlib
import re

from pyspark.sql import functions as F

from sitewatts.llm import pii
from tests.llm import helpers as h


def luhn(digits):
    return sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(reversed(digits))) % 10 == 0


def base(text):
    text, out = text or "", []
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(x) for x in m[0] if x.isdigit()]
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(x.isdigit() for x in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def check(rows, out):
    want = []
    for i, text in rows:
        spans = base(text)
        counts = [sum(s[0] == k for s in spans) for k in ("email", "ip", "card", "phone")]
        want.append((i if i is not None else -1, *counts, hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()))
    got = [(r.doc_id if r.doc_id is not None else -1, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in out]
    assert sorted(got) == sorted(want)


TRICKY = [
    "a.b@c.de, b@c (x@y.z.w) a@b@c.d e@f.g%h@i.j @.@ x@-.-", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.4 1.2.3 999999999999.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 378282246310005 1  2 12345678901234567890", "+1 (555) 010-9999 +12 +1234567890123456 +1...............2 ++49 89 123456-7",
    "a" * 30_000 + "@x.de", "1" * 30_000, "9." * 20_000, "x@y" + ".z" * 20_000, "+1" + " (" * 9000 + "2", "ß日本 me@firma.de é 10.0.0.1",
]


def test_base_spans_match_brute_force(spark):
    rows = list(zip(*h.documents()[["doc_id", "text"]].to_numpy().T.tolist(), strict=True))
    check(rows, pii.op2_pii(spark, h.SF).collect())


def test_tricky_and_odd_texts(spark, extra):
    rows = [*enumerate(TRICKY), *[(100 + (i or 0), t) for i, t in h.odd_rows()], (None, "mail me@x.org")]
    found = pii.judged(extra(h.frame(spark, rows)))
    counts = [F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in pii.CERTAIN]
    out = found.groupBy("row_id", "doc_id").agg(*counts, F.sha2(pii.listed(True), 256).alias("base_sha256")).collect()
    check(rows, out)
    assert pii.spans(h.frame(spark, [])).count() == 0


def test_checksums_and_context_decide_on_other_kinds(spark):
    texts = {
        1: "my iban DE89 3704 0044 0532 0130 00 ok", 2: "iban DE88 3704 0044 0532 0130 00 wrong sum", 3: "call 555-010-9999 now",
        4: "part 555-010-9999", 5: "ssn 123-45-6789", 6: "size 123-45-6789", 7: "call +1 555-010-9999",
    }
    got = {}
    for r in pii.spans(h.frame(spark, list(texts.items()))).collect():
        got.setdefault(r.doc_id, []).append((r.kind, texts[r.doc_id][r.start : r.end]))
    assert got == {
        1: [("iban", "DE89 3704 0044 0532 0130 00")], 3: [("local_phone", "555-010-9999")], 5: [("ssn", "123-45-6789")],
        7: [("phone", "+1 555-010-9999")],
    }


def test_context_is_what_stands_around_a_match_other_matches_included(spark):
    texts = {
        1: "phone 555-123-4567 or 555-987-6543 or 555-222-3333",
        2: "555-123-4567, 555-987-6543, 555-222-3333 tel",
        3: "phone " + "x" * 29 + " 555-987-6543, 555-111-2222",  # the word begins 36 and 50 characters before
        4: "ssn 123-45-6789 123-45-6780 123-45-6781 123-45-6782",  # 4, 16, 28 and 40 characters
        5: "ssn: 123-45-6789 123-45-6780 123-45-6781 123-45-6782",
    }
    got = {}
    for r in pii.spans(h.frame(spark, list(texts.items()))).collect():
        got.setdefault(r.doc_id, []).append(r.value)
    assert sorted(got[1]) == ["555-123-4567", "555-222-3333", "555-987-6543"]
    assert sorted(got[2]) == ["555-123-4567", "555-222-3333", "555-987-6543"]
    assert got[3] == ["555-987-6543"]
    assert len(got[4]) == 4 and len(got[5]) == 3


def by_positions(text, spans):
    """The text with spans that overlap as one bracket, named after the kind listed first."""
    order = [k.name for k in pii.KINDS]
    out, at = "", 0
    merged = []
    for a, b, kind in sorted(spans, key=lambda s: (s[0], order.index(s[2]))):
        if merged and a < merged[-1][1]:
            last = merged[-1]
            merged[-1] = (last[0], max(last[1], b), min(last[2], kind, key=order.index))
        else:
            merged.append((a, b, kind))
    for a, b, kind in merged:
        out += text[at:a] + f"[{kind.upper()}]"
        at = b
    return out + text[at:]


def test_redaction_replaces_the_listed_spans_and_nothing_else(spark):
    mixed = [
        "Reach +1 555 123 4567, 123-456-7890", "phone 555-123-4567 or 555-987-6543 or 555-222-3333", "+4111 1111 1111 1111",
        "é" * 1023 + " me@x.org " + "ß" * 3000 + "🙂 10.0.0.1 🙂" + "y" * 1024, "me@x.org", "", "call 5551234567@mail.com 1.2.3.4.5.6.7.8",
    ]
    rows = [*enumerate(TRICKY), (90, None), (91, "plain text"), *[(100 + k, t) for k, t in enumerate(mixed)]]
    rows += [(1000 + k, t) for k, t in enumerate(h.documents().text)]
    listed = {}
    for r in pii.spans(h.frame(spark, rows)).collect():
        listed.setdefault(r.doc_id, []).append((r.start, r.end, r.kind))
    out = {r.doc_id: r.text for r in pii.redact(h.frame(spark, rows)).collect()}
    assert len(out) == len(rows) and out[90] is None
    for i, text in rows:
        if text is not None:
            assert out[i] == by_positions(text, listed.get(i, []))
    # "phone" in brackets isn't a context word: it doesn't stand in the text
    assert out[100] == "Reach [PHONE], 123-456-7890" and out[101] == "phone [LOCAL_PHONE] or [LOCAL_PHONE] or [LOCAL_PHONE]"
    assert not any(base(out[i]) for i, _ in rows if i >= 91)


def test_redaction_keeps_columns_and_rows(spark):
    schema = "row_id long, text string, row string, __text string, __pieces string, found string, pos string, `a.b` string, place string, body string"
    rows = [(1, "me@x.org", *"abcdefg", "ip 1.2.3.4"), (1, "me@x.org", *"abcdefg", "none"), (None, None, *"abcdefh", None)]
    df = spark.createDataFrame(rows, schema)
    for column in ("text", "body"):
        got = pii.redact(df, column)
        assert got.columns == df.columns
        k = df.columns.index(column)
        want = [tuple({"me@x.org": "[EMAIL]", "ip 1.2.3.4": "ip [IP]"}.get(v, v) if j == k else v for j, v in enumerate(r)) for r in rows]
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert pii.redact(df.limit(0)).count() == 0
