"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Only built-in column expressions: ``split`` and ``regexp_extract_all`` on the same
pattern give what lies between the matches and the matches themselves; running
sums of their lengths (code points) are the positions. The context of a match is the
text's ``CONTEXT`` characters on either side of it, whatever lies there, other matches too.

A kind is *certain* if a match that passes its check always counts (email, ip,
card with Luhn, phone with a plus); these are the base spans. The other kinds
(account numbers by mod-97, phone numbers without a plus, social security
numbers) start from the pattern's score, gain by a passed checksum and by context
words within CONTEXT characters, and count from THRESHOLD on unless they overlap a
certain span.

All patterns run in linear time: a match starts where a run of its characters
starts or where the match before ended, and runs aren't given back.

``redact`` replaces exactly the spans that ``spans`` lists, found in the original text;
where several overlap, all of their characters become one bracket, with the kind listed
first. Texts are cut into blocks for this, so the work grows with the text.

Null texts are empty texts and have no spans (``redact`` leaves them null). Rows are kept apart
even if they have the same doc_id or the same text. Several kinds may claim the same
characters. ``redact`` keeps all columns, however named. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitewatts.llm.common import read

CONTEXT = 40
THRESHOLD = 0.6


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    certain: bool
    score: float
    words: str
    #: Fewest characters of a match.
    least: int
    #: A cheap test of the text before the pattern runs, as a literal that has to be there; "" for none.
    needs: str = ""


_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: In the order in which spans are listed.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", True, 0.9, "mail|contact|write", 5, "@"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", True, 0.6, "ip|host|server|address|login", 7, "."),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", True, 0.8, "card|visa|credit|karte|tarjeta|carte", 2),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", True, 0.7, "call|phone|tel|mobile|fax", 4, "+"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])", False, 0.2, "iban|account|bank|konto|compte|cuenta", 15),
    Kind("local_phone", r"(?<![0-9+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])", False, 0.4, "call|phone|tel|mobile|fax|telefon|móvil", 12),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", False, 0.4, "ssn|social security", 11, "-"),
)
CERTAIN = tuple(k.name for k in KINDS if k.certain)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of ``value`` pass Luhn's checksum; every second digit from the right counts double."""
    d = digits(value)

    def add(total: Column, i: Column) -> Column:
        digit = F.ascii(F.substring(d, F.length(d) - i + 1, F.lit(1))) - 48
        twice = 2 * digit
        return total + F.when(i % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether letters and digits, the first four moved to the end and A to Z read as 10 to 35, leave 1 modulo 97."""
    plain = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def step(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda r, c: F.when(c == "", r).otherwise(step(r, c))) == 1


def confirmed(kind: str, value: Column) -> Column:
    """The check of a certain kind, or the checksum of another (null: it has none)."""
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits(value)).between(13, 19), luhn(value)).otherwise(False)
    if kind == "phone":
        return F.length(digits(value)).between(9, 15)
    if kind == "iban":
        return mod97(value)
    return F.lit(True) if kind == "email" else F.lit(None).cast("boolean")


def scored(kind: Kind, value: Column, before: Column, after: Column) -> Column:
    """0 for a failed check; else the kind's score, more with a checksum or a context word near."""
    near = F.lower(F.concat_ws(" ", before, after)).rlike(rf"\b(?:{kind.words})")
    bonus = F.when(near, 0.1 if kind.certain else 0.3).otherwise(0.0)
    good = confirmed(kind.name, value)
    sum_bonus = F.when(F.lit(kind.name) == "iban", 0.6).otherwise(0.0)
    return F.when(good.isNull() | good, F.least(F.lit(1.0), F.lit(kind.score) + sum_bonus + bonus)).otherwise(0.0)


def _found(kind: Kind, pieces: Column, matches: Column, around: Column) -> Column:
    """array<struct(rank, i, gap, value, score)> of one kind; gap: code points since the match before.

    ``around``: pieces and matches in the text's order. So many of them as hold CONTEXT
    characters, each cut to that, are put together on either side of a match.
    """
    reach = 2 * -(-CONTEXT // kind.least)

    def one(value: Column, i: Column) -> Column:
        first = F.greatest(2 * i - reach, F.lit(0))
        before = F.transform(F.slice(around, first + 1, 2 * i - first + 1), lambda x: F.right(x, F.lit(CONTEXT)))
        after = F.transform(F.slice(around, 2 * i + 3, F.lit(reach + 1)), lambda x: F.left(x, F.lit(CONTEXT)))
        return F.struct(
            F.lit(KINDS.index(kind)).alias("rank"),
            i.alias("i"),
            F.length(F.get(pieces, i)).alias("gap"),
            value.alias("value"),
            scored(kind, value, F.right(F.array_join(before, ""), F.lit(CONTEXT)), F.left(F.array_join(after, ""), F.lit(CONTEXT))).alias("score"),
        )

    return F.transform(matches, one)


def _candidates(docs: DataFrame, kept: Column, text: str = "text") -> DataFrame:
    """row_id, the column ``kept`` (named), and ``found``: the candidates of all kinds in the text."""
    df = docs.select(F.monotonically_increasing_id().alias("row_id"), kept, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    t = F.col("__text")
    for kind in KINDS:
        has = F.contains(t, F.lit(kind.needs)) if kind.needs else t.rlike("[0-9]")
        df = df.withColumn("__pieces", F.when(has, F.split(t, kind.pattern, -1)).otherwise(F.array(t)))
        some = F.size("__pieces") > 1
        none = F.array().cast("array<string>")
        df = df.withColumn("__matches", F.when(some, F.regexp_extract_all(t, F.lit(kind.pattern), F.lit(0))).otherwise(none))
        pairs = F.flatten(F.transform("__matches", lambda m, i: F.array(F.get(F.col("__pieces"), i), m)))
        around = F.when(some, F.concat(pairs, F.array(F.element_at("__pieces", -1)))).otherwise(none)
        df = df.withColumn("__around", around)
        found = _found(kind, F.col("__pieces"), F.col("__matches"), F.col("__around"))
        df = df.withColumn(f"__{kind.name}", found).drop("__pieces", "__matches", "__around")
    names = [f"__{k.name}" for k in KINDS]
    return df.withColumn("found", F.concat(*names)).drop("__text", *names)


def _judged(found: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates (row_id, ``keys``, and the fields of a candidate) with their place, and whether and as what they count."""
    upto = Window.partitionBy("row_id", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    ends = F.sum(F.col("gap") + F.length("value")).over(upto)
    placed = found.withColumn("end", ends).withColumn("start", F.col("end") - F.length("value"))
    placed = placed.withColumn("certain", (F.col("rank") < len(CERTAIN)) & (F.col("score") > 0))
    by_row = Window.partitionBy("row_id").orderBy("start")
    sure_end = F.max(F.when(F.col("certain"), F.col("end"))).over(by_row.rowsBetween(Window.unboundedPreceding, -1))
    sure_start = F.min(F.when(F.col("certain"), F.col("start"))).over(by_row.rowsBetween(1, Window.unboundedFollowing))
    placed = placed.withColumn(
        "clear", (F.coalesce(sure_end, F.lit(0)) <= F.col("start")) & (F.coalesce(sure_start, F.col("end")) >= F.col("end"))
    )
    extra = (F.col("rank") >= len(CERTAIN)) & (F.col("score") >= THRESHOLD) & F.col("clear")
    names = F.array(*[F.lit(k.name) for k in KINDS])
    return placed.select(
        "row_id", *keys, F.when(F.col("certain") | extra, F.get(names, F.col("rank"))).alias("kind"),
        "rank", F.col("start").cast("long"), F.col("end").cast("long"), "value", "score", "certain",
    )


def judged(docs: DataFrame) -> DataFrame:
    """row_id, doc_id, and a candidate each with kind (null: it doesn't count), rank, start, end, value, score, certain.

    A row without candidates is there once, with nulls. All candidates of a row are
    in one partition, so callers can group by row_id without a shuffle.
    """
    found = _candidates(docs, F.col("doc_id")).select("row_id", "doc_id", F.explode_outer("found").alias("s"))
    return _judged(found.select("row_id", "doc_id", "s.*").repartition("row_id"), ["doc_id"])


def spans(docs: DataFrame) -> DataFrame:
    """One row per span that counts: row_id, doc_id, kind, rank, start, end, value, score, certain.

    Positions are in code points, end exclusive.
    """
    return judged(docs).where("kind is not null")


#: Code points of the blocks that texts are cut into.
BLOCK = 1024


def _between(blocks: Column, start: Column, end: Column) -> Column:
    """The code points from ``start`` to ``end`` (exclusive) of a text that is cut into blocks."""
    first = F.floor(start / BLOCK).cast("int")
    few = F.slice(blocks, first + 1, F.floor((end - 1) / BLOCK).cast("int") - first + 1)
    return F.when(end > start, F.substring(F.array_join(few, ""), (start - first * BLOCK + 1).cast("int"), (end - start).cast("int"))).otherwise("")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span that counts (``spans``) replaced by its kind in brackets; other columns as they are.

    Rows go to their spans in one shuffle, once each. A null text stays null.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    found = _candidates(docs, row, text).select("row_id", "row", F.posexplode_outer("found").alias("pos", "s"))
    # of a row's candidates the first carries the row
    found = found.select("row_id", F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("row")).alias("row"), "s.*")
    spots = _judged(found.repartition("row_id"), ["row"])
    counts = F.col("kind").isNotNull()
    in_order = Window.partitionBy("row_id").orderBy("start", "rank")
    reached = F.max(F.when(counts, F.col("end"))).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.when(counts & (F.coalesce(reached, F.lit(0)) <= F.col("start")), 1).otherwise(0)
    spots = spots.withColumn("apart", apart)
    spots = spots.withColumn("place", F.sum("apart").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    counted = lambda c: F.when(F.col("kind").isNotNull(), F.col(c))
    merged = spots.groupBy("row_id", "place").agg(
        F.first("row", ignorenulls=True).alias("row"), F.min(counted("start")).alias("start"), F.max(counted("end")).alias("end"),
        F.min(counted("rank")).alias("rank"),
    )
    span = F.when(F.col("rank").isNotNull(), F.struct("start", "end", "rank"))
    whole = merged.groupBy("row_id").agg(
        F.first("row", ignorenulls=True).alias("row"), F.sort_array(F.collect_list(span)).alias("cut")
    )
    old = F.col("row").getField(text)
    whole = whole.withColumn("blocks", F.when(F.size("cut") > 0, F.regexp_extract_all(old, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))))
    labels = F.array(*[F.lit(f"[{k.name.upper()}]") for k in KINDS])

    def shown(s: Column, i: Column) -> Column:
        since = F.coalesce(F.get(F.col("cut"), i - 1)["end"], F.lit(0).cast("long"))
        return F.concat(_between(F.col("blocks"), since, s["start"]), F.get(labels, s["rank"]))

    rest = _between(F.col("blocks"), F.element_at("cut", -1)["end"], F.length(old).cast("long"))
    new = F.when(F.size("cut") > 0, F.concat(F.array_join(F.transform("cut", shown), ""), rest)).otherwise(old)
    return whole.select(*[new.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])


def listed(only_certain: bool) -> Column:
    """kind:start:end of the collected spans, by kind as listed, then start, comma-joined."""
    picked = F.when(F.col("kind").isNotNull() & (F.col("certain") | F.lit(not only_certain)), F.struct("rank", "start", "end", "kind"))
    return F.array_join(
        F.transform(F.sort_array(F.collect_list(picked)), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judged(read(spark, sf_dir, "documents"))
    counts = [F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in CERTAIN]
    return found.groupBy("row_id", "doc_id").agg(
        *counts, F.sha2(listed(True), 256).alias("base_sha256"), listed(False).alias("spans")
    ).drop("row_id")


QUERIES = {"op2_pii": op2_pii}
