"""URL filters: host and path rules, and a tree of path templates judged by labelled purity.

Only DataFrame operations. Urls that a rule decides are the labels. For the others:

1. Segments of digits, hex digits, a date or a UUID become wildcards of their class (a
   file ending is kept). What is left of the paths of a host is its tree, of any depth.
2. Branches of a node that don't differ are merged, from the leaves up: a literal segment becomes ``*``
   together with its siblings unless its branch has labels and their blocked share
   differs significantly from that of the node. A branch with no other to merge with keeps its name.
   What is below a node doesn't change what it holds, and merging below it doesn't either, so one pass
   over all nodes of all depths makes the same decisions as going up level by level.
3. The share of blocked labels is smoothed from the whole table to the host and then branch by
   branch down to the template; from REJECT on a template is blocked.

The tree has a row per node, not per url: urls are counted (map-side) by host and path of
wildcards. Nodes are keyed by the SHA-256 of their path, so deep paths stay small.
Joins have no aggregate on top, so a hot host's rows can be split.

A null url, or one without ``://``, has an empty host and path; such rows form one
template and fit no rule. Repeated rows get equal results. Without labels nothing
is blocked. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewatts.llm.common import read, stored

#: Labels that the level above counts for, z-value of a significant difference, and the share to reject from.
SMOOTHING, SIGNIFICANT, REJECT = 4.0, 2.0, 0.8


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: Fixed values (contract).
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def parsed(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """key, host, path."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.substring(F.col("url"), at + 3, F.length("url"))).otherwise("")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    df = pages.select(F.col(key), F.coalesce(rest, F.lit("")).alias("__rest"))
    return df.select(
        key,
        F.translate(F.regexp_extract("__rest", "^([^/?#]*)", 1), upper, upper.lower()).alias("host"),
        F.regexp_extract("__rest", "^[^/?#]*([^?#]*)", 1).alias("path"),
    )


def with_rule(urls: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Adds rule (its text) and ruled (its verdict), null where none fits. Longest wins; a bounded list."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((F.col("host") == r.host) | F.endswith("host", F.lit("." + r.host))) & F.startswith("path", F.lit(r.path))
        rule, verdict = F.when(fits, r.text).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return urls.withColumn("rule", rule).withColumn("ruled", verdict)


def generalised(segment: Column) -> Column:
    """The class wildcard of a segment, or the segment itself."""
    ending = F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})$", 1)
    stem = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}$", "")
    kind = (
        F.when(stem.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), "{date}")
        .when(stem.rlike(r"^[0-9]+$"), "{n}")
        .when(stem.rlike(r"^[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$"), "{uuid}")
        .when(stem.rlike(r"^(?=.*[0-9])[0-9A-Fa-f]{8,}$"), "{hex}")
    )
    return F.when(kind.isNotNull(), F.concat(kind, ending)).otherwise(segment)


def tokens(path: Column) -> Column:
    """The path's segments, with wildcards, put together again without the first slash."""
    return F.array_join(F.transform(F.split(F.regexp_replace(path, "^/", ""), "/"), generalised), "/")


def smooth(blocked: Column, labelled: Column, above: Column) -> Column:
    """Share of blocked labels, where the level above counts as SMOOTHING labels."""
    return (blocked + SMOOTHING * above) / (labelled + SMOOTHING)


def _share(blocked: Column, labelled: Column) -> Column:
    return F.coalesce(F.try_divide(blocked.cast("double"), labelled), F.lit(0.0))


def _prefixes(column: str, out: str) -> Column:
    """Explodes a path: (depth, key of the path above, segment), depth from 1."""
    parts = F.split(column, "/")
    above = lambda k: F.sha2(F.array_join(F.slice(parts, F.lit(1), k - 1), "/"), 256)
    steps = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda k: F.struct(k.alias("depth"), above(k).alias("above"), F.get(parts, k - 1).alias("segment")),
    )
    return F.explode(steps).alias(out)


def templates(counted: DataFrame) -> DataFrame:
    """``counted`` (host, tokens, blocked, labelled) with the template of each path."""
    steps = counted.select("host", "tokens", "blocked", "labelled", _prefixes("tokens", "s")).select("*", "s.*").drop("s")
    branches = steps.groupBy("host", "depth", "above", "segment").agg(F.sum("blocked").alias("b"), F.sum("labelled").alias("l"))
    branches = stored(branches, "branches")
    hosts = counted.groupBy("host").agg(_share(F.sum("blocked"), F.sum("labelled")).alias("host_share"))
    nodes = branches.groupBy("host", "depth", "above").agg(F.sum("b").alias("node_b"), F.sum("l").alias("node_l"))
    share = smooth(F.col("node_b"), F.col("node_l"), F.col("host_share"))
    error = F.sqrt(F.greatest(share * (1 - share), F.lit(1e-4)) / F.greatest("l", F.lit(1)))
    apart = (F.col("l") > 0) & (F.abs(F.col("b") / F.greatest("l", F.lit(1)) - share) > SIGNIFICANT * error)
    literal = ~F.startswith("segment", F.lit("{")) & (F.col("segment") != "")
    like = branches.join(nodes, ["host", "depth", "above"]).join(hosts, "host").where(literal & ~apart)
    like = stored(like.select("host", "depth", "above", "segment"), "like")
    several = like.groupBy("host", "depth", "above").agg(F.count(F.lit(1)).alias("alike")).where("alike > 1")
    merged = like.join(several, ["host", "depth", "above"], "left_semi").withColumn("wild", F.lit("*"))
    named = steps.join(merged, ["host", "depth", "above", "segment"], "left")
    segment = F.struct("depth", F.coalesce("wild", "segment").alias("segment"))
    whole = named.groupBy("host", "tokens").agg(F.sort_array(F.collect_list(segment)).alias("segments"))
    template = F.concat(F.lit("/"), F.array_join(F.transform("segments", lambda x: x["segment"]), "/"))
    return counted.join(whole.select("host", "tokens", template.alias("template")), ["host", "tokens"])


def judged(tree: DataFrame, reject: float = REJECT) -> DataFrame:
    """Per host and template: urls, labels (blocked, all), smoothed purity and verdict.

    ``tree`` has host, template, n, blocked and labelled (counts of labels).
    """
    leaf = tree.groupBy("host", "template").agg(
        F.sum("n").alias("urls"), F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled")
    )
    leaf = stored(leaf, "leaves")
    overall = leaf.agg(_share(F.sum("blocked"), F.sum("labelled"))).first()[0]
    steps = leaf.select("host", "template", "blocked", "labelled", _prefixes("template", "s")).select("*", "s.*").drop("s")
    # depth 1 is the empty segment before the first slash: the whole host
    nodes = steps.groupBy("host", "depth", "above", "segment").agg(F.sum("blocked").alias("b"), F.sum("labelled").alias("l"))
    way = steps.join(nodes, ["host", "depth", "above", "segment"]).groupBy("host", "template").agg(
        F.sort_array(F.collect_list(F.struct("depth", "b", "l"))).alias("way")
    )
    purity = F.aggregate("way", F.lit(float(overall or 0.0)), lambda above, x: smooth(x["b"], x["l"], above))
    df = leaf.join(way.select("host", "template", purity.alias("purity")), ["host", "template"])
    return df.withColumn("judged", F.when(F.col("purity") >= reject, "block").otherwise("allow"))


def url_filter(pages: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "page_id", reject: float = REJECT) -> DataFrame:
    """One row per row of ``pages`` (key, url): key, host, path, rule, verdict, template, purity."""
    urls = with_rule(parsed(pages, key), rules).withColumn("tokens", tokens(F.col("path")))
    counted = urls.groupBy("host", "tokens").agg(
        F.count("*").alias("n"),
        F.count(F.when(F.col("ruled") == "block", 1)).alias("blocked"),
        F.count("ruled").alias("labelled"),
    )
    tree = stored(templates(stored(counted, "paths")), "tree")
    verdicts = judged(tree, reject).select("host", "template", "purity", "judged")
    by_path = stored(tree.select("host", "tokens", "template").join(verdicts, ["host", "template"]), "verdicts")
    return urls.join(by_path, ["host", "tokens"]).select(
        key, "host", "path", "rule", F.coalesce("ruled", "judged").alias("verdict"), "template", "purity"
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(read(spark, sf_dir, "pages"))


QUERIES = {"op8_url_filter": op8_url_filter}


def _oracle() -> str:
    """The same in DuckDB, on whole paths instead of their digests."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    rules = sorted(RULES, key=lambda r: (-len(r.text), r.text))
    fits = [f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in rules]
    rule = " ".join(f"WHEN {f} THEN '{r.text}'" for f, r in zip(fits, rules, strict=True))
    ruled = " ".join(f"WHEN {f} THEN '{r.verdict}'" for f, r in zip(fits, rules, strict=True))
    ending = r"regexp_extract(seg, '(\.[A-Za-z]{1,5})$', 1)"
    stem = r"regexp_replace(seg, '\.[A-Za-z]{1,5}$', '')"
    classes = (
        ("{date}", f"regexp_matches({stem}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')"),
        ("{n}", f"regexp_matches({stem}, '^[0-9]+$')"),
        ("{uuid}", f"regexp_matches({stem}, '^[0-9A-Fa-f]{{8}}(-[0-9A-Fa-f]{{4}}){{3}}-[0-9A-Fa-f]{{12}}$')"),
        ("{hex}", f"regexp_matches({stem}, '^[0-9A-Fa-f]{{8,}}$') AND regexp_matches({stem}, '[0-9]')"),
    )
    kinds = " ".join(f"WHEN {test} THEN '{name}' || {ending}" for name, test in classes)
    mean = lambda b, l, above: f"(({b}) + {SMOOTHING}::DOUBLE * ({above})) / (({l}) + {SMOOTHING}::DOUBLE)"
    return f"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
),
p AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), '{upper}', '{upper.lower()}') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
),
urls AS (
  SELECT *, CASE {rule} END AS rule, CASE {ruled} END AS ruled,
         list_transform(string_split(regexp_replace(path, '^/', ''), '/'), lambda seg: CASE {kinds} ELSE seg END) AS parts
  FROM p
),
counted AS (
  SELECT host, parts, count(*) AS n, count(*) FILTER (WHERE ruled = 'block') AS blocked, count(ruled) AS labelled
  FROM urls GROUP BY host, parts
),
steps AS (
  SELECT host, parts, blocked, labelled, k, parts[1:k - 1] AS above, parts[k] AS seg
  FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS k FROM counted)
),
branches AS (SELECT host, above, seg, sum(blocked) AS b, sum(labelled) AS l FROM steps GROUP BY ALL),
hosts AS (
  SELECT host, CASE WHEN sum(labelled) > 0 THEN CAST(sum(blocked) AS DOUBLE) / sum(labelled) ELSE 0 END AS host_share
  FROM counted GROUP BY host
),
nodes AS (
  SELECT host, above, {mean("sum(b)", "sum(l)", "any_value(host_share)")} AS share
  FROM branches JOIN hosts USING (host) GROUP BY host, above
),
alike AS (
  SELECT host, above, seg, count(*) OVER (PARTITION BY host, above) AS alike
  FROM branches JOIN nodes USING (host, above)
  WHERE NOT starts_with(seg, '{{') AND seg <> ''
    AND NOT (l > 0 AND abs(CAST(b AS DOUBLE) / greatest(l, 1) - share)
             > {SIGNIFICANT}::DOUBLE * sqrt(greatest(share * (1 - share), 1e-4::DOUBLE) / greatest(l, 1)))
),
tree AS (
  SELECT s.host, s.parts, any_value(s.blocked) AS blocked, any_value(s.labelled) AS labelled,
         list('' || CASE WHEN a.alike > 1 THEN '*' ELSE s.seg END ORDER BY s.k) AS names
  FROM steps s LEFT JOIN alike a ON s.host = a.host AND s.above = a.above AND s.seg = a.seg
  GROUP BY s.host, s.parts
),
leaf AS (SELECT host, names, sum(blocked) AS blocked, sum(labelled) AS labelled FROM tree GROUP BY host, names),
way AS (
  SELECT host, names, blocked, labelled, names[1:k] AS prefix, k
  FROM (SELECT *, unnest(range(0, len(names) + 1)) AS k FROM leaf)
),
sums AS (SELECT host, prefix, CAST(sum(blocked) AS DOUBLE) AS b, CAST(sum(labelled) AS DOUBLE) AS l FROM way GROUP BY host, prefix),
o AS (SELECT CASE WHEN sum(labelled) > 0 THEN CAST(sum(blocked) AS DOUBLE) / sum(labelled) ELSE 0 END AS overall FROM leaf),
judged AS (
  SELECT host, names,
         list_reduce(list_prepend({{'b': any_value(overall), 'l': 0::DOUBLE}}, list({{'b': b, 'l': l}} ORDER BY k)),
                     lambda x, y: {{'b': {mean("y.b", "y.l", "x.b")}, 'l': 0::DOUBLE}}).b AS purity
  FROM way JOIN sums USING (host, prefix), o GROUP BY host, names
)
SELECT page_id, urls.host, urls.path, rule, coalesce(ruled, CASE WHEN purity >= {REJECT} THEN 'block' ELSE 'allow' END) AS verdict,
       '/' || array_to_string(tree.names, '/') AS template, purity
FROM urls JOIN tree ON urls.host = tree.host AND urls.parts = tree.parts
JOIN judged ON tree.host = judged.host AND tree.names = judged.names
"""


ORACLE = {"op8_url_filter": _oracle()}
