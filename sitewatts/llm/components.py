"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewatts.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in ``edges`` (u, v); the component is its smallest id.

    Each step is two joins of the edges with per-node minima; the edges are
    written to the shared folder after each round, and only a count and a
    checksum come to the driver. Rounds grow with the logarithm of the longest
    chain. Self-loops, repeated edges and an empty table are fine.
    """
    edges = edges.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).where("u <> v").distinct()
    edges = stored(edges, "edges")
    before = _state(edges)
    while before[0]:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        # each neighbour and the node itself point to the least, in one pass over the join
        small = large.join(least, "u").select(F.inline(F.expr("array(struct(v AS u, m AS v), struct(u, m AS v))")))
        edges = stored(small.where("u <> v").distinct(), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    # at the fixed point every edge is (id, smallest id of its component)
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
