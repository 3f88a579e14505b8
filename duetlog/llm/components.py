"""Connected components of a distributed edge list.

Alternating large-star and small-star rounds: every round is a grouped
minimum joined back to the edges, written to the shared folder, until the
edges no longer change.  Nothing is collected but one checksum row a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step.  ``edges`` (a, b) has a > b."""
    if large:      # every larger neighbour of u is linked to the least of u's neighbours and u
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("u"), F.least("a", "m").alias("m"))
        out = both.join(least, both["a"] == least["u"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:          # u and its smaller neighbours are linked to the least of them
        least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        out = edges.join(least, edges["a"] == least["u"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = out.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def roots(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); the root is the
    least node of the component.  Loops and repeated edges are allowed."""
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, seen = saved(now, "edges"), None
    for _ in range(max_rounds):
        now = saved(_star(_star(now, True), False), "edges")
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
