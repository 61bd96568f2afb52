"""Connected components over edges, by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulith.llm.work import stash


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Ties each node's neighbours to the smallest node around it; minima are taken map-side first."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    met = both.join(least, "a")
    if large:
        out = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of edges(a, b); component is the smallest node reachable.

    Node values may be of any type with an order. Nulls and self-loops have no effect; repeated
    edges count once. Each step is written to the shared folder and read again; rounds grow with
    the logarithm of the largest component. No task holds a node's whole neighbourhood.
    """
    now = stash(edges.where("a is not null and b is not null and a <> b").select("a", "b").distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        now = stash(_star(_star(now, True), False), "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots).distinct()


def _mark(edges: DataFrame) -> tuple:
    """Equal only when the edges are: their number and two sums of their hashes."""
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.sum(F.hash("a", "b").cast("long"))).first())
