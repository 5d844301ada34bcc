"""Distributed connected components by alternating star contractions.

Every round replaces each edge by edges to the smallest neighbour (first for
larger neighbours, then for smaller ones) until each component is a star around
its smallest node.  Rounds grow with the logarithm of the longest path.  A
node with very many neighbours is never gathered: its minimum is a
partially aggregated ``min`` and the minimum is joined back to the edges, where
Spark's skew-join handling can split the hot side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vexa.llm.common import save


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction of edges (a > b)."""
    if large:
        sides = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        sides = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    low = sides.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = sides.join(low, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            low.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter("a != b").distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node that has an edge; component is the
    smallest node reachable.  Self-loops and repeated edges are harmless;
    edges with a null end are ignored.  An empty input gives an empty result."""
    e = (edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
         .select(F.greatest(a, b).cast("long").alias("a"), F.least(a, b).cast("long").alias("b")).distinct())
    e = save(e, "cc")

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"),
                            F.expr("bit_xor(xxhash64(b, a, 1))")).first())

    last = mark(e)
    while last[0]:
        e = save(_star(_star(e, True), False), "cc")
        now = mark(e)
        if now == last:
            break
        last = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
