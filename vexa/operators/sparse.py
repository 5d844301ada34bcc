"""Sparse vectors as postings rows ``(id, term, w)`` and sparse inner-product top-k.

A sparse vector ``{index: weight}`` is stored exploded: one row per non-zero.
Search joins the (small, size-checked, broadcast) query postings with the
base postings on the index, sums ``w * qw`` per (query, id) with map-side
partial aggregation, then keeps the k best per query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vexa.functions.text import explode_tokens, tokenize
from vexa.operators.common import broadcast_query_side, rank_within


def text_postings(df: DataFrame, id_col: str, text_col: str, only_terms: DataFrame | None = None) -> DataFrame:
    """Term-frequency sparse vectors ``(id, term, w)`` of a text column.

    explode + count per (id, term): the partial aggregate runs map-side, and
    as every document sits in one task it is already complete there; the
    shuffle carries one row per distinct (doc, term).  ``only_terms`` (a
    small, broadcast term list such as a query batch's) is applied to the
    tokens before the aggregation, since Catalyst cannot push a later join
    through it.
    """
    tok = df.select(id_col, explode_tokens(tokenize(text_col)).alias("term")).where(F.col("term").isNotNull())
    if only_terms is not None:
        tok = tok.join(broadcast_query_side(only_terms.select("term").distinct()), "term", "left_semi")
    return tok.groupBy(id_col, "term").agg(F.count(F.lit(1)).cast("double").alias("w"))


def from_map(df: DataFrame, id_col: str, map_col: str) -> DataFrame:
    """``map<index, weight>`` column to postings rows."""
    return df.select(id_col, F.explode(map_col).alias("term", "w")).withColumn("w", F.col("w").cast("double"))


def drop_smallest(q: DataFrame, ratio: float, qid_col: str = "qid") -> DataFrame:
    """Drop the ``floor(ratio * n)`` smallest weights of every query (ties: index ascending)."""
    if ratio <= 0:
        return q
    r = rank_within(q, [qid_col], [F.col("w").asc(), F.col("term").asc()], name="_r")
    r = r.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(qid_col)))
    return r.where(F.col("_r") > F.floor(F.col("_n") * F.lit(float(ratio)))).drop("_r", "_n")


def sparse_ip_topk(base: DataFrame, queries: DataFrame, *, k: int = 10, drop_ratio: float = 0.0,
                   id_col: str = "id", qid_col: str = "qid") -> DataFrame:
    """``base(id, term, w)`` x ``queries(qid, term, w)`` -> ``(qid, id, score, rank)``."""
    q = drop_smallest(queries.select(F.col(qid_col).alias("qid"), "term", "w"), drop_ratio)
    q = broadcast_query_side(q.withColumnRenamed("w", "qw"))
    hits = (base.select(id_col, "term", "w").join(q, "term")
            .groupBy("qid", id_col).agg(F.sum(F.col("w") * F.col("qw")).alias("score")))
    return rank_within(hits, ["qid"], [F.col("score").desc(), F.col(id_col).asc()], k)
