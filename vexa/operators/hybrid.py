"""Fusion of ranked lists.

Inputs are ranked lists ``(qid, id, score, rank)``; both are bounded by
queries x limit, so fusion is a union + group by (qid, id) -- no join of
large inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vexa.operators.common import rank_within

RRF_K = 60


def rrf(lists: list[DataFrame], id_col: str, k: int = RRF_K, limit: int = 10) -> DataFrame:
    """Reciprocal rank fusion: sum of 1 / (k + rank) over the lists."""
    u = None
    for df in lists:
        part = df.select("qid", id_col, (F.lit(1.0) / (F.lit(float(k)) + F.col("rank"))).alias("s"))
        u = part if u is None else u.unionByName(part)
    fused = u.groupBy("qid", id_col).agg(F.sum("s").alias("score"))
    return rank_within(fused, ["qid"], [F.col("score").desc(), F.col(id_col).asc()], limit)


def minmax(df: DataFrame, higher_better: bool = True) -> DataFrame:
    """Scores mapped to [0, 1] per query (best = 1); all-equal lists give 1."""
    w = Window.partitionBy("qid")
    lo, hi = F.min("score").over(w), F.max("score").over(w)
    num = (F.col("score") - lo) if higher_better else (hi - F.col("score"))
    return df.withColumn("norm", F.when(hi == lo, F.lit(1.0)).otherwise(num / (hi - lo)))


def weighted(lists: list[tuple[DataFrame, float, bool]], id_col: str, limit: int = 10) -> DataFrame:
    """Weighted sum of min-max normalised scores; a list missing an id adds 0."""
    u = None
    for df, wt, higher in lists:
        part = minmax(df, higher).select("qid", id_col, (F.col("norm") * F.lit(float(wt))).alias("s"))
        u = part if u is None else u.unionByName(part)
    fused = u.groupBy("qid", id_col).agg(F.sum("s").alias("score"))
    return rank_within(fused, ["qid"], [F.col("score").desc(), F.col(id_col).asc()], limit)


def rerank(hits: DataFrame, by: str, id_col: str, descending: bool = True) -> DataFrame:
    """Re-sort each query's hits by a scalar column (ties by id)."""
    order = F.col(by).desc() if descending else F.col(by).asc()
    return rank_within(hits.withColumnRenamed("rank", "vector_rank"), ["qid"], [order, F.col(id_col).asc()])
