"""Quality measurement: ground truth, recall@k, grid reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vexa.operators.multiknn import Search, search_many


def neighbors_list(hits: DataFrame, id_col: str, keys: list[str]) -> DataFrame:
    """Ranked hits -> one ``neighbors_id`` array per key group (bounded by k)."""
    g = hits.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("rank", id_col))).alias("_l"))
    return g.select(*keys, F.transform("_l", lambda s: s[id_col]).alias("neighbors_id"))


def ground_truth(base: DataFrame, queries: DataFrame, filters: dict[str, Column | None], *, k: int,
                 id_col: str, vec_col: str, metric: str = "L2") -> DataFrame:
    """Lists of true neighbours for every filter, from one scan of the base."""
    searches = [Search(name, vec_col, metric, cond) for name, cond in filters.items()]
    hits = search_many(base, queries, searches, k=k, id_col=id_col).withColumnRenamed("search", "filter_name")
    return neighbors_list(hits, id_col, ["filter_name", "qid"])


def recall_per_query(found: DataFrame, truth: DataFrame, id_col: str, k: int) -> DataFrame:
    """|found & truth| / min(k, |truth|) per query; a query with no true
    neighbours has recall 1.0 (nothing to find)."""
    t = truth.select("qid", id_col).withColumn("_t", F.lit(1))
    n_truth = truth.groupBy("qid").agg(F.count(F.lit(1)).alias("n_truth"))
    hits = found.select("qid", id_col).join(t, ["qid", id_col]).groupBy("qid").agg(F.count(F.lit(1)).alias("hits"))
    r = n_truth.join(hits, "qid", "left").fillna(0, ["hits"])
    den = F.least(F.lit(k), F.col("n_truth"))
    return r.select("qid", F.col("hits").cast("long").alias("hits"),
                    F.when(den == 0, F.lit(1.0)).otherwise(F.col("hits") / den).alias("recall"))


def mean_recall(per_query: DataFrame) -> DataFrame:
    return per_query.agg(F.round(F.avg("recall"), 4).alias("recall"))
