"""Small shared helpers for the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vexa.session import scratch_path

# What is broadcast without further thought: rows, and bytes as written.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 32 << 20


def kept(df: DataFrame, name: str = "kept") -> DataFrame:
    """``df`` evaluated once: written to the shared scratch folder and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only when its size proves it small; else leave the join to
    the planner (sort-merge / shuffle-hash, with AQE re-planning).

    It is evaluated once, written, and measured by its rows and bytes on disk."""
    spark = df.sparkSession
    path = scratch_path(spark, "side")
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    size = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()
    return F.broadcast(back) if size <= BROADCAST_BYTES and back.count() <= max_rows else back


def broadcast_query_side(df: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """Broadcast a query-derived table (query terms, probe lists) evaluated
    once: it is collected only when at most ``max_rows`` rows exist, so the
    size check and the broadcast share one evaluation.  Larger inputs stay
    distributed and the planner joins them with a shuffle."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def rank_within(df: DataFrame, keys, order, k: int | None = None, name: str = "rank") -> DataFrame:
    """1-based bigint rank per key group; keeps rank <= k when k is given
    (Spark inserts a partial WindowGroupLimit before the shuffle)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(w).cast("long"))
    return out.where(F.col(name) <= k) if k is not None else out


def vector_dim(df: DataFrame, vec_col: str) -> int:
    """Largest vector length present (one aggregate job)."""
    return int(df.select(F.max(F.size(vec_col))).first()[0] or 0)
