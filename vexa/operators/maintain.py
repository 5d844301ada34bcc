"""Table maintenance over per-segment statistics.

A segment is one file (or a key range standing in for one).  Statistics are
one aggregate over base rows left-joined with the delete log; candidates and
groups are computed on that per-segment table, whose size is the number of
files, not rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vexa.operators.common import broadcast_if_small


def segment_stats(base: DataFrame, seg: Column, keys: list[str], delete_log: DataFrame,
                  expired: Column, row_bytes: int) -> DataFrame:
    """rows, bytes, deleted / expired rows and bytes, delete-log entries per segment."""
    log = delete_log.select(*keys).distinct().withColumn("_del", F.lit(True))
    j = base.select(seg.alias("seg"), *keys, expired.alias("_exp")).join(broadcast_if_small(log), keys, "left")
    d = F.coalesce(F.col("_del"), F.lit(False))
    e = F.coalesce(F.col("_exp"), F.lit(False))
    agg = j.groupBy("seg").agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.sum(F.when(d, 1).otherwise(0)).cast("long").alias("deleted_rows"),
        F.sum(F.when(e & ~d, 1).otherwise(0)).cast("long").alias("expired_rows"),
        F.sum(F.when(d, 1).otherwise(0)).cast("long").alias("delete_log_entries"))
    b = F.lit(row_bytes)
    return agg.select("seg", "num_rows", (F.col("num_rows") * b).alias("bytes"), "deleted_rows",
                      (F.col("deleted_rows") * b).alias("deleted_bytes"), "expired_rows",
                      (F.col("expired_rows") * b).alias("expired_bytes"), "delete_log_entries")


def compact(base: DataFrame, keys: list[str], delete_log: DataFrame, expired: Column) -> DataFrame:
    """Visible rows only: deletes anti-joined away, expired rows dropped; the
    caller writes the result with REBALANCE into fewer, larger files."""
    live = base.where(~F.coalesce(expired, F.lit(False)))
    return live.join(broadcast_if_small(delete_log.select(*keys).distinct()), keys, "left_anti")


def candidates(stats: DataFrame, *, max_log_entries: int, expired_ratio: float, max_expired_bytes: int,
               deleted_ratio: float, max_deleted_bytes: int, manual: list | None = None) -> DataFrame:
    """Segments that meet any trigger, with one boolean column per trigger."""
    n = F.col("num_rows").cast("double")
    s = stats.select(
        "seg",
        (F.col("delete_log_entries") > max_log_entries).alias("too_many_log_entries"),
        (F.col("expired_rows") / n >= expired_ratio).alias("expired_ratio_hit"),
        (F.col("expired_bytes") > max_expired_bytes).alias("expired_bytes_hit"),
        (F.col("deleted_rows") / n >= deleted_ratio).alias("deleted_ratio_hit"),
        (F.col("deleted_bytes") > max_deleted_bytes).alias("deleted_bytes_hit"),
        F.col("seg").isin(*(manual or [])).alias("manual"))
    flags = [c for c in s.columns if c != "seg"]
    any_hit = F.lit(False)
    for c in flags:
        any_hit = any_hit | F.col(c)
    return s.where(any_hit)


def small_file_groups(stats: DataFrame, expected_bytes: int, proportion: float, target_bytes: int,
                      partition: str | None = None) -> DataFrame:
    """Next-fit grouping of small segments: group = floor(running bytes / target).

    The window runs over the per-segment table (one row per file) within a
    table partition, never over rows."""
    small = stats.where(F.col("bytes") <= F.lit(expected_bytes * proportion))
    w = (Window.partitionBy(partition) if partition else Window.partitionBy(F.lit(0))).orderBy("seg") \
        .rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("bytes").over(w), F.lit(0))
    return small.select("seg", "bytes", F.floor(before / F.lit(target_bytes)).cast("long").alias("group_no"))
