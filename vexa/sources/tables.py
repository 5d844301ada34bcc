"""Partitioned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_partitioned(df: DataFrame, path: str, col: str, mode: str = "overwrite",
                      max_records_per_file: int = 1_000_000) -> None:
    """Write ``df`` partitioned by ``col``.

    REBALANCE on the partition column lets AQE split a value that holds a
    large share of the rows over several tasks instead of one.
    """
    (df.hint("rebalance", col).write.mode(mode)
       .option("maxRecordsPerFile", max_records_per_file)
       .partitionBy(col).parquet(path))
