"""Global row numbers and running offsets without a single-partition window.

``row_number() over (order by ...)`` with no partition key pulls every row
into one task.  Instead: range-partition on the order key, sort within
partitions, tag rows with their partition and in-partition position,
checkpoint (lineage cut, reliable), count rows per partition (one row per
partition reaches the driver), and add the running offsets back through a
join with that small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOW = (1 << 33) - 1


def global_row_number(df: DataFrame, order: list[Column], name: str = "rn",
                      num_partitions: int | None = None) -> DataFrame:
    from vexa.session import checkpoint_root
    spark = df.sparkSession
    checkpoint_root(spark)  # reliable checkpoints need the shared folder
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    tagged = ranged.withColumn("_mid", F.monotonically_increasing_id())
    tagged = tagged.checkpoint(eager=True)
    part = F.shiftright(F.col("_mid"), 33)
    counts = sorted(tuple(r) for r in tagged.groupBy(part.alias("_p")).count().collect())
    offs, run = [], 0
    for p, c in counts:
        offs.append((int(p), int(run)))
        run += c
    off_df = spark.createDataFrame(offs, T.StructType([
        T.StructField("_p", T.LongType()), T.StructField("_off", T.LongType())]))
    out = tagged.withColumn("_p", part).join(F.broadcast(off_df), "_p")  # one row per partition
    return (out.withColumn(name, F.col("_off") + F.col("_mid").bitwiseAND(F.lit(_LOW)) + 1)
            .drop("_p", "_off", "_mid"))


def batch_number(rn: Column, batch_size: int) -> Column:
    return F.floor((rn - 1) / F.lit(batch_size)).cast("long")
