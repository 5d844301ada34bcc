"""Ordered export in batches by key position.

``KeysetExport`` lays (score, id) out once, range partitioned and sorted, with one row of statistics per range: rows and first key.
Batch n + 1 starts behind the last key of batch n: the statistics tell which ranges can hold its rows, only those
are read, and the rows behind the cursor are taken in order.  Nothing is numbered as a whole, and a batch costs the
rows of its own ranges.  ``write`` stores batch after batch and goes on behind the last one that is complete, whether it was
written by this run or by one that broke off.

Order: score (descending if so asked), then id; rows without a score come last, NaN before them.  Rows with equal score and id are
told apart by their place in the layout, so none is lost or repeated at a batch's edge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vexa.session import scratch_path


class KeysetExport:
    def __init__(self, scored: DataFrame, score_col: str, id_col: str, batch_size: int, ascending: bool = True,
                 ranges: int | None = None, chunk_rows: int = 100_000, layout: str | None = None):
        """``chunk_rows`` bounds the rows that one job orders and writes as a run of batches.  A ``layout`` folder that a run which broke
        off has completed is used again, so that rows of equal score and id keep their places."""
        spark = self.spark = scored.sparkSession
        self.score_col, self.id_col, self.batch_size = score_col, id_col, batch_size
        self.per_job = max(1, chunk_rows // batch_size)
        score = F.col(score_col).cast("double")
        # the sort key rises in export order; nulls get a flag of their own
        key = F.when(score.isNull(), 0.0).otherwise(score if ascending else -score)
        rows = scored.select(F.col(id_col), score.alias(score_col), score.isNull().alias("_null"), key.alias("_key"))
        n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
        order = ["_null", "_key", id_col]
        path = layout or scratch_path(spark, "export-layout")
        tied = rows.withColumn("_tie", F.monotonically_increasing_id())
        if not _exists(spark, f"{path}/_SUCCESS"):
            (tied.repartitionByRange(n, *order, "_tie").sortWithinPartitions(*order, "_tie")
             .withColumn("_range", F.spark_partition_id()).write.mode("overwrite").partitionBy("_range").parquet(path))
        self._order = [*order, "_tie"]
        schema = T.StructType([*tied.schema.fields, T.StructField("_range", T.IntegerType())])
        self.layout = spark.read.schema(schema).parquet(path)
        stats = (self.layout.groupBy("_range").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*self._order)).alias("first"))
                 .orderBy("_range").collect())  # one row per range
        self._ranges = [(r["_range"], r.n, tuple(r["first"])) for r in stats]
        self.total = sum(n for _, n, _ in self._ranges)

    def _behind(self, cursor: tuple):
        """The rows behind a key, as a condition."""
        out = F.lit(False)
        for i in reversed(range(len(self._order))):
            c, v = F.col(self._order[i]), cursor[i]
            out = (c.isNotNull() | out) if v is None else F.coalesce(c > v, F.lit(False)) | (c.eqNullSafe(F.lit(v)) & out)
        return out

    def rows_behind(self, cursor: tuple | None, n: int) -> DataFrame | None:
        """The next ``n`` rows in order, with their keys; None at the end."""
        start = 0
        if cursor is not None:
            while start + 1 < len(self._ranges) and self._key(self._ranges[start + 1][2]) <= self._key(cursor):
                start += 1
        end, sure = start, 0
        while end < len(self._ranges) and sure < n:
            # the range of the cursor may have nothing behind it
            sure += self._ranges[end][1] if cursor is None or end > start else 0
            end += 1
        if start >= len(self._ranges):
            return None
        part = self.layout.filter(F.col("_range").isin([r for r, _, _ in self._ranges[start:end]]))
        if cursor is not None:
            part = part.filter(self._behind(cursor))
        return part.orderBy(*self._order).limit(n)

    @staticmethod
    def _key(key: tuple) -> tuple:
        """Spark's order of keys for Python: NaN after all numbers, a null id first."""
        null, score, ident, tie = key
        return (null, score != score, 0.0 if score != score else score, ident is not None, ident if ident is not None else 0, tie)

    def write(self, path: str, limit: int | None = None) -> int:
        """Write batches below ``path`` until ``limit`` rows are there, behind those already complete; returns the number of batches."""
        limit = self.total if limit is None else min(limit, self.total)
        batch, cursor = self._written(path)
        while batch * self.batch_size < limit:
            n = min(self.per_job * self.batch_size, limit - batch * self.batch_size)
            part = self.rows_behind(cursor, n)
            at = F.monotonically_increasing_id() + batch * self.batch_size  # the ordered rows of a limit are one partition
            out = (part.withColumn("rn", at + 1).withColumn("batch_no", F.floor((F.col("rn") - 1) / self.batch_size).cast("long"))
                   .select("batch_no", "rn", self.id_col, self.score_col, "_null", "_key", "_tie"))
            out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_no").parquet(path)
            batch += -(-n // self.batch_size)
            cursor = self._last_key(path, batch - 1)
        return batch

    def _last_key(self, path: str, batch: int) -> tuple:
        last = exported(self.spark, path).filter(F.col("batch_no") == batch).orderBy(F.col("rn").desc()).first()
        return tuple(last[c] for c in self._order)

    def _written(self, path: str) -> tuple[int, tuple | None]:
        """Complete batches from the first on, and the key of their last row."""
        done = exported(self.spark, path)
        if done is None:
            return 0, None
        sizes = {r.batch_no: r.n for r in done.groupBy("batch_no").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per batch
        full = 0
        while sizes.get(full) == self.batch_size or (full in sizes and full * self.batch_size + sizes[full] == self.total):
            full += 1
        return (full, self._last_key(path, full - 1)) if full else (0, None)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def exported(spark: SparkSession, path: str) -> DataFrame | None:
    """The batches written so far; None if there are none."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p) or not any(s.getPath().getName().startswith("batch_no=") for s in fs.listStatus(p)):
        return None
    return spark.read.parquet(path)
