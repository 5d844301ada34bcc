"""Search results kept up to date while rows arrive and go.

``KeptHits`` holds, for a bounded set of queries, the best ``k + spare`` rows per query as a small table per version.  A batch of new
rows is searched on its own, and its hits are merged with those of the version before; the rows that arrived earlier are not read again.
A batch of deletions takes its ids out of the lists; a query left with fewer than ``k`` hits is refilled by one search
over the rows that remain, all others are not searched.

Every version stays readable, so a reader gets the answer as of batch b while later batches land.  A version is
computed from the one before it and overwrites only itself: a replayed batch changes nothing.  Batch numbers rise by the order in which
batches are applied; additions and deletions may share the numbers of one stream.

A list is always the exact top of the live rows as far as it reaches: after merging it is cut to the length up to which it is known to
be complete, and ``complete`` says that it holds every live row that matches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vexa.functions.vectors import ASCENDING
from vexa.operators.dml import delete_keys
from vexa.operators.knn import top_k


class KeptHits:
    def __init__(self, spark: SparkSession, queries: DataFrame, path: str, *, id_col: str, vec_col: str, k: int = 10, spare: int = 10,
                 metric: str = "L2"):
        self.spark, self.queries, self.path = spark, queries, path.rstrip("/")
        self.id_col, self.vec_col, self.k, self.keep, self.metric = id_col, vec_col, k, k + spare, metric.upper()

    def _versions(self) -> list[int]:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return []
        done = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("version=")]
        return sorted(int(d.getName()[len("version="):]) for d in done if fs.exists(jvm.org.apache.hadoop.fs.Path(d, "_SUCCESS")))

    def _order(self):
        score = F.col("score").asc() if ASCENDING[self.metric] else F.col("score").desc()
        return Window.partitionBy("qid").orderBy(score, F.col(self.id_col).asc())

    def _state(self, before: int | None, id_type: T.DataType) -> DataFrame:
        """(qid, id, score, complete) of the last version below ``before``."""
        schema = T.StructType([self.queries.schema["qid"], T.StructField(self.id_col, id_type), T.StructField("score", T.DoubleType()),
                               T.StructField("complete", T.BooleanType())])
        known = [v for v in self._versions() if before is None or v < before]
        if not known:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/version={known[-1]}")

    def _write(self, state: DataFrame, version: int) -> None:
        state.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/version={version}")  # queries x (k + spare) rows

    def _search(self, rows: DataFrame, queries: DataFrame) -> DataFrame:
        return top_k(rows, queries, k=self.keep, metric=self.metric, id_col=self.id_col, vec_col=self.vec_col).drop("rank")

    def add(self, rows: DataFrame, version: int) -> None:
        """Rows that arrived with this batch; their ids are new."""
        held = self._state(version, rows.schema[self.id_col].dataType)
        found = self._search(rows, self.queries)
        both = held.withColumn("new", F.lit(0)).unionByName(found.withColumn("complete", F.lit(True)).withColumn("new", F.lit(1)))
        of_query = Window.partitionBy("qid")
        n_held, n_new = F.sum(1 - F.col("new")).over(of_query), F.sum("new").over(of_query)
        complete = F.bool_and("complete").over(of_query)
        ranked = (both.withColumn("n_held", n_held).withColumn("n_new", n_new).withColumn("was", complete)
                  .withColumn("rn", F.row_number().over(self._order())))
        # beyond the length of an incomplete list older rows may be missing
        reach = F.when(F.col("was"), F.lit(self.keep)).otherwise(F.col("n_held"))
        whole = F.col("was") & (F.col("n_held") + F.col("n_new") < self.keep)
        self._write(ranked.filter(F.col("rn") <= reach).select("qid", self.id_col, "score", whole.alias("complete")), version)

    def remove(self, ids: DataFrame, version: int, live: DataFrame) -> None:
        """Rows that went with this batch; ``live`` is the table without them, read only for queries that run short."""
        held = self._state(version, live.schema[self.id_col].dataType)
        left = delete_keys(held, ids.select(self.id_col), [self.id_col])
        counts = left.groupBy("qid").agg(F.count(F.lit(1)).alias("n"))
        was = held.groupBy("qid").agg(F.bool_and("complete").alias("whole"))
        short = was.join(counts, "qid", "left").filter(~F.col("whole") & (F.coalesce("n", F.lit(0)) < self.k)).select("qid")
        short = [r.qid for r in short.collect()]  # at most one row per query
        if short:
            again = self._search(live, self.queries.filter(F.col("qid").isin(short)))
            n = F.count(F.lit(1)).over(Window.partitionBy("qid"))
            left = left.filter(~F.col("qid").isin(short)).unionByName(again.withColumn("complete", n < self.keep))
        self._write(left, version)

    def at(self, version: int | None = None, id_type: T.DataType = T.LongType()) -> DataFrame:
        """(qid, id, score, rank): the answer as of a batch, by default the last one."""
        state = self._state(None if version is None else version + 1, id_type)
        return (state.withColumn("rank", F.row_number().over(self._order()).cast("long")).filter(F.col("rank") <= self.k)
                .select("qid", self.id_col, "score", "rank"))
