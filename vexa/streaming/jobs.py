"""Continuous writes with Structured Streaming.

Every job reads Parquet files as they land (``maxFilesPerTrigger``), runs
with ``trigger(availableNow=True)`` so it ends when the backlog is done,
and writes through ``foreachBatch`` into an append-only table keyed by
``batchId``: a replayed batch overwrites its own slice, so the sink is
exactly-once although ``foreachBatch`` is at-least-once.  Checkpoints and
sinks live in the shared scratch folder.

Reads are merge-on-read: upserts resolve latest-wins over the change log,
deletes anti-join the delete log, TTL filters by the newest event time seen.
Per micro-batch cost is O(batch), never a rewrite of the whole table;
``operators.maintain.compact`` folds the logs later.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vexa.operators import dml as D
from vexa.session import scratch_path


def land_files(parts: list[DataFrame], landing: str) -> None:
    """Write each part as new files under ``landing`` (arrival order = list
    order); every part is written by as many tasks as it has partitions."""
    for p in parts:
        p.write.mode("append").parquet(landing)


def run_available_now(spark: SparkSession, landing: str, schema, on_batch: Callable[[DataFrame, int], None],
                      name: str, files_per_trigger: int = 4,
                      dedupe: tuple[list[str], str, str] | None = None, checkpoint: str | None = None) -> None:
    """A run that is given the ``checkpoint`` of an earlier one goes on where that ended.  ``dedupe = (keys, event_time_col, delay)`` drops repeated keys with
    ``dropDuplicatesWithinWatermark``: the watermark bounds the dedupe state.
    The delay must cover how far apart in event time a row and its replay can
    arrive; rows behind the watermark would count as late."""
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
              .parquet(landing))
    if dedupe is not None:
        keys, ts_col, delay = dedupe
        # watermarks need TIMESTAMP; zone-less event times are read as UTC
        stream = (stream.withColumn("_event_time", F.col(ts_col).cast("timestamp"))
                  .withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(keys)
                  .drop("_event_time"))
    q = (stream.writeStream.foreachBatch(on_batch)
         .option("checkpointLocation", checkpoint or scratch_path(spark, f"ckpt-{name}"))
         .trigger(availableNow=True).start())
    q.awaitTermination()


def batch_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Idempotent append: batch ``b`` always lands in ``path/batch_id=b``."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def run_arrivals(spark: SparkSession, parts: list[DataFrame], on_batch: Callable[[DataFrame, int], None], name: str,
                 files_per_trigger: int = 4) -> list[int]:
    """Land ``parts`` one after the other, each consumed before the next arrives, by one continued stream; returns the last batch
    of each arrival (that of the one before where a part is empty; -1 before the first)."""
    landing, checkpoint = scratch_path(spark, f"landing-{name}"), scratch_path(spark, f"ckpt-{name}")
    seen = [-1]

    def counted(df: DataFrame, batch_id: int) -> None:
        on_batch(df, batch_id)
        seen.append(batch_id)

    last = []
    for part in parts:
        land_files([part], landing)
        run_available_now(spark, landing, part.schema, counted, name, files_per_trigger, checkpoint=checkpoint)
        last.append(max(seen))
    return last


def stream_into_table(spark: SparkSession, parts: list[DataFrame], name: str,
                      dedupe: tuple[list[str], str, str] | None = None,
                      transform: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Land ``parts`` as files, stream them into a batch-keyed table, return it.
    ``transform`` is applied to each micro-batch before it is written."""
    landing, sink = scratch_path(spark, f"landing-{name}"), scratch_path(spark, f"sink-{name}")
    land_files(parts, landing)
    run_available_now(spark, landing, parts[0].schema, lambda df, b: batch_sink(sink)(transform(df), b), name, dedupe=dedupe)
    return spark.read.parquet(sink)


def upsert_view(log: DataFrame, keys: list[str], seq_col: str) -> DataFrame:
    """Latest-wins state of a streamed change log (order of batches irrelevant)."""
    return D.upsert_log(log.drop("batch_id"), keys, seq_col)


def delete_view(base: DataFrame, delete_log: DataFrame, keys: list[str], upto_batch: int | None = None) -> DataFrame:
    """Base minus deletes of batches <= ``upto_batch`` (a consistent prefix)."""
    log = delete_log if upto_batch is None else delete_log.where(F.col("batch_id") <= upto_batch)
    return D.delete_keys(base, log, keys)


def ttl_view(events: DataFrame, ts_col: str, ttl_seconds: int) -> DataFrame:
    """Rows within the TTL of the newest event time seen by the stream."""
    as_of = events.agg(F.max(ts_col)).first()[0]
    return D.ttl_filter(events.drop("batch_id"), ts_col, ttl_seconds, as_of)
