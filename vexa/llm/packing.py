"""Variable-capacity best-fit packing (operator 5).

Texts of known length are cut into pieces of at most the largest permitted sequence
length and packed into sequences ("bins") of several permitted lengths.  A bin of
capacity c costs c + ``overhead``.  Pieces are placed longest first, each into the open bin that it fills
best (among bins of equal room the one opened last).  Where none has room, a bin is opened: every permitted size is filled in thought with
the largest pieces still to come that fit, and the size of the least cost per token is opened, the smaller one if two
are equal.  Finally each bin is downsized to the smallest permitted capacity that holds its contents.

Pieces are dealt to shards by a hash of their identity (with a number of the row where ids repeat or are null), about ``shard_pieces`` each (a
documented parameter: bins are never shared between shards, so the loss is at most the last
open bins of each shard).  Every shard is packed in one task whose memory is bounded by it; a hot
source or a frequent length is spread like any other row.

The lengths are written once, so that whatever computes them (reading the texts) runs once.  A null or negative length counts as 0.  Texts of length 0 are one empty piece in a bin of their
shard (they take no room).  Repeated rows are packed separately.  Other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vexa.llm import common as C

CAPACITIES = (512, 1024, 2048, 4096)


def _least_cost(i: int, neg: np.ndarray, caps: np.ndarray, overhead: int) -> int:
    """Capacity to open for piece ``i``; ``neg`` holds the falling sizes, negated.  For each permitted one, its cost per token when filled by the
    largest pieces still to come that fit, and downsized to what they leave.  Ties go to the smaller one."""
    best, chosen = None, 0
    n = -int(neg[i])
    for c in caps[np.searchsorted(caps, n):].tolist():
        free, at = c - n, i + 1
        while free and at < len(neg):
            # the first piece behind ``at`` that is no larger than the room
            at += int(neg[at:].searchsorted(-free))
            if at == len(neg) or not neg[at]:
                break
            free += int(neg[at])
            at += 1
        used = c - free
        cost = (int(caps[np.searchsorted(caps, used)]) + overhead) / max(used, 1)
        if best is None or cost < best:
            best, chosen = cost, c
    return chosen


def pack(size: np.ndarray, capacities: tuple[int, ...] = CAPACITIES, overhead: int = 16):
    """(bin, offset, capacity of the bin) for every piece; sizes must fall."""
    caps = np.array(sorted(capacities), np.int64)
    bins: list[int] = []       # tokens in each bin
    room: dict[int, list[int]] = {}  # bins by free room
    rooms: list[int] = []      # the rooms that occur, ascending
    where, offset, neg = np.empty(len(size), np.int64), np.empty(len(size), np.int64), -size
    for i, n in enumerate(size.tolist()):
        at = bisect_left(rooms, n)
        if at < len(rooms):
            free = rooms[at]
            same = room[free]
            b = same.pop()
            if not same:
                del room[free]
                del rooms[at]
        else:
            b, free = len(bins), _least_cost(i, neg, caps, overhead)
            bins.append(0)
        where[i], offset[i] = b, bins[b]
        bins[b] += n
        left = free - n
        if left or not n:
            if left not in room:
                room[left] = []
                insort(rooms, left)
            room[left].append(b)
    final = caps[np.searchsorted(caps, np.array(bins, np.int64))] if bins else caps[:0]
    return where, offset, final[where] if len(where) else where


def _numbered(lengths: DataFrame, id_col: str) -> DataFrame:
    """``lengths`` plus ``_row``, which tells rows of one id apart: 0 where ids are unique and not null, else a
    number of the row, written once."""
    per_id = lengths.groupBy(id_col).agg(F.count(F.lit(1)).alias("n"))
    if not per_id.filter(F.col(id_col).isNull() | (F.col("n") > 1)).limit(1).count():
        return lengths.withColumn("_row", F.lit(0).cast("long"))
    return C.save(lengths.withColumn("_row", F.monotonically_increasing_id()), "lengths")


def _pieces(lengths: DataFrame, id_col: str, length_col: str, longest: int, shards: int) -> DataFrame:
    n = F.greatest(F.coalesce(F.col(length_col), F.lit(0)).cast("long"), F.lit(0).cast("long"))
    return (_numbered(lengths, id_col).select(F.col(id_col).alias("id"), n.alias("n"), "_row")
            .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(
                F.ceil(F.col("n") / longest) - 1, F.lit(0).cast("long")))))
            .select("id", "_row", "piece", (F.col("piece") * longest).alias("start"),
                    F.least(F.col("n") - F.col("piece") * longest, F.lit(longest)).cast("long").alias("size"))
            .withColumn("shard", F.pmod(F.xxhash64("id", "_row", "piece"), F.lit(shards))))


def best_fit(lengths: DataFrame, id_col: str, length_col: str, capacities: tuple[int, ...] = CAPACITIES,
             overhead: int = 16, shard_pieces: int = 20_000) -> DataFrame:
    """One row per piece: (``id_col``, piece, start, size, bin, capacity, offset).

    A bin is named by its shard and number; rows of one bin fill it from offset 0."""
    longest = max(capacities)
    lengths = C.save(lengths.select(id_col, length_col), "packing-lengths")
    kinds = dict(lengths.dtypes)
    n = F.greatest(F.coalesce(F.col(length_col), F.lit(0)).cast("double"), F.lit(1.0))
    total = lengths.agg(F.sum(F.ceil(n / longest))).first()[0] or 0
    shards = max(1, -(-int(total) // shard_pieces))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in C.by_group(batches, ["shard"]):
            size = C.longs(t, "size")
            where, offset, capacity = pack(size, capacities, overhead)
            shard = C.longs(t, "shard")
            yield pa.RecordBatch.from_arrays(
                [*(t.column(c).combine_chunks() for c in ("id", "piece", "start", "size")), pa.array((shard << 32) | where),
                 pa.array(capacity), pa.array(offset)], ["id", "piece", "start", "size", "bin", "capacity", "offset"])

    pieces = _pieces(lengths, id_col, length_col, longest, shards)
    rows = pieces.repartition(min(shards, C.shuffle_partitions(lengths.sparkSession)), "shard").sortWithinPartitions(
        "shard", F.desc("size"), F.asc_nulls_last("id"), "_row", "piece")
    return (rows.mapInArrow(run, f"id {kinds[id_col]}, piece long, start long, size long, bin long, capacity long, offset long")
            .withColumnRenamed("id", id_col))
