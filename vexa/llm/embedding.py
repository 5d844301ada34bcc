"""Near-duplicate vectors by random-hyperplane signs in several tables (operator 8).

Equal vectors are one class with a weight, so copies of a vector are never paired.  Each class is
hashed by the signs of ``bits`` random projections in each of the tables.  Two vectors at an
angle t agree on a sign with probability 1 - t/pi; the number of tables follows from
``bits`` so that a pair at the threshold meets in some table with probability ``recall``, and
``bits`` grows with the number of vectors so that a bucket stays near ``bucket_rows`` vectors
where the data are spread.  A bucket above ``block_rows`` is cut into blocks, and each pair of blocks
is one unit of work, so a crowded direction is spread over tasks.

A unit computes exact cosines in double precision.  A pair is counted in the first table
in which it meets, so that no pair is emitted: a unit returns the number of links by vector and
a spanning forest of its links, and connected components are distributed.

Vectors that are null, empty, zero or hold null or non-finite numbers link with nothing; vectors
of different lengths never link.  Repeated ids are separate rows whose component is the smallest id;
a null id sorts last.  Other columns, labels included, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vexa.llm import common as C
from vexa.llm.components import connected_components


def plan(rows: int, threshold: float, recall: float, bucket_rows: int) -> tuple[int, int]:
    """(bits per table, tables) for a number of vectors."""
    bits = min(60, max(8, math.ceil(math.log2(max(rows, 1) / bucket_rows))))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(_uid, v): the vectors that can link, in double precision."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))
    return (vectors.filter(fine).select(C.UID, v.alias("v"))
            .filter(F.exists("v", lambda x: x != 0.0)))


def _matrix(col) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return np.stack([np.frombuffer(b.as_buffer(), np.float64) for b in col]) if len(col) else np.zeros((0, 0))


def classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows as (_uid, rep) and classes as (rep, weight, dim, v) with ``v`` packed as bytes.

    Zero is written without sign first, so that equal vectors have equal bytes."""
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column(1)
            flat = np.ascontiguousarray(v.flatten().to_numpy(zero_copy_only=False), np.float64) + 0.0
            offs = np.concatenate([[0], np.cumsum(np.asarray(v.value_lengths(), np.int64))]) if b.num_rows else np.zeros(1, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), C.binary_column(flat.view(np.uint8), offs * 8)], ["_uid", "v"])

    rows = C.save(vectors.mapInArrow(packed, "_uid long, v binary"), "vectors")
    groups = rows.groupBy("v").agg(F.min("_uid").alias("rep"), F.count(F.lit(1)).alias("weight"))
    reps = C.save(groups.select("rep", "weight", F.octet_length("v").alias("dim"), "v"), "classes")
    return rows.join(reps.select("rep", "v"), "v").select("_uid", "rep"), reps


def _tables(reps: DataFrame, bits: int, tables: int, seed: int = 17) -> DataFrame:
    """(rep, keys): bucket of each table, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for b in batches:
            dims = C.longs(b, "dim")
            rep, out = C.longs(b, "rep"), np.zeros((b.num_rows, tables), np.int64)
            for dim in np.unique(dims):
                n = int(dim) // 8
                if n not in planes:
                    planes[n] = np.random.default_rng([seed, n]).normal(size=(n, tables * bits))
                at = np.flatnonzero(dims == dim)
                m = _matrix(b.column(b.schema.get_field_index("v")).take(pa.array(at)))
                sign = (m @ planes[n] > 0).reshape(len(at), tables, bits)
                out[at] = sign @ (np.int64(1) << np.arange(bits, dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rep), C.binary_column(out.view(np.uint8).ravel(), np.arange(b.num_rows + 1) * 8 * tables)],
                ["rep", "keys"])

    return reps.select("rep", "dim", "v").mapInArrow(run, "rep long, keys binary")


def _unit(t: pa.Table, threshold: float, at_once: int = 512):
    """Links of one pair of blocks: (rep, links) and a spanning forest."""
    rep, block, weight = C.longs(t, "rep"), C.longs(t, "block"), C.longs(t, "weight")
    table = int(C.longs(t, "tab")[0])
    cross = bool(C.longs(t, "bi")[0] != C.longs(t, "bj")[0])
    m = _matrix(t.column("v"))
    m = m / np.abs(m).max(axis=1, keepdims=True)  # no overflow in the squares
    m = m / np.sqrt(np.einsum("ij,ij->i", m, m))[:, None]
    keys = C.ragged(t.column("keys").combine_chunks(), np.int64)[0].reshape(len(rep), -1)
    n = len(rep)
    links, label = np.zeros(n, np.int64), np.arange(n)
    for lo in range(0, n, at_once):
        part = slice(lo, min(lo + at_once, n))
        near = m[part] @ m.T >= threshold
        near[np.arange(part.stop - lo), np.arange(lo, part.stop)] = False
        if cross:
            near &= block[part, None] != block[None, :]
        i, j = np.nonzero(near)
        i += lo
        # met already in an earlier table: counted and linked there
        for k in range(table):
            fresh = keys[i, k] != keys[j, k]
            i, j = i[fresh], j[fresh]
        np.add.at(links, i, weight[j])
        while True:  # join the labels of this strip's links
            low = np.minimum(label[i], label[j])
            before = label.copy()
            np.minimum.at(label, label[i], low)
            np.minimum.at(label, label[j], low)
            label = label[label]
            if (label == before).all():
                break
    while (label[label] != label).any():
        label = label[label]
    return rep, links, label


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.9,
                 recall: float = 0.9999, bucket_rows: int = 256, block_rows: int = 2048) -> DataFrame:
    """One row per row of ``vectors`` (which has ``_uid``): (_uid, n_links, component, kept)."""
    spark = vectors.sparkSession
    rows, reps = classes(usable(vectors, id_col, vec_col))
    bits, tables = plan(reps.count(), threshold, recall, bucket_rows)
    keyed = C.save(reps.join(_tables(reps, bits, tables), "rep"), "hashed")

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            keys = C.ragged(b.column(b.schema.get_field_index("keys")), np.int64)[0]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(C.longs(b, "rep"), tables)),
                                              pa.array(np.repeat(C.longs(b, "dim"), tables).astype(np.int32)),
                                              pa.array(np.tile(np.arange(tables, dtype=np.int32), n)), pa.array(keys)],
                                             ["rep", "dim", "tab", "key"])

    posted = keyed.select("rep", "dim", "keys").mapInArrow(post, "rep long, dim int, tab int, key long")
    sizes = (posted.groupBy("dim", "tab", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
             .withColumn("blocks", F.ceil(F.col("n") / block_rows).cast("int")))
    placed = (posted.join(sizes, ["dim", "tab", "key"])
              .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("rep", "dim", "tab", "key", "block", F.least("block", "other").alias("bi"),
                      F.greatest("block", "other").alias("bj")))
    units = placed.join(keyed.select("rep", "weight", "v", "keys"), "rep")
    unit = ["dim", "tab", "key", "bi", "bj"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in C.by_group(batches, unit):
            rep, links, label = _unit(t, threshold)
            some = np.flatnonzero(links > 0)
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array(rep[some]), pa.array(links[some]), pa.array(rep[label[some]])],
                                                 ["rep", "links", "near"])

    found = C.save(units.repartition(C.shuffle_partitions(spark), *unit).sortWithinPartitions(*unit)
                   .mapInArrow(run, "rep long, links long, near long"), "links")
    comp = connected_components(found.select("rep", "near"), "rep", "near").select(F.col("node").alias("rep"), "component")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    per_class = (reps.select("rep", "weight").join(links, "rep", "left").join(comp, "rep", "left")
                 .select("rep", (F.coalesce("links", F.lit(0).cast("long")) + F.col("weight") - 1).alias("n_links"),
                         F.coalesce("component", "rep").alias("component")))
    linked = rows.join(per_class, "rep").select("_uid", "n_links", "component")
    return (vectors.select(C.UID).join(linked, C.UID, "left")
            .select(C.UID, F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                    F.coalesce("component", C.UID).alias("component"))
            .withColumn("kept", F.col(C.UID) == F.col("component")))
