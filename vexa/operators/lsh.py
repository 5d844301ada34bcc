"""Approximate neighbours by hashing, with probing of neighbouring buckets.

Dense vectors.  Each of ``tables`` hash tables projects a vector on ``bits`` orthonormal random directions; bit j is set if the
projection exceeds the sample's median, so that buckets are of like size whatever the data's scale.  A query probes,
besides its own bucket, those that differ in bits whose projections lie near the median: bucket b costs the sum of the squared distances
(in units of the projection's spread) of the query to the edges it would have to cross, and all buckets of cost up to ``reach`` are
probed, cheapest first.  A row met in some table becomes a candidate (qid, row); the signs of ``SKETCH_BITS`` further projections are then
compared with the query's, and pairs that differ in more than ``differ`` of them are dropped.  Only what is left is scored exactly.

``reach`` and ``differ`` are learnt from the data: for a sample of rows the true neighbours are computed, and each bound is the
smallest that keeps the share ``target`` of them.  Nothing is absolute, and no threshold on distances is applied.

Bit vectors (Jaccard).  A table's key combines ``bits`` min-hashes of the positions of the set bits; every min-hash has its own
permutation.  Rows that share a key in some table are candidates, and pairs with fewer equal min-hashes than a learnt number are dropped.

Plan.  The buckets that the queries probe are broadcast (bounded passes of queries); a task looks its rows' buckets up, forms and
filters candidates, scores them, and returns k rows per query.  No candidate is shuffled and no bucket gathered, so a crowded bucket
is spread over the tasks that hold its rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vexa.operators.ivf import Tops, _pass_queries, _rows_of, _sample, _steps, _valid
from vexa.operators.knn import BLOCK_CELLS, _arrow_type, query_passes, top_k

SAMPLE_QUERIES = 96
SKETCH_BITS = 512


@dataclass
class SignTables:
    """Hash tables of a table of vectors; ``reach`` and ``differ`` bound what is probed and compared."""

    planes: np.ndarray   # [table, dimension, bit]
    middle: np.ndarray   # [table, bit]
    spread: np.ndarray   # [table, bit]
    sketch: np.ndarray   # [dimension, bit]
    centre: np.ndarray   # of the vectors, from which the sketch looks
    reach: float = math.inf
    differ: int = 1 << 30

    def project(self, x: np.ndarray) -> np.ndarray:
        """[row, table, bit]: distance to the bit's edge in units of its spread."""
        return (np.einsum("nd,tdb->ntb", x, self.planes, optimize=True) - self.middle) / self.spread

    def keys(self, y: np.ndarray) -> np.ndarray:
        return (y > 0) @ (np.int64(1) << np.arange(y.shape[2], dtype=np.int64))

    def words(self, x: np.ndarray) -> np.ndarray:
        """[row, word]: the sketch of each row, packed into 64-bit words."""
        return np.ascontiguousarray(np.packbits((x - self.centre) @ self.sketch > 0, axis=1, bitorder="little")).view(np.uint64)

    def probes(self, y: np.ndarray) -> Iterator[tuple[int, int]]:
        """(table, bucket) of every bucket within reach of one query [table, bit]."""
        for t, cost in enumerate(y * y):
            own = int((y[t] > 0) @ (np.int64(1) << np.arange(len(cost), dtype=np.int64)))
            order = np.argsort(cost, kind="stable")
            found = [(0.0, own)]
            for bit in order:  # sets of edges to cross whose costs add up to the reach at most
                if cost[bit] > self.reach:
                    break
                found += [(c + cost[bit], b ^ (1 << int(bit))) for c, b in found if c + cost[bit] <= self.reach]
            for _, b in found:
                yield t, b

    def costs(self, yq: np.ndarray, yx: np.ndarray) -> np.ndarray:
        """Least cost over the tables of the buckets of rows ``yx`` for one query each."""
        return ((yq * yq) * ((yq > 0) != (yx > 0))).sum(axis=2).min(axis=1)


def _differ(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=1)


def learn(df: DataFrame, id_col: str, vec_col: str, *, k: int = 10, target: float = 0.97, tables: int = 32, bits: int | None = None,
          seed: int = 42) -> SignTables | None:
    """Tables for the rows of ``df``: edges from a bounded sample, bounds from the true neighbours of ``SAMPLE_QUERIES`` rows.

    ``bits`` is by default such that a bucket holds about eight rows where the data are spread."""
    spark = df.sparkSession
    first = df.filter(F.col(vec_col).isNotNull()).groupBy(F.size(vec_col).alias("d")).count().orderBy(F.col("count").desc(), "d").first()
    if first is None or not first.d:
        return None
    dim = first.d
    good = df.filter(_valid(df, vec_col, dim))
    n = good.count()
    if not n:
        return None
    sample = _sample(spark, good, id_col, vec_col, dim, n)
    bits = bits or int(min(24, max(4, math.log2(max(n / 8, 1)))))
    rng = np.random.default_rng(seed)
    width = min(bits, dim)
    planes = np.stack([np.linalg.qr(rng.normal(size=(dim, dim if dim <= 512 else bits)))[0][:, :width] for _ in range(tables)])
    made = SignTables(planes, np.zeros((tables, width)), np.ones((tables, width)), rng.normal(size=(dim, SKETCH_BITS)), sample.mean(axis=0))
    y = made.project(sample)
    made.middle, made.spread = np.median(y, axis=0), np.maximum(y.std(axis=0), 1e-300)
    q = good.orderBy(F.xxhash64(id_col, F.lit("learn")), id_col).limit(SAMPLE_QUERIES).select(F.col(id_col).alias("qid"), F.col(vec_col).alias("qv"))
    drawn = q.collect()
    near = top_k(good, spark.createDataFrame(drawn, q.schema), k=k + 1, id_col=id_col, vec_col=vec_col).filter(F.col("qid") != F.col(id_col))
    pairs = near.join(good.select(id_col, F.col(vec_col).alias("xv")), id_col).select("qid", "xv").collect()  # queries x k
    if not pairs:
        return made
    at = {r.qid: r.qv for r in drawn}
    xq, xx = np.array([at[p.qid] for p in pairs], np.float64), np.array([p.xv for p in pairs], np.float64)
    cost, apart = made.costs(made.project(xq), made.project(xx)), _differ(made.words(xq), made.words(xx))
    last = min(len(pairs) - 1, math.ceil(target * len(pairs)))
    made.reach, made.differ = float(np.sort(cost)[last]) * (1 + 1e-12), int(np.sort(apart)[last])
    return made


def search(df: DataFrame, queries: DataFrame, tables: SignTables | None, *, id_col: str, vec_col: str, k: int = 10, scored=None) -> DataFrame:
    """(qid, id, score, rank) of the best k candidates by squared distance, ties by id; ``scored`` counts the exact scores."""
    spark = df.sparkSession
    qid_type, id_type = queries.schema["qid"].dataType, df.schema[id_col].dataType
    out_type = T.StructType([T.StructField("qid", qid_type), T.StructField(id_col, id_type), T.StructField("score", T.DoubleType())])
    found = None
    if tables is not None:
        dim = tables.planes.shape[1]
        rows = df.select(id_col, vec_col).filter(_valid(df, vec_col, dim) & F.col(id_col).isNotNull())
        for qpass in query_passes(queries.filter(F.col("qv").isNotNull()).select("qid", "qv"), "qid", dim, max_queries_per_pass=512):
            qids, q = _pass_queries(qpass, dim)
            y = tables.project(q)
            lists = _lists((t, b, i) for i in range(len(q)) for t, b in tables.probes(y[i]))
            shared = spark.sparkContext.broadcast((qids, q, tables.words(q), lists, tables))
            part = rows.mapInArrow(_sign_scan(shared, id_col, vec_col, dim, k, _arrow_type(qid_type), _arrow_type(id_type), scored), out_type)
            found = part if found is None else found.unionByName(part)
    return _ranked(spark.createDataFrame([], out_type) if found is None else found, id_col, k)


def _ranked(found: DataFrame, id_col: str, k: int) -> DataFrame:
    best = Window.partitionBy("qid").orderBy("score", F.col(id_col).asc())
    return found.withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= k)


def _lists(probes) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per table: sorted buckets, and where each one's queries lie in the list of queries."""
    p = np.array(sorted(probes), np.int64).reshape(-1, 3)
    out = []
    for t in range(int(p[:, 0].max()) + 1 if len(p) else 0):
        own = p[p[:, 0] == t]
        buckets, first = np.unique(own[:, 1], return_index=True)
        out.append((buckets, np.append(first, len(own)), own[:, 2]))
    return out


def _met(keys: np.ndarray, lists, queries: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (query, row) pairs whose row lies in a probed bucket of some table."""
    got = []
    for t, (buckets, first, who) in enumerate(lists):
        if not len(buckets):
            continue
        at = np.minimum(np.searchsorted(buckets, keys[:, t]), len(buckets) - 1)
        row = np.flatnonzero(buckets[at] == keys[:, t])
        n = first[at[row] + 1] - first[at[row]]
        pos = np.repeat(first[at[row]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        got.append(who[pos] * len(keys) + np.repeat(row, n))
    pairs = np.unique(np.concatenate(got)) if got else np.zeros(0, np.int64)
    return pairs // max(len(keys), 1), pairs % max(len(keys), 1)


def _sign_scan(shared, id_col: str, vec_col: str, dim: int, k: int, qid_type, id_type, scored):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, q, words, lists, tables = shared.value
        tops = Tops(1, len(q), k)
        everyone = np.arange(len(q))
        width = len(lists) * tables.planes.shape[2]
        for b in batches:
            if not b.num_rows:
                continue
            ids_all, x_all = b.column(0).to_numpy(zero_copy_only=False), _rows_of(b, vec_col, dim)
            for s in _steps(b.num_rows, dim + width, len(q)):
                x, ids = x_all[s], ids_all[s]
                y = tables.project(x)
                i, j = _met(tables.keys(y), lists, len(q))
                near = _differ(words[i], tables.words(x)[j]) <= tables.differ
                i, j = i[near], j[near]
                if scored is not None:
                    scored.add(len(i))
                keys = np.full((len(q), len(x)), np.inf)
                step = max(1, BLOCK_CELLS // dim)
                for lo in range(0, len(i), step):
                    a, z = i[lo:lo + step], j[lo:lo + step]
                    d = q[a] - x[z]
                    keys[a, z] = np.einsum("ij,ij->i", d, d)
                tops.add(0, everyone, keys, ids)
        _, qi, key, ids = tops.rows()
        yield pa.RecordBatch.from_arrays([pa.array([qids[i] for i in qi], qid_type), pa.array(ids, id_type), pa.array(key)], ["qid", id_col, "score"])

    return run


# --- bit vectors -------------------------------------------------------------------------------

@dataclass
class MinHashTables:
    """Min-hash tables over the positions of set bits, ``bits`` min-hashes a table; pairs need ``equal`` equal min-hashes."""

    dim: int
    orders: np.ndarray   # [hash, position]: rank of the position in the hash's permutation
    tables: int
    equal: int = 0

    def signatures(self, bits: np.ndarray) -> np.ndarray:
        """[row, hash]; -1 for a row without set bits."""
        out = np.empty((len(bits), len(self.orders)), np.int32)
        for h, order in enumerate(self.orders):
            ranked = bits[:, np.argsort(order)]
            out[:, h] = np.where(ranked.any(axis=1), ranked.argmax(axis=1), -1)
        return out

    def keys(self, sig: np.ndarray) -> np.ndarray:
        per = sig.reshape(len(sig), self.tables, -1).astype(np.int64)
        key = np.zeros(per.shape[:2], np.int64)
        for i in range(per.shape[2]):
            key = key * (self.dim + 2) + per[:, :, i] + 1
        return key


def unpacked(words: np.ndarray) -> np.ndarray:
    """[row, bit] of packed 64-bit words."""
    return np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=1, bitorder="little").astype(bool)


def jaccard_keys(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Jaccard distances of pairs of packed rows, 0 for two empty ones."""
    both = np.bitwise_count(q & x).sum(axis=1).astype(np.float64)
    some = np.bitwise_count(q | x).sum(axis=1).astype(np.float64)
    return np.where(some == 0, 0.0, 1.0 - both / np.where(some == 0, 1.0, some))


def _words_of(batch: pa.RecordBatch, vec_col: str, width: int) -> np.ndarray:
    v = batch.column(batch.schema.get_field_index(vec_col))
    return v.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64).reshape(-1, width)


def learn_minhash(df: DataFrame, id_col: str, vec_col: str, *, k: int = 10, target: float = 0.97, tables: int = 64, bits: int = 1,
                  seed: int = 42) -> MinHashTables | None:
    """Tables for packed bit vectors (array<long>), with the number of equal min-hashes learnt from true neighbours."""
    spark = df.sparkSession
    first = df.filter(F.col(vec_col).isNotNull()).groupBy(F.size(vec_col).alias("d")).count().orderBy(F.col("count").desc(), "d").first()
    if first is None or not first.d:
        return None
    width = first.d
    rng = np.random.default_rng(seed)
    made = MinHashTables(64 * width, np.stack([rng.permutation(64 * width) for _ in range(tables * bits)]), tables)
    good = df.filter(F.size(vec_col) == width)
    q = good.orderBy(F.xxhash64(id_col, F.lit("learn")), id_col).limit(SAMPLE_QUERIES).select(F.col(id_col).alias("qid"), F.col(vec_col).alias("qv"))
    drawn = q.collect()
    near = top_k(good, spark.createDataFrame(drawn, q.schema), k=k + 1, metric="JACCARD", id_col=id_col, vec_col=vec_col)
    pairs = (near.filter(F.col("qid") != F.col(id_col)).join(good.select(id_col, F.col(vec_col).alias("xv")), id_col)
             .select("qid", "xv").collect())  # queries x k
    if not pairs:
        return made
    at = {r.qid: r.qv for r in drawn}

    def packed(rows):
        return np.array(rows, np.int64).view(np.uint64).reshape(len(rows), width)

    a = made.signatures(unpacked(packed([at[p.qid] for p in pairs])))
    b = made.signatures(unpacked(packed([p.xv for p in pairs])))
    same = np.sort((a == b).sum(axis=1))
    made.equal = int(same[max(0, len(same) - 1 - math.ceil(target * len(same)))])
    return made


def minhash_search(df: DataFrame, queries: DataFrame, tables: MinHashTables | None, *, id_col: str, vec_col: str, k: int = 10, scored=None) -> DataFrame:
    """(qid, id, score, rank) of the best k candidates by Jaccard distance."""
    spark = df.sparkSession
    qid_type, id_type = queries.schema["qid"].dataType, df.schema[id_col].dataType
    out_type = T.StructType([T.StructField("qid", qid_type), T.StructField(id_col, id_type), T.StructField("score", T.DoubleType())])
    found = None
    if tables is not None:
        width = tables.dim // 64
        rows = df.select(id_col, vec_col).filter((F.size(vec_col) == width) & F.col(id_col).isNotNull())
        for qpass in query_passes(queries.filter(F.size("qv") == width).select("qid", "qv"), "qid", width, max_queries_per_pass=512):
            got = qpass.collect()  # bounded by query_passes
            q = np.array([r.qv for r in got], np.int64).view(np.uint64).reshape(len(got), width)
            sig = tables.signatures(unpacked(q))
            lists = _lists((t, int(b), i) for i, row in enumerate(tables.keys(sig)) for t, b in enumerate(row))
            shared = spark.sparkContext.broadcast(([r.qid for r in got], q, sig, lists, tables))
            part = rows.mapInArrow(_minhash_scan(shared, id_col, vec_col, width, k, _arrow_type(qid_type), _arrow_type(id_type), scored), out_type)
            found = part if found is None else found.unionByName(part)
    return _ranked(spark.createDataFrame([], out_type) if found is None else found, id_col, k)


def _minhash_scan(shared, id_col: str, vec_col: str, width: int, k: int, qid_type, id_type, scored):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, q, sig, lists, tables = shared.value
        tops = Tops(1, len(q), k)
        for b in batches:
            if not b.num_rows:
                continue
            ids_all, x_all = b.column(0).to_numpy(zero_copy_only=False), _words_of(b, vec_col, width)
            for s in _steps(b.num_rows, 64 * width + sig.shape[1], len(q) * 4):
                x, ids = x_all[s], ids_all[s]
                own = tables.signatures(unpacked(x))
                i, j = _met(tables.keys(own), lists, len(q))
                keep = np.zeros(len(i), bool)
                step = max(1, BLOCK_CELLS // sig.shape[1])
                for lo in range(0, len(i), step):
                    p = slice(lo, lo + step)
                    keep[p] = (sig[i[p]] == own[j[p]]).sum(axis=1) >= tables.equal
                i, j = i[keep], j[keep]
                if scored is not None:
                    scored.add(len(i))
                keys = np.full((len(q), len(x)), np.inf)
                keys[i, j] = jaccard_keys(q[i], x[j])
                tops.add(0, np.arange(len(q)), keys, ids)
        _, qi, key, ids = tops.rows()
        yield pa.RecordBatch.from_arrays([pa.array([qids[i] for i in qi], qid_type), pa.array(ids, id_type), pa.array(key)], ["qid", id_col, "score"])

    return run
