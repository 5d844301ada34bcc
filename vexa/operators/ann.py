"""Approximate search structures built as Spark jobs.

IVF: see ``ivf``; here are its plain entry points and the assignment of rows that arrive after the build.

LSH: see ``lsh``.

fp16: little-endian half floats in a BinaryType column, encoded and decoded
per Arrow batch (one NumPy cast per batch, no per-row Python loop).

Flat PQ codes (``pq_train``, ``pq_encode``, ``pq_search``) need no cells; ``ivf.exact_search`` works on codes of residuals.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vexa.operators import ivf
from vexa.operators.common import broadcast_if_small, rank_within
from vexa.operators.ivf import IvfIndex
from vexa.operators.knn import BLOCK_CELLS, top_k


def ivf_build(spark: SparkSession, df: DataFrame, id_col: str, vec_col: str, nlist: int, seed: int = 42,
              path: str | None = None) -> IvfIndex:
    """An index of ``nlist`` cells; see ``ivf.build``."""
    return ivf.build(spark, df, id_col, vec_col, nlist, seed=seed, path=path)


def ivf_assign(index: IvfIndex, new_rows: DataFrame) -> DataFrame:
    """Nearest cell for rows that arrive after the build (no rebuild, O82).

    The centroids (nlist x dim, fixed at build time) are broadcast and each Arrow
    batch takes its nearest; rows never pass through the driver.  A row without a vector of
    the index's length gets the cell -1, which no search probes."""
    cells = index.centroids.orderBy("cell").collect()  # nlist rows
    shared = new_rows.sparkSession.sparkContext.broadcast(
        (np.array([r.cell for r in cells], np.int32), np.array([r.centroid for r in cells], np.float64)))
    names, vec_col = new_rows.columns, index.vec_col

    def run(batches):
        ids, C = shared.value
        for b in batches:
            v = b.column(b.schema.get_field_index(vec_col))
            ok = np.asarray(v.value_lengths().fill_null(-1)) == C.shape[1] if b.num_rows else np.zeros(0, bool)
            cell = np.full(b.num_rows, -1, np.int32)
            if ok.any():
                X = v.filter(pa.array(ok)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, C.shape[1])
                near = np.einsum("ij,ij->i", C, C)[None, :] - 2.0 * (X @ C.T)
                cell[ok] = np.where(np.isnan(X).any(axis=1), -1, ids[near.argmin(axis=1)])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell)], [*names, "cell"])

    return new_rows.mapInArrow(run, T.StructType([*new_rows.schema.fields, T.StructField("cell", T.IntegerType())]))


def ivf_search(spark: SparkSession, index: IvfIndex, queries: DataFrame, *, k: int = 10, nprobe: int | None = None,
               metric: str = "L2", where=None, table: DataFrame | None = None) -> DataFrame:
    """``table`` overrides the indexed rows, e.g. with those of later batches added."""
    return ivf.search(spark, index, queries, k=k, nprobe=nprobe, metric=metric, where=where, table=table)


def lsh_search(df: DataFrame, queries: DataFrame, id_col: str, vec_col: str, *, k: int = 10,
               bucket_length: float = 0.5, num_tables: int = 8, threshold: float = float("inf"), seed: int = 42) -> DataFrame:
    """Candidates from bucket collisions (approxSimilarityJoin), exact L2 ranks them.

    ``threshold`` is an absolute distance beyond which a candidate is dropped; there is none by default."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector

    base = df.select(id_col, array_to_vector(F.col(vec_col)).alias("features"))
    q = queries.select("qid", array_to_vector(F.col("qv")).alias("features"))
    model = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=bucket_length,
                                        numHashTables=num_tables, seed=seed).fit(base)
    pairs = model.approxSimilarityJoin(q, base, threshold, distCol="dist")
    hits = pairs.select(F.col("datasetA.qid").alias("qid"), F.col(f"datasetB.{id_col}").alias(id_col),
                        (F.col("dist") * F.col("dist")).alias("score"))
    return rank_within(hits, ["qid"], [F.col("score").asc(), F.col(id_col).asc()], k)


# --- half floats ---------------------------------------------------------------
@F.arrow_udf(T.BinaryType())
def fp16_encode(v: pa.Array) -> pa.Array:
    """array<float> -> little-endian float16 bytes (2 bytes per component); null elements become NaN.

    One NumPy cast for the whole Arrow batch, whatever the lengths."""
    flat = v.flatten().to_numpy(zero_copy_only=False).astype(np.float32).astype("<f2")
    ends = np.concatenate([[0], np.cumsum(v.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))])
    null = v.is_null().to_numpy(zero_copy_only=False)
    valid = pa.py_buffer(np.packbits(~null, bitorder="little")) if null.any() else None
    return pa.Array.from_buffers(pa.binary(), len(v), [valid, pa.py_buffer((2 * ends).astype(np.int32)), pa.py_buffer(flat)])


@F.arrow_udf(T.ArrayType(T.FloatType()))
def fp16_decode(b: pa.Array) -> pa.Array:
    """Little-endian float16 bytes -> array<float>; one NumPy cast per Arrow batch."""
    lens = pc.binary_length(b).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) // 2
    ends = np.concatenate([[0], np.cumsum(lens)])
    flat = np.frombuffer(b"".join(x for x in b.to_pylist() if x), "<f2").astype(np.float32)
    mask = b.is_null()
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat), mask=mask if mask.true_count else None)


# --- product quantization ----------------------------------------------------------
@dataclass
class PqCodebook:
    m: int
    ksub: int
    dsub: int
    centers: np.ndarray   # m x ksub x dsub (bounded; broadcast to tasks)


def pq_train(spark: SparkSession, df: DataFrame, vec_col: str, m: int, ksub: int = 16, seed: int = 42,
             sample_fraction: float | None = None) -> PqCodebook:
    """One MLlib KMeans per sub-space (Jegou et al. 2011), trained on all
    vectors unless the caller passes ``sample_fraction``."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    dim = int(df.select(F.max(F.size(vec_col))).first()[0])
    if dim % m:
        raise ValueError(f"{m} sub-spaces do not divide {dim} dimensions")
    dsub = dim // m
    src = df.select(vec_col)
    if sample_fraction and sample_fraction < 1.0:
        src = src.sample(fraction=sample_fraction, seed=seed)
    src = src.where(F.size(vec_col) == dim)
    cents = []
    for j in range(m):
        sub = src.select(array_to_vector(F.slice(vec_col, j * dsub + 1, dsub)).alias("features"))
        model = KMeans(k=ksub, seed=seed + j, featuresCol="features", maxIter=20).fit(sub)
        c = np.array([list(x) for x in model.clusterCenters()], dtype=np.float64)
        if c.shape[0] < ksub:  # fewer distinct points than centroids
            c = np.vstack([c, np.repeat(c[-1:], ksub - c.shape[0], axis=0)])
        cents.append(c)
    return PqCodebook(m, ksub, dsub, np.stack(cents))


def pq_encode(df: DataFrame, id_col: str, vec_col: str, book: PqCodebook) -> DataFrame:
    """``(id, codes array<int>, errs array<double>)``: nearest sub-centroid per sub-space and the
    distance to it, per Arrow batch."""
    bc = df.sparkSession.sparkContext.broadcast(book.centers)
    m, dsub = book.m, book.dsub
    id_type = df.schema[id_col].dataType

    def enc(batches):
        import pyarrow as pa
        C = bc.value
        for b in batches:
            n = b.num_rows
            if n == 0:
                continue
            X = b.column(vec_col).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
            codes, errs = np.empty((n, m), dtype=np.int32), np.empty((n, m))
            for j in range(m):
                S = X[:, j * dsub:(j + 1) * dsub]
                d = (S * S).sum(1)[:, None] + (C[j] * C[j]).sum(1)[None, :] - 2 * S @ C[j].T
                codes[:, j] = d.argmin(1)
                errs[:, j] = np.sqrt(((S - C[j][codes[:, j]]) ** 2).sum(1))
            off = np.arange(0, (n + 1) * m, m, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(id_col), *(pa.ListArray.from_arrays(pa.array(off), pa.array(x.reshape(-1))) for x in (codes, errs))],
                names=[id_col, "codes", "errs"])

    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("codes", T.ArrayType(T.IntegerType())),
                           T.StructField("errs", T.ArrayType(T.DoubleType()))])
    d = df.select(id_col, vec_col).where(F.size(vec_col) == m * dsub)
    return d.mapInArrow(enc, schema)


def pq_search(codes: DataFrame, base: DataFrame, queries: DataFrame, book: PqCodebook, *, id_col: str,
              vec_col: str, k: int = 10, rerank: int = 50) -> DataFrame:
    """Asymmetric-distance top-``rerank`` per query over the codes, then the exact L2 scores of those
    candidates (fetched by a semi-join with the base).  The k-th best of these scores bounds the
    search: in sub-space j a row is at least |d_j - e_j| away, with d_j the query's distance to the row's
    sub-centroid and e_j the row's own, so every row whose sum of squares reaches the bound of
    some query is scored too and no true neighbour is lost at any size of the table; ``rerank`` only decides
    how tight the bound is.  The query set is split into bounded passes like ``top_k``'s."""
    from vexa.operators.knn import query_passes
    out = None
    for qpass in query_passes(queries.select("qid", "qv"), "qid", book.m * book.dsub):
        r = _pq_pass(codes, base, qpass, book, id_col=id_col, vec_col=vec_col, k=k, rerank=rerank)
        out = r if out is None else out.unionByName(r)
    return out


def _pq_pass(codes: DataFrame, base: DataFrame, queries: DataFrame, book: PqCodebook, *, id_col: str,
             vec_col: str, k: int, rerank: int) -> DataFrame:
    from vexa.operators.knn import _select

    rows = queries.select("qid", "qv").collect()  # one pass: bounded by query_passes
    qids = np.array([r[0] for r in rows])
    Q = np.array([r[1] for r in rows], dtype=np.float64)
    m, dsub = book.m, book.dsub
    lut = np.stack([((Q[:, None, j * dsub:(j + 1) * dsub] - book.centers[j][None, :, :]) ** 2).sum(-1)
                    for j in range(m)], axis=1)  # q x m x ksub
    bc = codes.sparkSession.sparkContext.broadcast((qids, lut))
    id_type = codes.schema[id_col].dataType
    qid_type = queries.schema["qid"].dataType

    def adc(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type
        qid_arr, L = bc.value
        nq = len(qid_arr)
        keys = np.empty((nq, 0))
        ids = None
        for b in batches:
            n = b.num_rows
            if n == 0:
                continue
            cid = b.column(id_col).to_numpy(zero_copy_only=False)
            C = b.column("codes").flatten().to_numpy(zero_copy_only=False).reshape(n, m)
            K = np.zeros((nq, n))
            for j in range(m):
                K += L[:, j, :][:, C[:, j]]
            if ids is None:
                ids = np.empty((nq, 0), dtype=cid.dtype)
            allk = np.hstack([keys, K])
            allid = np.hstack([ids, np.broadcast_to(cid, (nq, n))])
            sel = _select(allk, lambda r, cols: allid[r, cols], rerank)
            keys, ids = np.take_along_axis(allk, sel, 1), np.take_along_axis(allid, sel, 1)
        if ids is None:
            return
        c = keys.shape[1]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(qid_arr, c), type=to_arrow_type(qid_type)),
                                          pa.array(ids.reshape(-1), type=to_arrow_type(id_type)),
                                          pa.array(keys.reshape(-1))], names=["qid", id_col, "adc"])

    schema = T.StructType([T.StructField("qid", queries.schema["qid"].dataType), T.StructField(id_col, id_type),
                           T.StructField("adc", T.DoubleType())])
    # the best ``rerank`` codes of each query over all tasks
    near = codes.select(id_col, "codes").mapInArrow(adc, schema)
    cand = rank_within(near, ["qid"], [F.col("adc").asc(), F.col(id_col).asc()], rerank).select("qid", id_col).distinct()
    ids = broadcast_if_small(cand.select(id_col).distinct())  # queries x rerank x tasks, checked
    vecs = base.select(id_col, vec_col).where(F.size(vec_col) == m * dsub).join(ids, id_col, "left_semi")
    from vexa.functions.vectors import l2_sq
    qv = F.broadcast(queries.select("qid", "qv"))  # the query batch collected above (bounded)
    scored = (cand.join(qv, "qid").join(vecs, id_col).select("qid", id_col, l2_sq(vec_col, "qv").alias("score"))
              .where(~F.isnan("score")))
    best = rank_within(scored, ["qid"], [F.col("score").asc(), F.col(id_col).asc()], k)
    kth = {r.qid: r.score for r in best.where(F.col("rank") == k).select("qid", "score").collect()}  # one row per query
    bound = np.array([kth.get(q, np.inf) for q in qids.tolist()])  # fewer than k candidates: no bound
    reach = pq_reach(codes, id_col, np.sqrt(lut), bound)
    return top_k(base.join(reach.distinct(), id_col, "left_semi"), queries, k=k, id_col=id_col, vec_col=vec_col)


def pq_reach(codes: DataFrame, id_col: str, dist: np.ndarray, bound: np.ndarray) -> DataFrame:
    """Ids of the rows whose lower bound on the squared distance is within ``bound`` for some query;
    ``dist`` holds the distances [query, sub-space, sub-centroid]."""
    bc = codes.sparkSession.sparkContext.broadcast((dist, bound))

    def run(batches):
        import pyarrow as pa
        D, top = bc.value
        nq, m, _ = D.shape
        step = max(1, BLOCK_CELLS // max(nq, 1))
        for b in batches:
            C = b.column("codes").flatten().to_numpy(zero_copy_only=False).reshape(-1, m)
            E = b.column("errs").flatten().to_numpy(zero_copy_only=False).reshape(-1, m)
            keep = np.zeros(b.num_rows, bool)
            for lo in range(0, b.num_rows, step):
                c, e = C[lo:lo + step], E[lo:lo + step]
                low, size = np.zeros((nq, len(c))), np.zeros((nq, len(c)))
                for j in range(m):
                    d = D[:, j, :][:, c[:, j]]
                    low += (d - e[:, j]) ** 2
                    size += d * d + e[:, j] ** 2
                keep[lo:lo + step] = (low - 1e-9 * size <= top[:, None] * (1 + 1e-9)).any(axis=0)  # with room for rounding
            yield pa.RecordBatch.from_arrays([b.column(id_col).filter(pa.array(keep))], names=[id_col])

    return codes.select(id_col, "codes", "errs").mapInArrow(run, T.StructType([codes.schema[id_col]]))
