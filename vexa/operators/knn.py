"""Exact k-nearest-neighbour search.

Plan shape (per pass of at most ``max_queries_per_pass`` queries):

    scan(base)  --filter pushed to Parquet-->  mapInArrow(local top-k per query)
        --> shuffle on qid (<= k rows per query per input split)
        --> WindowGroupLimit + row_number <= k

The query batch is the only broadcast input; its row count and byte size
are checked first and it is split into hash passes when it is larger than
the bound.  The base table is never collected, never cross-joined and no
(query, row) pair is materialised: each task scores its split against the
query matrix with one BLAS product per Arrow batch and keeps only the best
k per query, ties broken by id ascending.

Output columns: ``qid``, the base id column, ``score`` (double, unrounded)
and ``rank`` (bigint, 1-based).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vexa.functions.vectors import ASCENDING, BINARY

# Upper bounds for what one broadcast query batch may hold.
MAX_QUERIES_PER_PASS = 2048
MAX_QUERY_BYTES = 64 << 20
# Bound for the (queries x rows) score block held in memory by one task.
BLOCK_CELLS = 4_000_000


def _select(keys: np.ndarray, ids_of, k: int) -> np.ndarray:
    """Column indices of the k smallest keys per row, ties by id ascending."""
    m, c = keys.shape
    if c <= k:
        return np.broadcast_to(np.arange(c), (m, c)).copy()
    part = np.argpartition(keys, k - 1, axis=1)[:, :k]
    sel = np.take_along_axis(keys, part, 1)
    t = sel.max(axis=1)
    n_all = (keys == t[:, None]).sum(axis=1)
    n_sel = (sel == t[:, None]).sum(axis=1)
    for r in np.nonzero((n_all > n_sel) & np.isfinite(t))[0]:
        lt = np.nonzero(keys[r] < t[r])[0]
        eq = np.nonzero(keys[r] == t[r])[0]
        need = k - len(lt)
        order = np.argsort(ids_of(r, eq), kind="stable")[:need]
        part[r] = np.concatenate([lt, eq[order]])
    return part


def _dense_keys(metric: str, Q: np.ndarray, qn: np.ndarray, B: np.ndarray,
                st_keys: np.ndarray, k: int, allowed: np.ndarray | None) -> np.ndarray:
    """Sort keys (lower is better) of the rows of B that can reach a query's top k; infinite elsewhere.

    One BLAS product estimates all keys.  Every row whose estimate is within
    the rounding bound of the k-th best is then scored again row by row, so the
    keys do not depend on the shape of the batch and no true hit is lost to
    cancellation.  For L2 both sides come shifted towards the queries' mean."""
    eps = np.finfo(np.float64).eps
    dim = Q.shape[1]
    bn = np.einsum("ij,ij->i", B, B)
    G = Q @ B.T
    top = np.sqrt(bn.max(initial=0.0))
    if metric == "L2":
        K = qn[:, None] + bn[None, :] - 2.0 * G
        slack = 8 * eps * (dim + 4) * (qn + top * top)
    elif metric == "IP":
        K = -G
        slack = 8 * eps * (dim + 4) * np.sqrt(qn) * top
    else:
        den = np.sqrt(qn)[:, None] * np.sqrt(bn)[None, :]
        with np.errstate(divide="ignore", invalid="ignore"):
            K = -np.where(den == 0, 0.0, G / np.where(den == 0, 1.0, den))
        slack = np.full(len(Q), 8 * eps * (dim + 4))
    K[np.isnan(K)] = np.inf
    if allowed is not None:
        K[~allowed] = np.inf
    both = np.hstack([st_keys, K])
    kth = np.partition(both, k - 1, axis=1)[:, k - 1] if both.shape[1] >= k else np.full(len(Q), np.inf)
    i, j = np.nonzero(np.isfinite(K) & (K <= (kth + 2 * slack)[:, None]))
    out = np.full(K.shape, np.inf)
    step = max(1, BLOCK_CELLS // dim)
    for lo in range(0, len(i), step):
        a, b = i[lo:lo + step], j[lo:lo + step]
        if metric == "L2":
            d = Q[a] - B[b]
            out[a, b] = np.einsum("ij,ij->i", d, d)
            continue
        dot = np.einsum("ij,ij->i", Q[a], B[b])
        if metric == "COSINE":
            n = np.sqrt(qn[a]) * np.sqrt(bn[b])
            dot = np.where(n == 0, 0.0, dot / np.where(n == 0, 1.0, n))
        out[a, b] = -dot
    return out


def _bit_keys(metric: str, Q: np.ndarray, B: np.ndarray) -> np.ndarray:
    x = np.bitwise_count(Q[:, None, :] ^ B[None, :, :]).sum(axis=2).astype(np.float64)
    if metric == "HAMMING":
        return x
    inter = np.bitwise_count(Q[:, None, :] & B[None, :, :]).sum(axis=2).astype(np.float64)
    union = np.bitwise_count(Q[:, None, :] | B[None, :, :]).sum(axis=2).astype(np.float64)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(union == 0, 0.0, 1.0 - inter / np.where(union == 0, 1.0, union))


def _partition_topk(bq, k: int, metric: str, id_col: str, vec_col: str, qid_type, id_type,
                    cell_col: str | None = None):
    binary = metric in BINARY

    def run(batches):
        qids, Q, probe = bq.value
        m = len(qids)
        if metric == "L2":
            shift = Q.mean(axis=0)
            Q = Q - shift
        qn = np.einsum("ij,ij->i", Q, Q) if not binary else None
        width = Q.shape[1]
        st_keys = np.empty((m, 0), dtype=np.float64)
        st_ids = None
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            ids_all = batch.column(id_col).to_numpy(zero_copy_only=False)
            flat = batch.column(vec_col).flatten().to_numpy(zero_copy_only=False)
            cells_all = batch.column(cell_col).to_numpy(zero_copy_only=False) if probe is not None else None
            # neither the scores nor the widened vectors of a block exceed BLOCK_CELLS numbers
            step = max(1, BLOCK_CELLS // max(1, width, m * (width if binary else 1)))
            for lo in range(0, n, step):
                ids = ids_all[lo:lo + step]
                part = flat[lo * width:(lo + step) * width]
                B = (part.astype(np.int64).view(np.uint64) if binary else part.astype(np.float64)).reshape(-1, width)
                # a query only sees rows of the cells it probes
                allowed = probe[:, cells_all[lo:lo + step]] if probe is not None else None
                if binary:
                    K = _bit_keys(metric, Q, B)
                    if allowed is not None:
                        K = np.where(allowed, K, np.inf)
                else:
                    K = _dense_keys(metric, Q, qn, B - shift if metric == "L2" else B, st_keys, k, allowed)
                if st_ids is None:
                    st_ids = np.empty((m, 0), dtype=ids.dtype)
                sc = st_keys.shape[1]
                C = np.hstack([st_keys, K])

                def ids_of(r, cols, sc=sc, ids=ids):
                    cols = np.asarray(cols)
                    out = np.empty(len(cols), dtype=ids.dtype if sc == 0 else np.result_type(ids.dtype, st_ids.dtype))
                    old = cols < sc
                    out[old] = st_ids[r, cols[old]]
                    out[~old] = ids[cols[~old] - sc]
                    return out

                sel = _select(C, ids_of, k)
                new_keys = np.take_along_axis(C, sel, 1)
                if sc:
                    old_part = st_ids[np.arange(m)[:, None], np.minimum(sel, sc - 1)]
                    new_part = ids[np.maximum(sel - sc, 0)]
                    new_ids = np.where(sel < sc, old_part, new_part)
                else:
                    new_ids = ids[sel]
                st_keys, st_ids = new_keys, new_ids
        if st_ids is None or st_keys.shape[1] == 0:
            return
        c = st_keys.shape[1]
        scores = st_keys if ASCENDING[metric] else -st_keys
        keep = np.isfinite(st_keys).reshape(-1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(qids, c)[keep], type=qid_type),
             pa.array(st_ids.reshape(-1)[keep], type=id_type),
             pa.array(scores.reshape(-1)[keep], type=pa.float64())],
            names=["qid", id_col, "score"])

    return run


def _arrow_type(dt: T.DataType):
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(dt)


def query_passes(queries: DataFrame, qid_col: str, dim_hint: int | None,
                 max_queries_per_pass: int = MAX_QUERIES_PER_PASS,
                 max_query_bytes: int = MAX_QUERY_BYTES) -> list[DataFrame]:
    """Split the query set into hash passes small enough to broadcast.

    The row count is checked by a Spark job (no rows reach the driver for
    it); every pass holds about ``max_queries_per_pass`` queries.
    """
    n = queries.count()
    if n == 0:
        return []
    per_row = 8 * (dim_hint or 1024) + 64
    per_pass = max(1, min(max_queries_per_pass, max_query_bytes // per_row))
    n_pass = math.ceil(n / per_pass)
    if n_pass == 1:
        return [queries]
    h = F.pmod(F.xxhash64(F.col(qid_col)), F.lit(n_pass))
    return [queries.where(h == p) for p in range(n_pass)]


def top_k(base: DataFrame, queries: DataFrame, *, k: int = 10, metric: str = "L2",
          id_col: str = "id", vec_col: str = "vector", qid_col: str = "qid",
          qvec_col: str = "qv", dim: int | None = None,
          max_queries_per_pass: int = MAX_QUERIES_PER_PASS,
          cell_col: str | None = None, probes: DataFrame | None = None, n_cells: int = 0) -> DataFrame:
    """Exact top-k of every query over ``base`` (already filtered by the caller).

    ``base`` needs ``id_col`` and ``vec_col`` (array<float|double>, or
    array<long> packed bits for HAMMING / JACCARD).  Rows whose id is null, or whose vector is
    null, of another length than the queries or not a number (NaN) are never
    hits; queries of different lengths in one search are an error.

    With ``probes(qid, cell)`` (IVF search) a query scores only rows whose
    ``cell_col`` it probes; the probe table is bounded by queries x nprobe.
    """
    metric = metric.upper()
    spark = base.sparkSession
    sc = spark.sparkContext
    qid_dt = queries.schema[qid_col].dataType
    id_dt = base.schema[id_col].dataType
    out_schema = T.StructType([
        T.StructField("qid", qid_dt), T.StructField(id_col, id_dt), T.StructField("score", T.DoubleType())])
    qsel = queries.select(F.col(qid_col).alias("qid"), F.col(qvec_col).alias("qv")).where(F.col("qv").isNotNull())
    parts = []
    for qpass in query_passes(qsel, "qid", dim, max_queries_per_pass):
        rows = qpass.collect()  # bounded by query_passes
        if not rows:
            continue
        d = len(rows[0][1])
        if any(len(r[1]) != d for r in rows):
            raise ValueError("queries of one search must have one dimension")
        qids = np.array([r[0] for r in rows])
        if metric in BINARY:
            Q = np.array([r[1] for r in rows], dtype=np.int64).view(np.uint64).reshape(len(rows), d)
        else:
            Q = np.array([r[1] for r in rows], dtype=np.float64).reshape(len(rows), d)
        probe = None
        if probes is not None:
            pos = {q: i for i, q in enumerate(qids.tolist())}
            probe = np.zeros((len(qids), n_cells), dtype=bool)
            for qid, cell in probes.select("qid", "cell").collect():  # bounded: queries x nprobe
                if qid in pos:
                    probe[pos[qid], int(cell)] = True
        cols = [id_col, vec_col] + ([cell_col] if probe is not None else [])
        bq = sc.broadcast((qids, Q, probe))
        fn = _partition_topk(bq, k, metric, id_col, vec_col, _arrow_type(qid_dt), _arrow_type(id_dt), cell_col)
        cand = (base.select(*cols)
                .where((F.size(F.col(vec_col)) == d) & F.col(id_col).isNotNull())
                .mapInArrow(fn, out_schema))
        parts.append(cand)
    if not parts:
        return spark.createDataFrame([], out_schema.add("rank", T.LongType()))
    cand = parts[0]
    for p in parts[1:]:
        cand = cand.unionByName(p)
    order = F.col("score").asc() if ASCENDING[metric] else F.col("score").desc()
    w = Window.partitionBy("qid").orderBy(order, F.col(id_col).asc())
    return (cand.withColumn("rank", F.row_number().over(w).cast("long"))
            .where(F.col("rank") <= k))


def centroid_queries(df: DataFrame, group_col: str, vec_col: str,
                     qid_col: str = "qid", qvec_col: str = "qv") -> DataFrame:
    """Mean vector per group, as a query set ``(qid, qv array<double>)``.

    MLlib ``Summarizer.mean`` aggregates whole vectors in one buffer per
    group with map-side partial aggregation: no explode into dim rows, and a
    group holding a third of all rows costs one partial buffer per task.
    Vectors of another length than the group's are skipped upstream by the
    caller's schema check."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    v = df.where(F.col(vec_col).isNotNull()).select(
        F.col(group_col).alias(qid_col), array_to_vector(F.col(vec_col)).alias("_v"))
    m = v.groupBy(qid_col).agg(Summarizer.mean(F.col("_v")).alias("_m"))
    return m.select(qid_col, vector_to_array(F.col("_m"), "float64").alias(qvec_col))


def rounded(df: DataFrame, col: str = "score", places: int = 6) -> DataFrame:
    return df.withColumn(col, F.round(F.col(col), places))


def fetch_fields(hits: DataFrame, payloads: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """Join wide payload columns onto the (small) hit list late.

    Each payload table is first cut down by a semi-join with the hit keys
    (broadcast after a count proves them small; the hit list is bounded by
    queries x k), so the wide table is scanned once and never shuffled whole.
    """
    from vexa.operators.common import broadcast_if_small, kept
    out = hits = kept(hits, "hits")  # the search runs once
    for payload, key, how in payloads:
        keys = broadcast_if_small(hits.select(key).distinct())
        small = payload.join(keys, key, "left_semi")
        out = out.join(small, key, how)
    return out


def export_batches(scored: DataFrame, score_col: str, id_col: str, batch_size: int,
                   limit: int | None = None, ascending: bool = True) -> DataFrame:
    """Every row in (score, id) order with a global position ``rn`` and
    ``batch_no = (rn - 1) div batch_size``; rows past ``limit`` dropped.  Rows
    without a score come last.

    Numbering goes through ``global_row_number`` (range partitions plus
    offsets), never through one global window."""
    from vexa.operators.ordering import batch_number, global_row_number
    order = [F.col(score_col).asc_nulls_last() if ascending else F.col(score_col).desc_nulls_last(), F.col(id_col).asc()]
    n = global_row_number(scored, order, "rn")
    if limit is not None:
        n = n.where(F.col("rn") <= limit)
    return n.select(batch_number(F.col("rn"), batch_size).alias("batch_no"), "rn", id_col,
                    F.round(F.col(score_col), 6).alias(score_col))


def local_queries(queries: DataFrame, max_rows: int = MAX_QUERIES_PER_PASS) -> DataFrame:
    """Evaluate a small query set once and keep it as a local relation, so
    repeated searches (grids, several metrics) do not recompute it.  A set
    larger than ``max_rows`` stays distributed and is split into passes."""
    rows = queries.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return queries
    return queries.sparkSession.createDataFrame(rows, queries.schema)
