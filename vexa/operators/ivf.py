"""Inverted-file search with persisted indexes.

Index.  A coarse quantiser (k-means on a bounded sample) cuts the table into cells; every row is written to its cell's
folder, together with, for a product-quantised index, one byte per sub-space naming the centroid nearest to its
residual (row minus cell centre) and one byte bounding the distance to that centroid from above.  ``cells`` holds
centre, row count and the least and largest distance of a row to the centre.  The index is a folder that any
session can open again (``open_index``).

Search by inverted probe lists.  The queries (bounded passes) are grouped by the cells they probe; only probed cells are
read, and a task multiplies each cell's rows with that cell's own queries only, so work falls with the
number of probes.  How many cells to probe is measured when the index is built: on a sample of its rows, the true
neighbours' cells are ranked from the query, and ``nprobe`` is the smallest number that finds the share
``target`` of them.  Several settings and filters share one scan.

Exact search over codes.  A first probe gives each query an upper bound on its k-th distance.  From then on a cell drops out if
the triangle inequality with its centre and radii puts all its rows beyond the bound, and a row if its codes do:
in sub-space j it is at least |d_j - e_j| away, d_j being the distance from the query to the row's centroid and e_j the
bound on the row's own distance to it.  What remains is scored exactly, so the result is that of the exact search.

Rows whose vector is null, of another length than the index, or not a number are kept in cell -1 and never found, nor are rows with a null id.  Ties are
broken by id.  An empty table has an index without cells, and no hits.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vexa.functions.vectors import ASCENDING
from vexa.operators.knn import BLOCK_CELLS, _arrow_type, _dense_keys, _select, query_passes, top_k
from vexa.session import scratch_path

SAMPLE_ROWS = 16_384     # rows that train the quantisers
SAMPLE_BYTES = 64 << 20
CALIBRATION_QUERIES = 128
MAX_CELLS = 1 << 14
MLLIB_CELLS = 256        # MLlib's k-means sends the distances between all pairs of centres to the driver in every round


@dataclass(frozen=True)
class IvfIndex:
    path: str
    id_col: str
    vec_col: str
    dim: int
    nlist: int
    nprobe: int      # cells to probe for the recall aimed at
    sub_spaces: int  # 0: no codes
    schema: str      # of the rows, as JSON

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(T.StructType.fromJson(json.loads(self.schema))).parquet(f"{self.path}/data")

    @property
    def centroids(self) -> DataFrame:
        return self.cells(SparkSession.active()).select("cell", "centroid")

    def cells(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/cells")


@dataclass
class Quantiser:
    """Product quantiser of residuals: centroids [sub-space, code, dimension] and, per sub-space, the step of the error bytes."""

    centroids: np.ndarray
    step: np.ndarray

    def encode(self, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m, _, w = self.centroids.shape
        codes, errors = np.empty((len(r), m), np.uint8), np.empty((len(r), m), np.uint8)
        for j in range(m):
            s, c = r[:, j * w:(j + 1) * w], self.centroids[j]
            codes[:, j] = ((c * c).sum(axis=1)[None, :] - 2.0 * s @ c.T).argmin(axis=1)
            e = np.sqrt(((s - c[codes[:, j]]) ** 2).sum(axis=1))
            errors[:, j] = np.minimum(np.ceil(e * (1 + 1e-9) / self.step[j]), 255)
        return codes, errors

    def bounds(self, errors: np.ndarray) -> np.ndarray:
        """Upper bounds on the distances to the centroids; the last byte stands for any distance."""
        return np.where(errors == 255, np.inf, errors * self.step)


def _lloyd(x: np.ndarray, k: int, seed: int, rounds: int = 20, nearest: Callable[[np.ndarray], np.ndarray] | None = None) -> np.ndarray:
    """k-means in memory, for the few columns of one sub-space or a bounded sample; ``nearest`` finds the centre nearest to each row."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(x, axis=0)
    if len(distinct) <= k:
        return distinct
    centres = distinct[rng.choice(len(distinct), k, replace=False)]
    for _ in range(rounds):
        near = _nearest(x, centres) if nearest is None else nearest(centres)
        n = np.bincount(near, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        moved = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres)
        if np.allclose(moved, centres, rtol=1e-6, atol=0):
            break
        centres = moved
    return centres


def _sample(spark: SparkSession, rows: DataFrame, id_col: str, vec_col: str, dim: int, n: int) -> np.ndarray:
    """A bounded sample of the vectors, the first by hash of the id."""
    limit = max(256, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dim)))
    chosen = rows if n <= limit else rows.orderBy(F.xxhash64(id_col), id_col).limit(limit)
    got = chosen.select(vec_col).toArrow().column(0).combine_chunks()
    return got.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _valid(df: DataFrame, vec_col: str, dim: int) -> Column:
    v = F.col(vec_col)
    return F.coalesce((F.size(v) == dim) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)), F.lit(False))


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1)[None, :] - 2.0 * x @ centres.T).argmin(axis=1)


def _rows_of(batch: pa.RecordBatch, vec_col: str, dim: int) -> np.ndarray:
    v = batch.column(batch.schema.get_field_index(vec_col))
    return v.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _steps(n: int, dim: int, width: int) -> Iterator[slice]:
    """Runs of rows whose vectors and scores stay within ``BLOCK_CELLS`` numbers each."""
    step = max(1, BLOCK_CELLS // max(dim, width, 1))
    for lo in range(0, n, step):
        yield slice(lo, min(lo + step, n))


def build(spark: SparkSession, df: DataFrame, id_col: str, vec_col: str, nlist: int | None = None, sub_spaces: int = 0, target: float = 0.95,
          k: int = 10, seed: int = 42, path: str | None = None) -> IvfIndex:
    """Index every row of ``df``.  ``nlist`` is by default the square root of the number of rows; ``sub_spaces`` > 0 adds codes
    of one byte for each.  ``target`` is the recall of ``k`` neighbours that ``nprobe`` is chosen for."""
    path = path or scratch_path(spark, "ivf")
    dim = df.filter(F.col(vec_col).isNotNull()).groupBy(F.size(vec_col).alias("d")).count().orderBy(F.col("count").desc(), "d").first()
    dim = dim.d if dim else 0
    good = df.filter(_valid(df, vec_col, dim))
    n = good.count()
    sample = _sample(spark, good, id_col, vec_col, dim, n) if n and dim else np.zeros((0, max(dim, 1)))
    nlist = max(1, min(nlist or math.isqrt(n), MAX_CELLS, len(sample))) if len(sample) else 0
    centres = _coarse(spark, sample, nlist, seed)
    nlist = len(centres)
    if sub_spaces and dim % sub_spaces:
        raise ValueError(f"{sub_spaces} sub-spaces do not divide {dim} dimensions")
    quantiser = _train(spark, sample - centres[_nearest(sample, centres)], sub_spaces, seed) if sub_spaces and nlist else None
    schema = _write(spark, df, vec_col, dim, centres, quantiser, path)
    index = IvfIndex(path, id_col, vec_col, dim, nlist, nlist, sub_spaces if quantiser else 0, schema.json())
    index = IvfIndex(**{**asdict(index), "nprobe": calibrated(spark, index, target, k)})
    spark.createDataFrame([(json.dumps({k: v for k, v in asdict(index).items() if k != "path"}),)], "settings string") \
        .coalesce(1).write.text(f"{path}/settings")
    return index


def open_index(spark: SparkSession, path: str) -> IvfIndex:
    """An index written before, by this or another session."""
    return IvfIndex(path=path, **json.loads(spark.read.text(f"{path}/settings").first()[0]))


def _coarse(spark: SparkSession, sample: np.ndarray, nlist: int, seed: int) -> np.ndarray:
    """Cell centres: k-means over the sample, spread over tasks; by MLlib up to ``MLLIB_CELLS``."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    if not nlist:
        return np.zeros((0, sample.shape[1]))
    if len(np.unique(sample, axis=0)) <= nlist:
        return np.unique(sample, axis=0)
    if nlist > MLLIB_CELLS:
        return _lloyd(sample, nlist, seed, nearest=_nearest_by_tasks(spark, sample))
    table = pa.table({"v": pa.FixedSizeListArray.from_arrays(pa.array(sample.ravel()), sample.shape[1]).cast(pa.list_(pa.float64()))})
    feats = spark.createDataFrame(table).select(array_to_vector("v").alias("features"))
    return np.array(KMeans(k=nlist, seed=seed, maxIter=20).fit(feats).clusterCenters())


def _nearest_by_tasks(spark: SparkSession, x: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """``_nearest`` for a sample that the driver holds: tasks send one number for each row back, whatever the number of centres."""
    shared = spark.sparkContext.broadcast(x)

    def nearest(centres: np.ndarray) -> np.ndarray:
        given = spark.sparkContext.broadcast(centres)
        step = max(1, BLOCK_CELLS // max(centres.shape))

        def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for lo in b.column(0).to_pylist():
                    near = _nearest(shared.value[lo:lo + step], given.value).astype("<i4")
                    yield pa.RecordBatch.from_arrays([pa.array([lo], pa.int64()), pa.array([near.tobytes()], pa.binary())], ["lo", "near"])

        runs = spark.range(0, len(x), step, max(1, min(spark.sparkContext.defaultParallelism, -(-len(x) // step))))
        got = runs.mapInArrow(label, "lo long, near binary").collect()  # four bytes a row
        given.destroy()
        return np.concatenate([np.frombuffer(r.near, "<i4") for r in sorted(got, key=lambda r: r.lo)])

    return nearest


def _train(spark: SparkSession, residuals: np.ndarray, m: int, seed: int) -> Quantiser:
    """One codebook of up to 256 centroids per sub-space; each is trained by its own task on the sample."""
    shared = spark.sparkContext.broadcast(residuals)
    w = residuals.shape[1] // m

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for j in b.column(0).to_pylist():
                s = shared.value[:, j * w:(j + 1) * w]
                c = _lloyd(s, 256, seed + j)
                e = np.sqrt(np.maximum(((s[:, None, :] - c[None, :, :]) ** 2).sum(-1).min(axis=1), 0)) if len(s) <= 4096 else \
                    np.concatenate([np.sqrt(((p[:, None, :] - c[None, :, :]) ** 2).sum(-1).min(axis=1)) for p in np.array_split(s, len(s) // 1024)])
                yield pa.RecordBatch.from_arrays([pa.array([j], pa.int64()), pa.array([len(c)], pa.int32()), pa.array([c.tobytes()], pa.binary()),
                                                  pa.array([float(e.max(initial=0.0))])], ["j", "k", "c", "e"])

    got = spark.range(m).repartition(m, "id").mapInArrow(train, "j long, k int, c binary, e double").collect()  # m x 256 x w numbers
    centroids = np.full((m, 256, w), np.inf)
    step = np.empty(m)
    for r in got:
        c = np.frombuffer(r.c, np.float64).reshape(r.k, w)
        centroids[r.j, :r.k], centroids[r.j, r.k:] = c, c[-1]
        step[r.j] = max(1.5 * r.e, 1e-12) / 254  # rows beyond the sample's errors get the byte 255 if they are far beyond
    return Quantiser(centroids, step)


def _write(spark: SparkSession, df: DataFrame, vec_col: str, dim: int, centres: np.ndarray, quantiser: Quantiser | None,
           path: str) -> T.StructType:
    shared = spark.sparkContext.broadcast((centres, quantiser))
    fields = [*df.schema.fields, T.StructField("_code", T.BinaryType()), T.StructField("_error", T.BinaryType()),
              T.StructField("_dist", T.DoubleType()), T.StructField("cell", T.IntegerType())]
    rows = df.withColumn("_ok", _valid(df, vec_col, dim))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, q = shared.value
        for b in batches:
            ok = np.asarray(b.column(b.num_columns - 1).to_numpy(zero_copy_only=False), bool)
            cell, dist = np.full(b.num_rows, -1, np.int32), np.full(b.num_rows, np.nan)
            code, error = [None] * b.num_rows, [None] * b.num_rows
            if ok.any() and len(c):
                at = np.flatnonzero(ok)
                x = _rows_of(b.filter(pa.array(ok)), vec_col, dim)
                for s in _steps(len(at), dim, len(c)):
                    near = _nearest(x[s], c)
                    r = x[s] - c[near]
                    cell[at[s]], dist[at[s]] = near, np.sqrt(np.einsum("ij,ij->i", r, r))
                    if q is not None:
                        for i, a, e in zip(at[s], *q.encode(r)):
                            code[i], error[i] = a.tobytes(), e.tobytes()
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(code, pa.binary()), pa.array(error, pa.binary()), pa.array(dist, from_pandas=True), pa.array(cell)],
                [f.name for f in fields])

    rows.mapInArrow(assign, T.StructType(fields)).hint("rebalance", "cell").write.partitionBy("cell").parquet(f"{path}/data")
    table = spark.read.schema(T.StructType(fields)).parquet(f"{path}/data")
    sizes = table.groupBy("cell").agg(F.count(F.lit(1)).alias("num_rows"), F.min("_dist").alias("least"), F.max("_dist").alias("largest"))
    known = spark.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(centres)], "cell int, centroid array<double>")
    sizes.filter("cell >= 0").join(known, "cell", "right").fillna(0, ["num_rows"]).coalesce(1).write.parquet(f"{path}/cells")
    if quantiser is not None:
        spark.createDataFrame([(quantiser.centroids.astype("<f8").tobytes(), quantiser.step.astype("<f8").tobytes())], "centroids binary, step binary") \
            .coalesce(1).write.parquet(f"{path}/quantiser")
    return T.StructType(fields)


def _load_cells(spark: SparkSession, index: IvfIndex):
    rows = index.cells(spark).orderBy("cell").collect()  # at most MAX_CELLS
    centres = np.array([r.centroid for r in rows], np.float64).reshape(len(rows), index.dim)
    inf = float("inf")
    return centres, np.array([inf if r.least is None else r.least for r in rows]), np.array([-inf if r.largest is None else r.largest for r in rows])


def _load_quantiser(spark: SparkSession, index: IvfIndex) -> Quantiser:
    r = spark.read.parquet(f"{index.path}/quantiser").first()
    step = np.frombuffer(r.step, "<f8")
    return Quantiser(np.frombuffer(r.centroids, "<f8").reshape(len(step), 256, -1), step)


def calibrated(spark: SparkSession, index: IvfIndex, target: float, k: int, queries: int = CALIBRATION_QUERIES) -> int:
    """The smallest number of probes that finds the share ``target`` of the true neighbours of a sample of rows."""
    if index.nlist <= 1:
        return index.nlist
    table = index.table(spark).filter("cell >= 0")
    q = (table.orderBy(F.xxhash64(index.id_col, F.lit("calibration")), index.id_col).limit(queries)
         .select(F.col(index.id_col).alias("qid"), F.col(index.vec_col).alias("qv")))
    drawn = q.collect()  # ``queries`` rows
    q = spark.createDataFrame(drawn, q.schema)
    near = top_k(table, q, k=k + 1, id_col=index.id_col, vec_col=index.vec_col)  # the query itself is one of them
    near = near.filter(F.col("qid") != F.col(index.id_col))
    hits = near.join(table.select(index.id_col, "cell"), index.id_col).select("qid", "cell").collect()  # queries x k
    centres, _, _ = _load_cells(spark, index)
    x = {r.qid: np.array(r.qv, np.float64) for r in drawn}
    rank = np.array([int((((centres - x[h.qid]) ** 2).sum(axis=1) < ((centres[h.cell] - x[h.qid]) ** 2).sum()).sum()) for h in hits])
    if not len(rank):
        return index.nlist
    return int(np.sort(rank)[min(len(rank) - 1, math.ceil(target * len(rank)))]) + 1


class Tops:
    """The k best (key, id) of each query of each search; keys as in ``knn``: lower is better.  Rows may carry a number along."""

    def __init__(self, searches: int, queries: int, k: int):
        self.k = k
        self.keys = np.full((searches, queries, k), np.inf)
        self.ids: np.ndarray | None = None
        self.extra: np.ndarray | None = None

    def add(self, s: int, at: np.ndarray, keys: np.ndarray, ids: np.ndarray, extra: np.ndarray | None = None) -> None:
        """Rows ``ids`` with ``keys`` [query, row] for the queries ``at`` of search ``s``; infinite keys are no hits."""
        better = np.flatnonzero((keys.min(axis=1, initial=np.inf) <= self.keys[s, at].max(axis=1)) & np.isfinite(keys).any(axis=1))
        if not len(better):
            return
        if self.ids is None:
            self.ids = np.zeros(self.keys.shape, ids.dtype)
            self.extra = None if extra is None else np.zeros(self.keys.shape)
        elif ids.dtype != self.ids.dtype:
            self.ids = self.ids.astype(np.result_type(ids.dtype, self.ids.dtype))
        at, keys = at[better], keys[better]
        both = np.hstack([self.keys[s, at], keys])
        held = self.ids[s, at]

        def ids_of(r, cols):
            return np.array([held[r, c] if c < self.k else ids[c - self.k] for c in cols])

        sel = _select(both, ids_of, self.k)
        old, new = np.minimum(sel, self.k - 1), np.maximum(sel - self.k, 0)
        self.keys[s, at] = np.take_along_axis(both, sel, 1)
        self.ids[s, at] = np.where(sel < self.k, np.take_along_axis(held, old, 1), ids[new])
        if extra is not None:
            self.extra[s, at] = np.where(sel < self.k, np.take_along_axis(self.extra[s, at], old, 1), np.take_along_axis(extra[better], new, 1))

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(search, query, key, id) of all hits."""
        s, q, r = np.nonzero(np.isfinite(self.keys))
        return s, q, self.keys[s, q, r], self.ids[s, q, r] if len(s) else np.zeros(0, np.int64)

    def payload(self) -> np.ndarray:
        """What the rows of ``rows`` carried."""
        found = np.isfinite(self.keys)
        return self.extra[found] if self.extra is not None else np.zeros(0)


def _cell_runs(b: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    cells = b.column(b.schema.get_field_index("cell")).to_numpy(zero_copy_only=False)
    cut = np.concatenate([[0], np.flatnonzero(cells[1:] != cells[:-1]) + 1, [len(cells)]])
    for lo, hi in zip(cut[:-1], cut[1:]):
        if hi > lo:
            yield int(cells[lo]), b.slice(int(lo), int(hi - lo))


def _pass_queries(qpass: DataFrame, dim: int):
    rows = qpass.select("qid", "qv").collect()  # bounded by query_passes
    if any(len(r.qv) != dim for r in rows):
        raise ValueError("queries and index must have one dimension")
    return [r.qid for r in rows], np.array([r.qv for r in rows], np.float64).reshape(len(rows), dim)


def probe_order(q: np.ndarray, centres: np.ndarray, most: int) -> np.ndarray:
    """[query, rank] -> cell, the nearest first, ties by number."""
    out = np.empty((len(q), min(most, len(centres))), np.int64)
    step = max(1, BLOCK_CELLS // max(len(centres), 1))
    for lo in range(0, len(q), step):
        p = q[lo:lo + step]
        d = (centres * centres).sum(axis=1)[None, :] - 2.0 * p @ centres.T
        out[lo:lo + step] = np.argsort(d, axis=1, kind="stable")[:, :most]
    return out


def search_settings(spark: SparkSession, index: IvfIndex, queries: DataFrame, nprobes: list[int], filters: dict[str, Column | None] | None = None, *,
                    k: int = 10, metric: str = "L2", table: DataFrame | None = None, scored=None) -> DataFrame:
    """Every filter with every number of probes in one scan of the probed cells: (filter_name, nprobe, qid, id, score, rank).

    ``table`` replaces the indexed rows, for instance with later ones added.  ``scored``, an accumulator, counts the scores computed."""
    filters = filters or {"none": None}
    names, metric = list(filters), metric.upper()
    qid_type = queries.schema["qid"].dataType
    rows = index.table(spark) if table is None else table
    id_type = rows.schema[index.id_col].dataType
    out_type = T.StructType([T.StructField("search", T.IntegerType()), T.StructField("qid", qid_type), T.StructField(index.id_col, id_type),
                             T.StructField("score", T.DoubleType())])
    masks = [F.lit(True) if c is None else F.coalesce(c, F.lit(False)) for c in filters.values()]
    any_mask = masks[0]
    for m in masks[1:]:
        any_mask = any_mask | m
    rows = rows.filter(any_mask & F.col(index.id_col).isNotNull()).select(index.id_col, index.vec_col, "cell", *[m.alias(f"_f{i}") for i, m in enumerate(masks)])
    centres, _, _ = _load_cells(spark, index)
    found = None
    passes = query_passes(queries.filter(F.col("qv").isNotNull()).select("qid", "qv"), "qid", index.dim) if index.nlist else []
    for qpass in passes:
        qids, q = _pass_queries(qpass, index.dim)
        order = probe_order(q, centres, max(nprobes))
        lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        flat, rank = order.ravel(), np.tile(np.arange(order.shape[1]), len(q))
        who = np.repeat(np.arange(len(q)), order.shape[1])
        by = np.argsort(flat, kind="stable")
        for cell, part in zip(*_groups(flat[by])):
            lists[int(cell)] = (who[by][part], rank[by][part])
        shared = spark.sparkContext.broadcast((qids, q, lists))
        read = rows.filter(F.col("cell").isin([int(c) for c in lists]))  # at most MAX_CELLS; prunes folders
        part = read.mapInArrow(_list_scan(shared, index, metric, k, nprobes, len(names), _arrow_type(qid_type), _arrow_type(id_type), scored), out_type)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], out_type)
    order_by = F.col("score").asc() if ASCENDING[metric] else F.col("score").desc()
    best = Window.partitionBy("search", "qid").orderBy(order_by, F.col(index.id_col).asc())
    found = found.withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= k)
    named = F.array(*[F.lit(n) for n in names])[F.floor(F.col("search") / len(nprobes)).cast("int")]
    probes = F.array(*[F.lit(p) for p in nprobes])[F.col("search") % len(nprobes)]
    return found.select(named.alias("filter_name"), probes.alias("nprobe"), "qid", index.id_col, "score", "rank")


def _groups(ordered: np.ndarray):
    """Values of a sorted array and the slices they fill."""
    cut = np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1, [len(ordered)]])
    parts = [slice(int(a), int(b)) for a, b in zip(cut[:-1], cut[1:]) if b > a]
    return [ordered[p.start] for p in parts], parts


def _list_scan(shared, index: IvfIndex, metric: str, k: int, nprobes: list[int], filters: int, qid_type, id_type, scored):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, q, lists = shared.value
        shift = q.mean(axis=0) if metric == "L2" else 0.0
        qs = q - shift
        norms = np.einsum("ij,ij->i", qs, qs)
        tops = Tops(filters * len(nprobes), len(q), k)
        few = np.argsort(nprobes, kind="stable")
        for b in batches:
            for cell, part in _cell_runs(b):
                who, rank = lists.get(cell, (np.zeros(0, int), None))
                if not len(who):
                    continue
                ids = part.column(0).to_numpy(zero_copy_only=False)
                x = _rows_of(part, index.vec_col, index.dim) - shift
                masks = [np.asarray(part.column(3 + f).to_numpy(zero_copy_only=False), bool) for f in range(filters)]
                # of the settings that probe this cell, the one with the fewest probes has the loosest k-th key
                loose = few[np.searchsorted(np.array(nprobes)[few], rank, side="right")]
                for s in _steps(len(ids), index.dim, len(who)):
                    for f, m in enumerate(masks):
                        at = np.flatnonzero(m[s])
                        if not len(at):
                            continue
                        if scored is not None:
                            scored.add(len(who) * len(at))
                        keys = _dense_keys(metric, qs[who], norms[who], x[s][at], tops.keys[f * len(nprobes) + loose, who], k, None)
                        for n, most in enumerate(nprobes):
                            use = rank < most
                            if use.any():
                                tops.add(f * len(nprobes) + n, who[use], keys[use], ids[s][at])
        s, qi, key, ids = tops.rows()
        yield pa.RecordBatch.from_arrays([pa.array(s.astype(np.int32)), pa.array([qids[i] for i in qi], qid_type), pa.array(ids, id_type),
                                          pa.array(key if ASCENDING[metric] else -key)], ["search", "qid", index.id_col, "score"])

    return run


def search(spark: SparkSession, index: IvfIndex, queries: DataFrame, *, k: int = 10, nprobe: int | None = None, metric: str = "L2",
           where: Column | None = None, table: DataFrame | None = None, scored=None) -> DataFrame:
    """The k best rows of the ``nprobe`` nearest cells (by default as many as the index measured): (qid, id, score, rank)."""
    found = search_settings(spark, index, queries, [nprobe or max(index.nprobe, 1)], {"": where}, k=k, metric=metric, table=table, scored=scored)
    return found.drop("filter_name", "nprobe")


def exact_search(spark: SparkSession, index: IvfIndex, queries: DataFrame, *, k: int = 10, first_probe: int | None = None, scored=None) -> DataFrame:
    """The exact k nearest rows (L2): a first probe bounds each query's k-th distance, cells and rows beyond it drop out
    by centres, radii and codes, the rest is scored.  ``scored`` counts the exact scores of the second part."""
    if not index.sub_spaces:
        raise ValueError("the index has no codes")
    probe = first_probe or max(1, index.nprobe // 4)
    qid_type = queries.schema["qid"].dataType
    table = index.table(spark)
    id_type = table.schema[index.id_col].dataType
    out_type = T.StructType([T.StructField("qid", qid_type), T.StructField(index.id_col, id_type), T.StructField("score", T.DoubleType())])
    centres, least, largest = _load_cells(spark, index)
    quantiser = _load_quantiser(spark, index)
    found = None
    for qpass in query_passes(queries.filter(F.col("qv").isNotNull()).select("qid", "qv"), "qid", index.dim):
        qids, q = _pass_queries(qpass, index.dim)
        local = spark.createDataFrame(list(zip(qids, q.tolist())), T.StructType([T.StructField("qid", qid_type), T.StructField("qv", T.ArrayType(T.DoubleType()))]))
        kth = {r.qid: r.score for r in search(spark, index, local, k=k, nprobe=probe).filter(F.col("rank") == k).collect()}  # one row per query
        bound = np.array([kth.get(i, np.inf) for i in qids]) * (1 + 1e-9)
        reach: dict[int, np.ndarray] = {}
        for c in range(len(centres)):
            if np.isfinite(least[c]):
                away = np.sqrt(((q - centres[c]) ** 2).sum(axis=1))
                gap = np.maximum(np.maximum(away - largest[c], least[c] - away), 0.0)
                near = np.flatnonzero((gap * (1 - 1e-9)) ** 2 <= bound)
                if len(near):
                    reach[c] = near
        shared = spark.sparkContext.broadcast((qids, q, bound, reach, centres, quantiser))
        read = table.filter(F.col("cell").isin(list(reach)) & F.col(index.id_col).isNotNull()).select(index.id_col, index.vec_col, "cell", "_code", "_error")
        part = read.mapInArrow(_code_scan(shared, index, k, _arrow_type(qid_type), _arrow_type(id_type), scored), out_type)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], out_type)
    best = Window.partitionBy("qid").orderBy("score", F.col(index.id_col).asc())
    return found.withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= k)


def _code_scan(shared, index: IvfIndex, k: int, qid_type, id_type, scored):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, q, bound, reach, centres, quantiser = shared.value
        m, _, w = quantiser.centroids.shape
        tops = Tops(1, len(q), k)
        for b in batches:
            for cell, part in _cell_runs(b):
                who = reach.get(cell)
                if who is None:
                    continue
                ids = part.column(0).to_numpy(zero_copy_only=False)
                x = _rows_of(part, index.vec_col, index.dim)
                codes = np.frombuffer(b"".join(part.column(3).to_pylist()), np.uint8).reshape(-1, m)
                far = quantiser.bounds(np.frombuffer(b"".join(part.column(4).to_pylist()), np.uint8).reshape(-1, m))
                r = (q[who] - centres[cell]).reshape(len(who), m, w)
                dist = np.sqrt(((r[:, :, None, :] - quantiser.centroids[None]) ** 2).sum(axis=-1))  # [query, sub-space, code]
                for s in _steps(len(ids), index.dim, len(who)):
                    low = np.zeros((len(who), len(ids[s])))
                    for j in range(m):
                        low += np.maximum(dist[:, j, :][:, codes[s, j]] - far[s, j], 0.0) ** 2
                    top = np.minimum(bound[who], tops.keys[0, who].max(axis=1) * (1 + 1e-9))
                    i, j = np.nonzero(low * (1 - 1e-9) <= top[:, None])
                    if scored is not None:
                        scored.add(len(i))
                    keys = np.full(low.shape, np.inf)
                    step = max(1, BLOCK_CELLS // index.dim)
                    for lo in range(0, len(i), step):
                        a, z = i[lo:lo + step], j[lo:lo + step]
                        d = q[who[a]] - x[s][z]
                        keys[a, z] = np.einsum("ij,ij->i", d, d)
                    tops.add(0, who, keys, ids[s])
        _, qi, key, ids = tops.rows()
        yield pa.RecordBatch.from_arrays([pa.array([qids[i] for i in qi], qid_type), pa.array(ids, id_type), pa.array(key)],
                                         ["qid", index.id_col, "score"])

    return run
