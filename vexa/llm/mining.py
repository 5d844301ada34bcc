"""Hard negatives by angular triangle filtering (operator 11).

A vector's entries become integers, ``floor(scale * x)``, and a score is an integer inner product.
Every row stores its norm and its angles to a few reference directions.  For an anchor a and a row x at
angles t(a), t(x) to a reference, the angle between a and x lies in
[|t(a) - t(x)|, min(t(a) + t(x), 2 pi - t(a) - t(x))]; the tightest interval over all references, as cosines
and multiplied by both norms, bounds the score.  Angles are widened by ``SLACK`` and scores by a relative
``ROUND`` plus one, far above any rounding, so a bound never excludes a true result.

Rows are sorted by their nearest reference and the angle to it and cut into windows of ``window_rows``
neighbours, each with the intervals of its rows' angles and norms.  An anchor computes integer scores
only for windows whose score bounds overlap the scores it still needs: from the worst score kept
so far to the largest score allowed.  What it needs starts from its scores on a bounded sample of rows (a lower
bound only: every row is still searched) and rises as windows are read.

The anchors, not the rows, are broadcast, in passes of at most ``pass_bytes``; each pass reads the rows once and
appends its own result, so neither the driver nor a task ever holds all anchors.  A task returns at most ``k``
rows per anchor and search, and a window of Spark over these picks the best.  Rows are range
partitioned by (length, reference, angle, row), so that copies of one vector spread over tasks.

Results for odd input.  Rows with a null label, a null vector, or a null or non-finite component take no
part.  Integer entries are limited to the range in which no score can leave a long (for 64 dimensions
beyond 2**28, that is entries beyond a million).  Vectors of different lengths are never compared; empty vectors score 0
with each other.  Repeated rows and repeated ids are separate rows (an anchor's own copy can be its positive); rows with
a null id are never excluded and sort last among ties, their id being returned as null.  An empty table gives an
empty result.  Other columns are ignored whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vexa.llm import common as C
from vexa.session import scratch_path

SLACK = 1e-6
ROUND = 1e-9
LEAST, MOST = -(1 << 62), 1 << 62  # scores lie strictly between
CELLS = 1 << 20  # scores held at once


def entry_limit(dim: int) -> float:
    """Largest integer entry: ``dim`` products of two of them stay below 2**62."""
    return float(min((1 << 31) - 1, math.isqrt((1 << 62) // max(dim, 1)) - 1))


def usable(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, anchor: Column) -> DataFrame:
    """(_uid, id, label, anchor, v) of the rows that take part; ``vectors`` has ``_uid``."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (vectors.filter(F.coalesce(fine, F.lit(False)) & F.col(label_col).isNotNull())
            .select(C.UID, F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                    F.coalesce(anchor, F.lit(False)).alias("anchor"), v.alias("v")))


def _integers(v: pa.Array, scale: float) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, integer entries as doubles) for each length in an array of vectors."""
    lens = np.asarray(v.value_lengths(), np.int64)
    flat = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    first = np.cumsum(lens) - lens
    out = []
    for dim in np.unique(lens):
        at = np.flatnonzero(lens == dim)
        with np.errstate(over="ignore"):
            x = np.floor(scale * flat[first[at][:, None] + np.arange(dim)[None, :]])
        out.append((int(dim), at, np.clip(x, -entry_limit(int(dim)), entry_limit(int(dim)))))
    return out


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
    return x / np.where(norm == 0, 1.0, norm)[:, None], norm


def reference_directions(sample: list[tuple[int, np.ndarray]], directions: int) -> dict[int, np.ndarray]:
    """By length: unit vectors of the sample, each as far from the earlier ones as possible."""
    out = {}
    for dim, x in sample:
        u, norm = _unit(x)
        u = u[norm > 0]
        if not dim or not len(u):
            continue
        near = u @ u[0]
        chosen = [0]
        while len(chosen) < min(directions, len(u)):
            chosen.append(int(near.argmin()))
            near = np.maximum(near, u @ u[chosen[-1]])
        out[dim] = u[chosen]
    return out


def angles(x: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(norms, angles to the references); a zero vector is at a right angle to everything."""
    u, norm = _unit(x)
    return norm, np.arccos(np.clip(u @ refs.T, -1.0, 1.0))


def _positions(rows: DataFrame, refs, scale: float) -> DataFrame:
    """Rows as (_uid, id, label, anchor, dim, cell, angle, x): integer entries packed as int32, the nearest reference
    and the angle to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            dims, cell, angle, x = np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n), [b""] * n
            for dim, at, ints in _integers(b.column(b.schema.get_field_index("v")), scale):
                dims[at] = dim
                if dim in refs.value:
                    _, t = angles(ints, refs.value[dim])
                    cell[at] = t.argmin(axis=1)
                    angle[at] = t.min(axis=1)
                for i, row in zip(at, ints.astype("<i4")):
                    x[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(dims), pa.array(cell), pa.array(angle), pa.array(x, pa.binary())],
                                             [*b.schema.names[:4], "dim", "cell", "angle", "x"])

    kept = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes[:4])
    return rows.mapInArrow(run, f"{kept}, dim int, cell int, angle double, x binary")


@dataclass
class Anchors:
    """Anchors of one length; ``lo`` and ``hi`` [anchor, search] bound the scores that a search accepts."""

    uid: np.ndarray
    label: np.ndarray
    x: np.ndarray
    lo: np.ndarray
    hi: np.ndarray

    def bounds(self, refs: np.ndarray, t: np.ndarray, norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest possible score of each anchor with the rows of a window."""
        if not hasattr(self, "_angles"):
            self._norm, self._angles = angles(self.x, refs)
        a, t0, t1 = self._angles, t.min(axis=0), t.max(axis=0)
        near = np.maximum(np.maximum(t0 - a, a - t1).max(axis=1) - SLACK, 0.0)
        ends = np.minimum(np.maximum(np.minimum(a + t0, 2 * np.pi - a - t0), np.minimum(a + t1, 2 * np.pi - a - t1)), np.pi)
        ends = np.where((a + t0 <= np.pi) & (a + t1 >= np.pi), np.pi, ends)
        far = np.minimum(ends.min(axis=1) + SLACK, np.pi)
        top, low = np.cos(near), np.cos(far)
        n0, n1 = norm.min(), norm.max()
        high = self._norm * np.where(top >= 0, n1, n0) * top
        least = self._norm * np.where(low >= 0, n0, n1) * low
        room = ROUND * self._norm * n1 + 1.0
        return least - room, high + room


class Best:
    """The ``k`` best (score, then smallest uid) of each search of each anchor."""

    def __init__(self, anchors: Anchors, k: int):
        shape = (*anchors.lo.shape, k)
        self.lo, self.hi, self.k = anchors.lo, anchors.hi, k
        self.score, self.uid = np.full(shape, LEAST), np.full(shape, np.iinfo(np.int64).max)

    def floor(self) -> np.ndarray:
        """[anchor, search]: scores below this are of no use."""
        return np.maximum(self.score[:, :, -1], self.lo)

    def add(self, i: np.ndarray, score: np.ndarray, uid: np.ndarray) -> None:
        floor = self.floor()
        for s in range(self.lo.shape[1]):
            use = (score >= floor[i, s]) & (score <= self.hi[i, s])
            if not use.any():
                continue
            touched = np.unique(i[use])
            held = self.score[touched, s] > LEAST
            a = np.concatenate([np.repeat(touched, self.k)[held.ravel()], i[use]])
            sc = np.concatenate([self.score[touched, s][held], score[use]])
            ids = np.concatenate([self.uid[touched, s][held], uid[use]])
            order = np.lexsort((ids, -sc, a))
            a, sc, ids = a[order], sc[order], ids[order]
            rank = np.arange(len(a)) - np.searchsorted(a, a)
            keep = rank < self.k
            self.score[a[keep], s, rank[keep]] = sc[keep]
            self.uid[a[keep], s, rank[keep]] = ids[keep]


def products(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products of integers held as doubles."""
    if a.shape[1] * np.abs(a).max(initial=0.0) * np.abs(x).max(initial=0.0) < 2.0 ** 53:
        return (a @ x.T).astype(np.int64)
    return a.astype(np.int64) @ x.astype(np.int64).T


def search_window(anchors: Anchors, best: Best, which: np.ndarray, x: np.ndarray, uid: np.ndarray, label: np.ndarray,
                  same: bool) -> None:
    """Score the anchors ``which`` with the rows of a window."""
    step = max(1, CELLS // max(len(uid), 1))
    for lo in range(0, len(which), step):
        w = which[lo:lo + step]
        s = products(anchors.x[w], x)
        floor, top = best.floor()[w].min(axis=1), best.hi[w].max(axis=1)
        ok = (s >= floor[:, None]) & (s <= top[:, None])
        if same:
            ok &= (anchors.label[w][:, None] == label[None, :]) & (anchors.uid[w][:, None] != uid[None, :])
        else:
            ok &= anchors.label[w][:, None] != label[None, :]
        i, j = np.nonzero(ok)
        if len(i):
            best.add(w[i], s[i, j], uid[j])


def _vectors(col: pa.Array, dim: int) -> np.ndarray:
    blob, _ = C.column_bytes(col)
    return np.ascontiguousarray(blob).view("<i4").reshape(-1, dim).astype(np.float64) if dim else np.zeros((len(col), 0))


def _scan(shared, refs, k: int, same: bool, window_rows: int):
    """Task: windows of sorted rows against the anchors of one pass; (kind, anchor, search, score, _uid) and, with a null anchor, the
    number of scores computed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[int, Anchors] = shared.value
        best = {d: Best(a, k) for d, a in groups.items()}
        scored = 0
        for b in batches:
            if not b.num_rows:
                continue
            dims, cells = C.longs(b, "dim"), C.longs(b, "cell")
            uid, label = C.longs(b, C.UID), C.longs(b, "label")
            xs = b.column(b.schema.get_field_index("x"))
            cut = np.flatnonzero((dims[1:] != dims[:-1]) | (cells[1:] != cells[:-1])) + 1
            for s, e in zip(np.concatenate([[0], cut]), np.concatenate([cut, [len(dims)]])):
                dim = int(dims[s])
                if dim not in groups:
                    continue
                a = groups[dim]
                for lo in range(int(s), int(e), window_rows):
                    hi = min(lo + window_rows, int(e))
                    x = _vectors(xs.slice(lo, hi - lo), dim)
                    which = np.arange(len(a.uid))
                    if dim in refs.value:
                        norm, t = angles(x, refs.value[dim])
                        low, high = a.bounds(refs.value[dim], t, norm)
                        which = np.flatnonzero((high >= best[dim].floor().min(axis=1)) & (low <= a.hi.max(axis=1)))
                    scored += len(which) * (hi - lo)
                    search_window(a, best[dim], which, x, uid[lo:hi], label[lo:hi], same)
        for dim, a in groups.items():
            i, s, r = np.nonzero(best[dim].score > LEAST)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.uid[i]), pa.array(s.astype(np.int32)), pa.array(best[dim].score[i, s, r]), pa.array(best[dim].uid[i, s, r])],
                ["anchor", "search", "score", C.UID])
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([-1], pa.int32()), pa.array([scored]), pa.array([0])],
                                         ["anchor", "search", "score", C.UID])

    return run


def _anchor_groups(table: pa.Table, windows) -> dict[int, Anchors]:
    """Anchors by length; ``windows(table)`` gives the (lo, hi) score bounds of their searches."""
    lo, hi = windows(table)
    dims, uid, label = C.longs(table, "dim"), C.longs(table, C.UID), C.longs(table, "label")
    x = table.column("x").combine_chunks()
    out = {}
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        out[int(dim)] = Anchors(uid[at], label[at], _vectors(x.take(pa.array(at)), int(dim)), lo[at], hi[at])
    return out


def _best_rows(rows: DataFrame, anchors: DataFrame, refs, sample, windows, searches: int, k: int, same: bool,
               window_rows: int, pass_bytes: int, name: str) -> tuple[DataFrame, int]:
    """(anchor, search, rank, score, _uid) of the best ``k`` rows of each search, and the number of scores computed."""
    spark = rows.sparkSession
    n, entries = anchors.agg(F.count(F.lit(1)), F.sum("dim")).first()
    each = 8 * 32 + 16 * searches * (k + 2)  # angles, bounds and what is kept
    passes = max(1, math.ceil((8 * (entries or 0) + each * n) / pass_bytes))
    path = scratch_path(spark, name)
    schema = f"anchor long, search int, score long, {C.UID} long"
    for p in range(passes):
        part = anchors.filter(F.pmod(F.xxhash64(C.UID), F.lit(passes)) == p)
        groups = _anchor_groups(part.toArrow(), windows)
        for dim, a in groups.items():  # scores on the sample bound from below what is needed
            if dim in sample:
                uid, label, x = sample[dim]
                seed = Best(a, k)
                search_window(a, seed, np.arange(len(a.uid)), x, uid, label, same)
                a.lo = seed.floor()
        shared = spark.sparkContext.broadcast(groups)
        rows.mapInArrow(_scan(shared, refs, k, same, window_rows), schema).write.mode("append").parquet(path)
        shared.destroy()
    found = spark.read.schema(schema).parquet(path)
    scored = found.filter("anchor IS NULL").agg(F.sum("score")).first()[0] or 0
    best = Window.partitionBy("anchor", "search").orderBy(F.col("score").desc(), C.UID)
    return (found.filter("anchor IS NOT NULL").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("anchor", "search", "rank", "score", C.UID), scored)


def hard_negatives(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                   scale: float = 256.0, positives: int = 5, negatives: int = 3, directions: int = 16, sample_rows: int = 1024,
                   window_rows: int = 256, pass_bytes: int = 32 << 20, figures: dict | None = None) -> DataFrame:
    """For each anchor row and each of its first ``positives`` rows of the same label, the first ``negatives`` rows of other
    labels that score from half to 95 % of the positive's score: (anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score).  Higher scores come first, ties by the smaller id.

    ``vectors`` has ``_uid`` (see ``common.identified``).  ``directions``, ``sample_rows`` and ``window_rows`` affect the amount
    of work only.  ``figures``, if given, receives the numbers of rows, anchors and scores computed in both searches."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vec_col, label_col, anchor)
    rows = rows.withColumn("label", F.col("label").cast("long"))
    drawn = rows.orderBy(F.xxhash64(C.UID), C.UID).limit(sample_rows).toArrow()
    sample, lengths = {}, []
    if drawn.num_rows:
        for dim, at, ints in _integers(drawn.column("v").combine_chunks(), scale):
            sample[dim] = (C.longs(drawn, C.UID)[at], C.longs(drawn, "label")[at], ints)
            lengths.append((dim, ints))
    refs = spark.sparkContext.broadcast(reference_directions(lengths, directions))
    keys = ["dim", "cell", "angle", C.UID]
    placed = C.save(_positions(rows, refs, scale).repartitionByRange(C.shuffle_partitions(spark), *keys)
                    .sortWithinPartitions(*keys), "mining-rows")
    anchors = placed.filter("anchor")

    def open_windows(t: pa.Table):
        return np.full((t.num_rows, 1), LEAST + 1), np.full((t.num_rows, 1), MOST)

    near, scored1 = _best_rows(placed, anchors, refs, sample, open_windows, 1, positives, True, window_rows, pass_bytes, "mining-positives")
    near = C.save(near, "mining-near")
    lists = (near.groupBy(F.col("anchor").alias(C.UID)).agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("pos"))
             .select(C.UID, F.transform("pos", lambda p: p["score"]).alias("pos")))  # at most ``positives`` scores
    asked = C.save(anchors.join(lists, C.UID), "mining-asked")

    def score_windows(t: pa.Table):
        lo, hi = np.full((t.num_rows, positives), MOST), np.full((t.num_rows, positives), LEAST)
        for i, scores in enumerate(t.column("pos").to_pylist()):
            for s, p in enumerate(scores):
                if p >= 0:  # a negative score has no window
                    lo[i, s], hi[i, s] = (p + 1) // 2, p - (p + 19) // 20
        return lo, hi

    far, scored2 = _best_rows(placed, asked, refs, sample, score_windows, positives, negatives, False, window_rows, pass_bytes, "mining-negatives")
    if figures is not None:
        figures.update(rows=placed.count(), anchors=anchors.count(), scored_positives=scored1, scored_negatives=scored2)
    ids = placed.select(C.UID, "id")
    pos = near.select("anchor", (F.col("rank") - 1).alias("search"), F.col("score").alias("positive_score"), F.col(C.UID).alias("_pos"))
    neg = far.select("anchor", "search", "rank", F.col("score").alias("negative_score"), F.col(C.UID).alias("_neg"))

    def named(df: DataFrame, key: str, name: str) -> DataFrame:
        return df.join(ids.select(F.col(C.UID).alias(key), F.col("id").alias(name)), key)

    out = named(named(named(pos.join(neg, ["anchor", "search"]), "anchor", "anchor_id"), "_pos", "positive_id"), "_neg", "negative_id")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
