"""Embedding whitening by Chebyshev-filtered subspace iteration (operator 13).

Every entry c becomes the integer ``floor(scale * c)``.  A constant added to every entry would change no result, as all depend on
differences from the mean, so none is stored.  The fit list holds each distinct integer vector once.  Its count n and its
sums S are exact, and a vector x is centred by the exact integer ``n * x - S``, divided by n, before anything is multiplied.

The covariance matrix V is never formed.  A pass sends a block Q of a few columns to the tasks; each returns the sum of
x'(x Q) over its centred vectors, these are added by row ranges in a second small stage, and only V Q (dimensions x columns)
reaches the driver.  A round of the iteration

1. takes Ritz values and vectors of the block (Rayleigh-Ritz on Q'VQ),
2. damps the unwanted spectrum [0, a], a being the least Ritz value of the block (fresh columns apart), by a Chebyshev
   polynomial in V applied through its three-term recurrence, one pass per degree; the degree is limited so that the
   largest eigenvalue is not raised above the others by more than ``GROWTH``,
3. orthonormalises the result by QR, largest eigenvalue first, with fresh random columns, so that a direction
   missing from the block can enter.

It ends when it is certified: the residuals |V q - e q| of the wanted columns are at the level of rounding, in
two rounds between which fresh columns were added without a larger eigenvalue appearing.  If the rounds run out first,
``NotCertified`` is raised.

Results for odd input.  Vectors that are null or hold null or non-finite entries are dropped.  Vectors of each length are
whitened on their own (their own fit list, n, and components).  Entries beyond 2**31 / scale are limited to that.  Components whose
variance is zero up to rounding do not exist: a table of one distinct vector, of empty vectors, or without rows gives no rows, one whose
vectors span fewer dimensions gives fewer components.  Where eigenvalues are equal, any orthonormal basis of their space
is returned, the same for all rows.  Repeated rows count once in the fit and are all returned; ids may be null or repeated.
``deviation`` is null where the exact sum does not fit a long.  Other columns are ignored whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vexa.llm import common as C

GROWTH = 1e8
BLOCK_ENTRIES = 1 << 18  # entries centred at once in a task
ROWS_PER_CHUNK = 512  # dimensions added by one task of the second stage


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col(vec_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.filter(F.coalesce(fine, F.lit(False))).select(F.col(id_col).alias("id"), v.alias("v"))


def integers(rows: DataFrame, scale: float) -> DataFrame:
    """(id, dim, z): the integer entries packed as int32."""
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column(1)
            lens = np.asarray(v.value_lengths(), np.int64) if b.num_rows else np.zeros(0, np.int64)
            flat = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            with np.errstate(over="ignore"):
                z = np.clip(np.floor(scale * flat), -(2.0 ** 31), 2.0 ** 31 - 1).astype("<i4")
            offs = np.concatenate([[0], np.cumsum(lens)]) * 4
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lens.astype(np.int32)), C.binary_column(z.view(np.uint8), offs)],
                                             ["id", "dim", "z"])

    return rows.mapInArrow(run, f"id {id_type}, dim int, z binary")


def _matrices(batches: Iterator[pa.RecordBatch], dim: int, entries: int = BLOCK_ENTRIES) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Runs of rows with their integer vectors as int64 [row, dimension]."""
    step = max(1, entries // max(dim, 1))
    for b in batches:
        for lo in range(0, b.num_rows, step):
            part = b.slice(lo, step)
            blob, _ = C.column_bytes(part.column(part.schema.get_field_index("z")))
            yield part, np.ascontiguousarray(blob).view("<i4").reshape(-1, dim).astype(np.int64)


@dataclass
class Moments:
    n: int
    sums: np.ndarray  # object: exact integers
    largest: int      # largest entry by size

    def deviations(self, z: np.ndarray) -> np.ndarray:
        """n * z - S: exact, as int64 where that cannot overflow."""
        if 2 * self.n * self.largest < 1 << 62:
            return self.n * z - self.sums.astype(np.int64)
        return self.n * z.astype(object) - self.sums

    def centred(self, z: np.ndarray) -> np.ndarray:
        return (self.deviations(z) / self.n).astype(np.float64)


def moments(fit: DataFrame, dim: int) -> Moments:
    """Exact count and sums; a task returns one packed row of partial sums, added in a second stage of one task."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, most, total = 0, 0, np.zeros(dim, object)
        for _, z in _matrices(batches, dim):
            n += len(z)
            total = total + z.sum(axis=0).astype(object)
            most = max(most, int(np.abs(z).max(initial=0)))
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([most]), pa.array([[str(t) for t in total]])], ["n", "most", "total"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, most, total = 0, 0, np.zeros(dim, object)
        for b in batches:
            for row in b.to_pylist():
                n, most = n + row["n"], max(most, row["most"])
                total = total + np.array([int(t) for t in row["total"]], object)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([most]), pa.array([[str(t) for t in total]])], ["n", "most", "total"])

    schema = "n long, most long, total array<string>"
    row = fit.mapInArrow(partial, schema).repartition(1).mapInArrow(add, schema).first()
    return Moments(row.n, np.array([int(t) for t in row.total], object), row.most)


def added(partials, rows: int, columns: int, fit: DataFrame) -> np.ndarray:
    """Sum over tasks of a [rows, columns] matrix: ``partials(batches)`` gives that of one task."""
    chunks = max(1, math.ceil(rows / ROWS_PER_CHUNK))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = partials(batches)
        for c in range(chunks):
            part = np.ascontiguousarray(m[c * ROWS_PER_CHUNK:(c + 1) * ROWS_PER_CHUNK])
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["chunk", "m"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for c, m in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                m = np.frombuffer(m, np.float64)
                held[c] = held[c] + m if c in held else m
        for c, m in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([m.tobytes()], pa.binary())], ["chunk", "m"])

    schema = "chunk int, m binary"
    parts = fit.mapInArrow(task, schema)
    # a single chunk needs no key: dealt by one, it could be spread over partitions that are empty but for it, and each starts a Python task
    dealt = parts.repartition(1) if chunks == 1 else parts.repartition(chunks, "chunk")
    got = dealt.mapInArrow(add, schema).collect()
    return np.concatenate([np.frombuffer(r.m, np.float64) for r in sorted(got, key=lambda r: r.chunk)]).reshape(rows, columns)


def covariance_times(fit: DataFrame, dim: int, mom: Moments, q: np.ndarray) -> np.ndarray:
    """V Q in one pass over the fit list."""
    shared = fit.sparkSession.sparkContext.broadcast((mom, q))

    def partials(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        m, block = shared.value
        total = np.zeros(block.shape)
        for _, z in _matrices(batches, dim):
            x = m.centred(z)
            total += x.T @ (x @ block)
        return total

    out = added(partials, dim, q.shape[1], fit) / mom.n
    shared.destroy()
    return out


def total_variance(fit: DataFrame, dim: int, mom: Moments) -> float:
    shared = fit.sparkSession.sparkContext.broadcast(mom)

    def partials(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        return np.array([[sum(float((shared.value.centred(z) ** 2).sum()) for _, z in _matrices(batches, dim))]])

    return float(added(partials, 1, 1, fit)[0, 0]) / mom.n


class NotCertified(RuntimeError):
    """The rounds ran out before the residuals reached the level of rounding."""


def _degree(largest: float, edge: float, most: int) -> int:
    """Largest degree whose polynomial, 1 at the edge, stays within GROWTH at the largest eigenvalue."""
    x = 2 * largest / edge - 1
    return most if x <= 1 else int(min(most, max(2, math.acosh(GROWTH) / math.acosh(x))))


def leading_eigenpairs(times, dim: int, trace: float, k: int, guards: int, fresh: int = 2, degree: int = 16,
                       max_rounds: int = 200, seed: int = 11, log: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric non-negative operator and unit eigenvectors as columns.

    ``times(Q)`` applies the operator.  Eigenvalues that are zero up to rounding are left out."""
    tiny = 64 * dim * np.finfo(float).eps * trace
    rng = np.random.default_rng(seed)
    width = min(dim, k + max(guards, fresh + 1))
    q = np.linalg.qr(rng.normal(size=(dim, width)))[0]
    vq = times(q)
    passes, done = 1, 0
    for _ in range(max_rounds):
        t = q.T @ vq
        e, u = np.linalg.eigh((t + t.T) / 2)
        e, u = e[::-1], u[:, ::-1]
        q, vq = q @ u, vq @ u
        wanted = int((e[:k] > tiny).sum())
        residual = np.linalg.norm(vq[:, :wanted] - q[:, :wanted] * e[:wanted], axis=0).max(initial=0.0)
        if log is not None:
            log.append((passes, residual / trace))
        done = done + 1 if residual <= 16 * math.sqrt(dim) * np.finfo(float).eps * max(e[0], tiny) else 0
        # a block of all dimensions leaves nothing outside; else fresh columns had a round to find more
        if done >= 2 or (done and width == dim):
            return e[:wanted], q[:, :wanted]
        if width < dim:
            edge = e[width - 1 - fresh]  # the last columns are fresh and tell little
            if edge > tiny:
                c = edge / 2
                old, now = q, (vq - c * q) / c
                for _ in range(_degree(e[0], edge, degree) - 1):
                    old, now = now, 2 * (times(now) - c * now) / c - old
                    passes += 1
            else:
                now = vq  # the block is wider than the operator's range
            now[:, width - fresh:] = rng.normal(size=(dim, fresh))
            size = np.linalg.norm(now, axis=0)
            q = np.where(size > tiny * np.finfo(float).eps, now / np.where(size == 0, 1.0, size), rng.normal(size=now.shape))
        q = np.linalg.qr(q)[0]
        vq = times(q)
        passes += 1
    raise NotCertified(f"residual {residual:.3g} after {max_rounds} rounds")


@dataclass
class Whitening:
    dim: int
    moments: Moments
    eigenvalues: np.ndarray
    directions: np.ndarray  # unit columns
    trace: float
    identity_error: float


def train(fit: DataFrame, dim: int, k: int = 16, guards: int | None = None, log: list | None = None) -> Whitening | None:
    """Fit on distinct vectors (z) of one length; None where nothing varies."""
    mom = moments(fit, dim)
    trace = total_variance(fit, dim, mom) if mom.n > 1 else 0.0
    if trace == 0.0:
        return None
    e, q = leading_eigenpairs(lambda m: covariance_times(fit, dim, mom, m), dim, trace, k, 2 * k if guards is None else guards, log=log)
    scaled = q / np.sqrt(e)
    shared = fit.sparkSession.sparkContext.broadcast((mom, scaled))

    def partials(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        m, p = shared.value
        total = np.zeros((p.shape[1] + 1, p.shape[1]))
        for _, z in _matrices(batches, dim):
            w = m.centred(z) @ p
            total[:-1] += w.T @ w
            total[-1] += w.sum(axis=0)
        return total

    s = added(partials, len(e) + 1, len(e), fit) / mom.n
    cov = s[:-1] - np.outer(s[-1], s[-1])
    shared.destroy()
    return Whitening(dim, mom, e, q, trace, float(np.abs(cov - np.eye(len(e))).max()))


def _exact_squares(mom: Moments, z: np.ndarray) -> pa.Array:
    d = mom.deviations(z)
    if d.dtype != object and z.shape[1] * (2 * mom.n * mom.largest) ** 2 < 1 << 63:
        return pa.array((d * d).sum(axis=1))
    totals = [sum(int(x) * int(x) for x in row) for row in d]
    return pa.array([t if t < 1 << 63 else None for t in totals], pa.int64())


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for the rows (id, z) of the model's length."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        k = len(m.eigenvalues)
        scaled = m.directions / np.sqrt(m.eigenvalues)
        for part, z in _matrices(batches, m.dim, BLOCK_ENTRIES // 4):
            n = len(z)
            again = pa.array(np.repeat(np.arange(n), k))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(again), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                 pa.array(np.full(n * k, m.moments.n)), _exact_squares(m.moments, z).take(again),
                 pa.array((m.moments.centred(z) @ scaled).ravel()), pa.array(np.tile(m.eigenvalues / m.trace, n)),
                 pa.array(np.full(n * k, m.identity_error))],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("id", "z").mapInArrow(run, f"id {id_type}, component int, n long, deviation long, whitened double, explained double, "
                                                  "identity_error double")


def whitened(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 64.0, k: int = 16,
             guards: int | None = None) -> DataFrame:
    """All usable rows of ``vectors`` on the first ``k`` components, see ``transform``; the id keeps its name."""
    rows = C.save(integers(usable(vectors, id_col, vec_col), scale), "whitening-rows")
    fit = C.save(rows.select("dim", "z").distinct(), "whitening-fit")
    out = None
    for dim in sorted(r.dim for r in rows.filter("dim > 0").select("dim").distinct().collect()):
        model = train(fit.filter(F.col("dim") == dim).select("z"), dim, k, guards)
        if model is not None:
            part = transform(rows.filter(F.col("dim") == dim), model)
            out = part if out is None else out.unionByName(part)
    if out is None:
        id_type = rows.schema["id"].dataType.simpleString()
        out = rows.sparkSession.createDataFrame([], f"id {id_type}, component int, n long, deviation long, whitened double, explained double, "
                                                    "identity_error double")
    return out.withColumnRenamed("id", id_col)
