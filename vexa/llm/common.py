"""Helpers shared by the operators of this subpackage.

Texts travel as Arrow batches; inside a task the bytes of many texts are
handled together as one ``uint8`` array with offsets, so NumPy works on
megabytes at a time and no Python code runs per character.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vexa.session import scratch_path

BLOCK_BYTES = 2 << 20  # text handled at once inside a task; a longer text is a block of its own
UID = "_uid"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts the lineage with a reliable copy: a lost executor costs a re-read.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` plus ``_uid``, a unique long whose order is the document order.

    Where ``id_col`` is an integer, unique and never null, ``_uid`` is the id itself.
    Otherwise the rows are ordered by (id, nulls last; text) and numbered in
    that order, and written once, so that a repeated row is a later document of
    its own.  The check reads only the id column.  A ``_uid`` that ``docs`` has already is
    replaced.
    """
    clash = dict(docs.dtypes)[id_col] not in ("tinyint", "smallint", "int", "bigint")
    if not clash:
        per_id = docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("n"))
        clash = per_id.filter(F.col(id_col).isNull() | (F.col("n") > 1)).limit(1).count() > 0
    if not clash:
        return docs.withColumn(UID, F.col(id_col).cast("long"))
    n = shuffle_partitions(docs.sparkSession)
    keys = [F.col(id_col).asc_nulls_last(), F.col(text_col).asc_nulls_first()]
    rest = [F.col(c) for c, t in docs.dtypes if c not in (id_col, text_col) and not t.startswith("map")]
    ordered = docs.repartitionByRange(n, *keys, *rest).sortWithinPartitions(*keys, *rest)
    return save(ordered.withColumn(UID, F.monotonically_increasing_id()), "identified")


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    n = len(col)
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64) \
        if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[o[0]:o[-1]], o - o[0]


def text_blocks(batches: Iterator[pa.RecordBatch], text_col: str = "text",
                limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches into runs of rows of at most ``limit`` text bytes each
    (a longer text alone), as (rows, bytes, offsets)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offs = column_bytes(batch.column(batch.schema.get_field_index(text_col)))
        i, n = 0, batch.num_rows
        while i < n:
            j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
            j = min(max(j, i + 1), n)
            yield batch.slice(i, j - i), data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
            i = j


def binary_column(blob: np.ndarray, offs: np.ndarray) -> pa.Array:
    """A binary Arrow array from bytes and offsets, without a Python loop."""
    blob = np.ascontiguousarray(blob, np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(offs) - 1,
                                 [None, pa.py_buffer(np.ascontiguousarray(offs, np.int32)), pa.py_buffer(blob)])


def _byte_table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**64, 256, np.uint64) | np.uint64(1)


BYTE_CODE = _byte_table(20240229)
_MULT = np.uint64(0x9E3779B97F4A7C15)  # odd, hence invertible modulo 2**64
_INV = np.uint64(pow(int(_MULT), -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.ones(max(n, 1), np.uint64)
    out[1:] = base
    np.multiply.accumulate(out, out=out)
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on every input bit."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class RollingHash:
    """64-bit hashes of arbitrary byte ranges of one block, from prefix sums."""

    _pow = np.ones(1, np.uint64)
    _inv = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data)
        cls = type(self)
        if len(cls._pow) < n + 1:
            cls._pow, cls._inv = powers(_MULT, n + 1), powers(_INV, n + 1)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_CODE[data] * cls._pow[:n], out=self.prefix[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.prefix[end] - self.prefix[start]) * type(self)._inv[start]
        return mix(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def windows(self, k: int) -> np.ndarray:
        """Hash of every window of ``k`` bytes, by its start."""
        m = len(self.prefix) - k
        if m <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.prefix[k:] - self.prefix[:m]) * type(self)._inv[:m])


EXACT_WORD = 64  # bytes; a polynomial modulo 2**64 has systematic collisions between longer words


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words ``data[start:end]``; words above ``EXACT_WORD`` bytes by a cryptographic digest."""
    h = RollingHash(data).ranges(start, end)
    for i in np.flatnonzero(end - start > EXACT_WORD):
        h[i] = int.from_bytes(blake2b(data[start[i]:end[i]].tobytes(), digest_size=8).digest(), "little")
    return h


LOWER_AZ = np.arange(256, dtype=np.uint8)
LOWER_AZ[65:91] += 32


def word_spans(is_word: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of word bytes that do not cross a text boundary.

    Returns (start, end, first): word ``i`` covers ``start[i]:end[i]``, and the
    words of text ``t`` are ``first[t]:first[t+1]``.
    """
    n = len(is_word)
    before = np.zeros(n, bool)
    before[1:] = is_word[:-1]
    after = np.zeros(n, bool)
    after[:-1] = is_word[1:]
    edge = offs[1:-1]
    edge = edge[(edge > 0) & (edge < n)]
    before[edge] = False
    after[edge - 1] = False
    start = np.flatnonzero(is_word & ~before)
    end = np.flatnonzero(is_word & ~after) + 1
    return start, end, np.searchsorted(start, offs)


def by_group(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal integer keys in sorted batches, one table per run.

    For use after ``repartition(keys).sortWithinPartitions(keys)``: only one
    group is held at a time, and there is no per-group job overhead.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            key = tuple(c[a] for c in cols)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def ragged(col: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets) of a binary column that holds packed arrays."""
    blob, offs = column_bytes(col)
    return np.ascontiguousarray(blob).view(dtype), offs // np.dtype(dtype).itemsize


def longs(table, name: str) -> np.ndarray:
    """An integer column without nulls, as int64."""
    return table.column(name).to_numpy(zero_copy_only=False).astype(np.int64) if isinstance(table, pa.RecordBatch) \
        else table.column(name).combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)


def sample_texts(docs: DataFrame, ids: DataFrame, id_col: str, max_rows: int) -> list[str]:
    """Texts of the ``max_rows`` ids that come first by hash: a bounded sample for fitting.

    Only ids are sorted; the chosen ones are few, so they are broadcast to the scan."""
    chosen = ids.select(id_col).filter(F.col(id_col).isNotNull()).distinct().orderBy(F.xxhash64(id_col), id_col).limit(max_rows)
    rows = (docs.select(id_col, "text").join(F.broadcast(chosen), id_col)
            .groupBy(id_col).agg(F.min("text").alias("text")).orderBy(id_col).collect())
    return [r.text for r in rows]
