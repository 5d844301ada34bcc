"""Several exact searches in one scan of the base.

Each search names a vector column, a metric, and if wanted a filter and a part of the vector's dimensions.  The columns needed by any search are
read once; a task widens a block of vectors once per column, scores it with the queries of every search, and returns ``k`` rows
per query and search.  The queries are broadcast in bounded passes, as in ``knn``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vexa.functions.vectors import ASCENDING
from vexa.operators.ivf import Tops, _steps
from vexa.operators.knn import _arrow_type, _dense_keys, query_passes


@dataclass(frozen=True)
class Search:
    name: str
    vec_col: str
    metric: str = "L2"
    where: Column | None = None
    dims: tuple[int, int] | None = None  # from, to (exclusive), of base and query vectors


def search_many(base: DataFrame, queries: DataFrame, searches: list[Search], *, k: int = 10, id_col: str = "id") -> DataFrame:
    """``queries`` (qid, qv) -> (search, qid, id, score, rank), ties by id.

    Rows whose id or vector is null, or whose vector is of another length than the queries' or not a number are never hits of that search."""
    spark = base.sparkSession
    qid_type, id_type = queries.schema["qid"].dataType, base.schema[id_col].dataType
    out_type = T.StructType([T.StructField("search", T.IntegerType()), T.StructField("qid", qid_type), T.StructField(id_col, id_type),
                             T.StructField("key", T.DoubleType())])
    columns = list(dict.fromkeys(s.vec_col for s in searches))
    plain = [(columns.index(s.vec_col), s.metric.upper(), s.dims) for s in searches]
    found = None
    for qpass in query_passes(queries.select("qid", "qv").filter(F.col("qv").isNotNull()), "qid", None):
        rows = qpass.collect()  # bounded by query_passes
        if not rows:
            continue
        dim = len(rows[0].qv)
        if any(len(r.qv) != dim for r in rows):
            raise ValueError("queries of one search must have one dimension")
        shared = spark.sparkContext.broadcast(([r.qid for r in rows], np.array([r.qv for r in rows], np.float64).reshape(len(rows), dim)))
        fits = [F.coalesce(F.size(c) == dim, F.lit(False)).alias(f"_d{i}") for i, c in enumerate(columns)]
        masks = [F.coalesce(s.where if s.where is not None else F.lit(True), F.lit(False)).alias(f"_f{i}") for i, s in enumerate(searches)]
        read = base.filter(F.col(id_col).isNotNull()).select(F.col(id_col), *[F.col(c).alias(f"_v{i}") for i, c in enumerate(columns)], *fits, *masks)
        part = read.mapInArrow(_scan(shared, plain, len(columns), dim, k, id_col, _arrow_type(qid_type), _arrow_type(id_type)), out_type)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], out_type)
    best = Window.partitionBy("search", "qid").orderBy("key", F.col(id_col).asc())
    falling = [i for i, s in enumerate(searches) if not ASCENDING[s.metric.upper()]]
    score = F.when(F.col("search").isin(falling), -F.col("key")).otherwise(F.col("key"))
    names = F.array(*[F.lit(s.name) for s in searches])
    return (found.withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= k)
            .select(names[F.col("search")].alias("search"), "qid", id_col, score.alias("score"), "rank"))


def _scan(shared, searches, columns: int, dim: int, k: int, id_col: str, qid_type, id_type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, q_all = shared.value
        prepared = []
        for _, metric, dims in searches:
            q = q_all[:, slice(*dims)] if dims else q_all
            shift = q.mean(axis=0) if metric == "L2" else np.zeros(q.shape[1])
            prepared.append((q - shift, np.einsum("ij,ij->i", q - shift, q - shift), shift))
        tops, everyone = Tops(len(searches), len(qids), k), np.arange(len(qids))
        for b in batches:
            if not b.num_rows:
                continue
            ids_all = b.column(0).to_numpy(zero_copy_only=False)
            flags = [np.asarray(b.column(1 + columns + i).to_numpy(zero_copy_only=False), bool) for i in range(columns + len(searches))]
            for c in range(columns):
                at = np.flatnonzero(flags[c])
                flat = b.column(1 + c).filter(pa.array(flags[c])).flatten().to_numpy(zero_copy_only=False)
                for s in _steps(len(at), dim, len(qids)):
                    x = flat[s.start * dim:s.stop * dim].astype(np.float64).reshape(-1, dim)
                    for i, (col, metric, dims) in enumerate(searches):
                        use = flags[columns + i][at[s]]
                        if col != c or not use.any():
                            continue
                        q, norms, shift = prepared[i]
                        own = (x[use][:, slice(*dims)] if dims else x[use]) - shift
                        tops.add(i, everyone, _dense_keys(metric, q, norms, own, tops.keys[i], k, None), ids_all[at[s]][use])
        s, qi, key, ids = tops.rows()
        yield pa.RecordBatch.from_arrays([pa.array(s.astype(np.int32)), pa.array([qids[i] for i in qi], qid_type), pa.array(ids, id_type), pa.array(key)],
                                         ["search", "qid", id_col, "key"])

    return run
