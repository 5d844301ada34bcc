"""Registered approximate-search and evaluation queries.

Approximate results have no SQL oracle; their checks are invariants and
recall floors in tests.  Ground truth and recall of two deterministic
result sets do have oracles.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vexa.functions import vectors as V
from vexa.operators import ann as A
from vexa.operators import evaluate as E
from vexa.operators import ivf as IVF
from vexa.operators import lsh as LSH
from vexa.operators.common import kept
from vexa.operators.knn import centroid_queries, local_queries, top_k
from vexa.operators.multiknn import Search, search_many
from vexa.plans import indexes as IX
from vexa.plans import search as _search  # noqa: F401 - registers knn_l2, whose oracle is used below
from vexa.plans import sql_snippets as S
from vexa.plans.registry import ORACLES, load, register

K = 10
NPROBES = (1, 4, 8, 16)
PQ_SUB_SPACES = 32
FILTERS = {"none": None, "label >= 2": "label >= 2", "label >= 5": "label >= 5", "label >= 8": "label >= 8"}


def _emb(spark, sf):
    return load(spark, sf, "embeddings")


def _queries(spark, sf):
    return local_queries(centroid_queries(_emb(spark, sf), "label", "embedding"))


def _cond(expr):
    return None if expr is None else F.expr(expr)


def _index(spark, sf, sub_spaces=0):
    """The index that the queries below share: square root of the rows as cells, probes as measured."""
    return IX.shared(spark, sf, ["embeddings"], ("ivf", sub_spaces), lambda: IVF.build(
        spark, _emb(spark, sf), "vec_id", "embedding", sub_spaces=sub_spaces, k=K, seed=42))


@register("ivf_build", """
SELECT count(*) AS num_rows, true AS every_row_once, true AS in_nearest_cell FROM embeddings""")
def ivf_build(spark, sf):
    """Rows of the index, each in one cell, whose centre is the nearest to it."""
    idx = _index(spark, sf)
    nearest = top_k(idx.cells(spark), idx.table(spark).select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qv")),
                    k=1, id_col="cell", vec_col="centroid").select(F.col("qid").alias("vec_id"), "score")
    rows = idx.table(spark).join(nearest, "vec_id", "left")
    return rows.agg(F.count(F.lit(1)).alias("num_rows"), (F.count_distinct("vec_id") == F.count(F.lit(1))).alias("every_row_once"),
                    F.bool_and(F.abs(F.sqrt("score") - F.col("_dist")) <= 1e-6).alias("in_nearest_cell"))


@register("ivf_search")
def ivf_search(spark, sf):
    return IVF.search(spark, _index(spark, sf), _queries(spark, sf), k=K).withColumn("score", F.round("score", 6))


@register("lsh_search")
def lsh_search(spark, sf):
    emb = _emb(spark, sf)
    tables = IX.shared(spark, sf, ["embeddings"], ("lsh",), lambda: LSH.learn(emb, "vec_id", "embedding", k=K))
    return LSH.search(emb, _queries(spark, sf), tables, id_col="vec_id", vec_col="embedding", k=K)


def _bits(spark, sf):
    return _emb(spark, sf).select("vec_id", V.sign_bits("embedding", 64).alias("bits"))


@register("minhash_search")
def minhash_search(spark, sf):
    """Jaccard neighbours of the sign bits."""
    rows = _bits(spark, sf)
    tables = IX.shared(spark, sf, ["embeddings"], ("minhash",), lambda: LSH.learn_minhash(rows, "vec_id", "bits", k=K))
    q = _queries(spark, sf).select("qid", V.sign_bits("qv", 64).alias("qv"))
    return LSH.minhash_search(rows, q, tables, id_col="vec_id", vec_col="bits", k=K)


# a half float keeps 11 significant bits, and steps of 2**-24 below 2**-14
@register("quantize_fp16", """
SELECT vec_id, 2 * len(embedding) AS fp16_bytes, 4 * len(embedding) AS fp32_bytes,
  round(list_max(list_transform(embedding, lambda x: abs(x::DOUBLE - CASE WHEN x = 0 THEN 0 ELSE
    round_even(x::DOUBLE / pow(2, greatest(floor(log2(abs(x::DOUBLE))), -14) - 10), 0) * pow(2, greatest(floor(log2(abs(x::DOUBLE))), -14) - 10) END)
    / greatest(abs(x::DOUBLE), 1e-4))), 9) AS max_rel_error FROM embeddings""")
def quantize_fp16(spark, sf):
    e = _emb(spark, sf).withColumn("h", A.fp16_encode("embedding"))
    d = e.withColumn("back", A.fp16_decode("h"))
    err = F.aggregate(F.zip_with("embedding", "back", lambda a, b: F.abs(a - b) / F.greatest(F.abs(a), F.lit(1e-4))),
                      F.lit(0.0).cast("double"), lambda acc, x: F.greatest(acc, x.cast("double")))
    return d.select("vec_id", F.length("h").alias("fp16_bytes"), (F.size("embedding") * 4).alias("fp32_bytes"),
                    F.round(err, 9).alias("max_rel_error"))


def _gt_sql():
    parts = []
    for name, expr in FILTERS.items():
        where = f"WHERE b.{expr}" if expr else ""
        cand = f"SELECT q.qid, b.vec_id, {S.l2('b.embedding', 'q.qv')} AS d FROM embeddings b, q {where}"
        parts.append(f"SELECT '{name}' AS filter_name, qid, list(vec_id ORDER BY rank) AS neighbors_id "
                     f"FROM ({S.topk(cand, K, 'ASC', 'vec_id')}) GROUP BY qid")
    return f"WITH {S.CENTROIDS}\n" + "\nUNION ALL\n".join(parts)


@register("ground_truth", _gt_sql())
def ground_truth(spark, sf):
    return E.ground_truth(_emb(spark, sf), _queries(spark, sf), {n: _cond(x) for n, x in FILTERS.items()},
                          k=K, id_col="vec_id", vec_col="embedding")


@register("recall_at_k", f"""
WITH {S.CENTROIDS},
t AS ({S.topk(f"SELECT q.qid, b.vec_id, {S.l2('b.embedding', 'q.qv')} AS d FROM embeddings b, q", K, 'ASC', 'vec_id')}),
f AS ({S.topk(f"SELECT q.qid, b.vec_id, {S.l2('b.embedding[1:16]', 'q.qv[1:16]')} AS d FROM embeddings b, q", K, 'ASC', 'vec_id')}),
n AS (SELECT qid, count(*) AS n_truth FROM t GROUP BY qid),
h AS (SELECT t.qid, count(*) AS hits FROM t JOIN f ON f.qid = t.qid AND f.vec_id = t.vec_id GROUP BY t.qid)
SELECT n.qid, coalesce(h.hits, 0) AS hits, round(coalesce(h.hits, 0) / least({K}, n.n_truth)::DOUBLE, 4) AS recall
FROM n LEFT JOIN h ON h.qid = n.qid""")
def recall_at_k(spark, sf):
    emb, q = _emb(spark, sf), _queries(spark, sf)
    hits = kept(search_many(emb, q, [Search("truth", "embedding"), Search("found", "embedding", dims=(0, 16))], k=K, id_col="vec_id"))
    truth, found = (hits.where(F.col("search") == n) for n in ("truth", "found"))
    r = E.recall_per_query(found, truth, "vec_id", K)
    return r.withColumn("recall", F.round("recall", 4))


def _grid(spark, sf):
    """recall@k over filters x nprobe: one scan of the index for the whole grid and one for its truth."""
    q, idx = _queries(spark, sf), _index(spark, sf)
    filters = {n: _cond(x) for n, x in FILTERS.items()}
    found = IVF.search_settings(spark, idx, q, sorted({min(p, idx.nlist) for p in NPROBES}), filters, k=K)
    truth = IVF.search_settings(spark, idx, q, [idx.nlist], filters, k=K).select("filter_name", "qid", "vec_id")
    n_truth = truth.groupBy("filter_name", "qid").agg(F.count(F.lit(1)).alias("n_truth"))
    settings = F.explode(F.array(*[F.lit(n) for n in NPROBES])).alias("nprobe")
    hits = (found.withColumnRenamed("nprobe", "probed").join(truth, ["filter_name", "qid", "vec_id"])
            .groupBy("filter_name", "qid", "probed").agg(F.count(F.lit(1)).alias("hits")))
    asked = n_truth.select("filter_name", "qid", "n_truth", settings).withColumn("probed", F.least("nprobe", F.lit(idx.nlist)))
    per = asked.join(hits, ["filter_name", "qid", "probed"], "left").fillna(0, ["hits"])
    den = F.least(F.lit(K), F.col("n_truth"))
    # a query without a true neighbour under a filter has nothing to miss
    empty = F.lit(q.count()) - F.count(F.lit(1))
    return per.groupBy("filter_name", "nprobe").agg(
        F.round((F.sum(F.col("hits") / den) + empty) / (F.count(F.lit(1)) + empty), 4).alias("recall"), F.lit(q.count()).alias("n_queries"))


@register("search_grid")
def search_grid(spark, sf):
    return _grid(spark, sf).select("filter_name", "nprobe", "recall")


@register("report_all")
def report_all(spark, sf):
    """One row per grid point with its recall and number of queries.  Times are
    measured by ``bench.py`` alone: one batch job has no time per setting."""
    return _grid(spark, sf)


@register("pq_encode_search", ORACLES["knn_l2"])
def pq_encode_search(spark, sf):
    """Exact neighbours over codes of one byte for each two dimensions."""
    idx = _index(spark, sf, sub_spaces=PQ_SUB_SPACES)
    return IVF.exact_search(spark, idx, _queries(spark, sf), k=K).withColumn("score", F.round("score", 6))
