"""Registered exact-search queries (dense, binary, sparse) over ``embeddings``.

Query set: the mean vector of every ``label`` (derived by Spark from the
whole table; its size is the number of labels and is checked before it is
broadcast).  The base is always the whole table; filters are the feature
under test, never a way to shrink it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vexa.functions import vectors as V
from vexa.operators import docscore as DS
from vexa.operators.common import vector_dim
from vexa.operators.export import KeysetExport, exported
from vexa.operators.knn import centroid_queries, fetch_fields, local_queries, rounded, top_k
from vexa.operators.multiknn import Search, search_many
from vexa.operators.sparse import drop_smallest, from_map, sparse_ip_topk
from vexa.plans import indexes as IX
from vexa.plans import sql_snippets as S
from vexa.plans.registry import load, register
from vexa.session import scratch_path
from vexa.sources.tables import write_partitioned

K = 10


def _emb(spark, sf):
    return load(spark, sf, "embeddings")


def _centroids(spark, sf):
    return local_queries(centroid_queries(_emb(spark, sf), "label", "embedding"))


def _knn(base, queries, metric="L2", k=K, id_col="vec_id", vec_col="embedding"):
    return rounded(top_k(base, queries, k=k, metric=metric, id_col=id_col, vec_col=vec_col))


def _scaled(df):
    """Deterministic per-row scale so that L2, IP and COSINE rank differently."""
    return df.withColumn("embedding", V.scale("embedding", (F.lit(1) + F.col("vec_id") % 7).cast("double")))


SCALE_SQL = "1 + vec_id % 7"


def _sql_knn(dist: str, where: str = "", order: str = "ASC", base: str = "embeddings b") -> str:
    cand = f"SELECT q.qid, b.vec_id, {dist} AS d FROM {base}, q {where}"
    return f"WITH {S.CENTROIDS}\n{S.topk(cand, K, order, 'vec_id')}"


# --- O53 exact L2 ---------------------------------------------------------
ORACLES_KNN_L2 = _sql_knn(S.l2("b.embedding", "q.qv"))


@register("knn_l2", ORACLES_KNN_L2)
def knn_l2(spark, sf):
    return _knn(_emb(spark, sf), _centroids(spark, sf), "L2")


# --- O60 filtered kNN (filter pushed to the scan, applied before top-k) ----
@register("knn_filtered", _sql_knn(S.l2("b.embedding", "q.qv"), "WHERE b.label >= 5"))
def knn_filtered(spark, sf):
    base = _emb(spark, sf).where(F.col("label") >= 5)
    return _knn(base, _centroids(spark, sf), "L2")


# --- O54 / O55 inner product and cosine on a deterministically scaled base --
@register("knn_ip", _sql_knn(S.ip("b.v", "q.qv"), order="DESC",
                             base=f"(SELECT vec_id, {S.scaled('embedding', SCALE_SQL)} AS v FROM embeddings) b"))
def knn_ip(spark, sf):
    return _knn(_scaled(_emb(spark, sf)), _centroids(spark, sf), "IP")


@register("knn_cosine", _sql_knn(S.cosine("b.v", "q.qv"), order="DESC",
                                 base=f"(SELECT vec_id, {S.scaled('embedding', SCALE_SQL)} AS v FROM embeddings) b"))
def knn_cosine(spark, sf):
    return _knn(_scaled(_emb(spark, sf)), _centroids(spark, sf), "COSINE")


# --- O56 normalisation ----------------------------------------------------
@register("normalize_vectors", f"""
SELECT vec_id, round({S.norm('v')}, 6) AS norm_before,
       round({S.norm('u')}, 6) AS norm_after, round(u[1], 6) AS first_component
FROM (SELECT vec_id, v, CASE WHEN {S.norm('v')} = 0 THEN list_transform(v, lambda x: 0.0::DOUBLE)
                             ELSE list_transform(v, lambda x: x / {S.norm('v')}) END AS u
      FROM (SELECT vec_id, {S.scaled('embedding', SCALE_SQL)} AS v FROM embeddings))""")
def normalize_vectors(spark, sf):
    df = _scaled(_emb(spark, sf)).withColumn("u", V.normalize("embedding"))
    return df.select("vec_id", F.round(V.norm("embedding"), 6).alias("norm_before"),
                     F.round(V.norm("u"), 6).alias("norm_after"),
                     F.round(F.element_at("u", 1), 6).alias("first_component"))


# --- O57 / O58 binary vectors (sign bits packed in 64-bit words) -------------
def _bits(spark, sf):
    emb = _emb(spark, sf)
    dim = vector_dim(emb, "embedding")
    base = emb.select("vec_id", V.sign_bits("embedding", dim).alias("bits"))
    q = _centroids(spark, sf).select("qid", V.sign_bits("qv", dim).alias("qv"))
    return base, q


@register("knn_hamming", _sql_knn(S.hamming_sign("b.embedding", "q.qv")))
def knn_hamming(spark, sf):
    base, q = _bits(spark, sf)
    return _knn(base, q, "HAMMING", vec_col="bits")


@register("knn_jaccard", _sql_knn(S.jaccard_sign("b.embedding", "q.qv")))
def knn_jaccard(spark, sf):
    base, q = _bits(spark, sf)
    return _knn(base, q, "JACCARD", vec_col="bits")


# --- O59 sparse inner product (term-frequency vectors, 20 % of query weights dropped)
SPARSE_SQL = f"""
WITH d AS (SELECT doc_id, t AS term, count(*)::DOUBLE AS w
           FROM (SELECT doc_id, unnest({S.tokens('text')}) AS t FROM documents) GROUP BY 1, 2),
qt AS (SELECT item_id AS qid, t AS term, count(*)::DOUBLE AS w
       FROM (SELECT item_id, unnest({S.tokens('text')}) AS t FROM benchmark) GROUP BY 1, 2),
qr AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY w, term) AS r,
              count(*) OVER (PARTITION BY qid) AS n FROM qt),
qk AS (SELECT qid, term, w AS qw FROM qr WHERE r > floor(n * 0.2e0)),
s AS (SELECT qid, doc_id, sum(w * qw) AS d FROM d JOIN qk USING (term) GROUP BY 1, 2)
{S.topk('SELECT * FROM s', K, 'DESC', 'doc_id')}"""


@register("sparse_ip_topk", SPARSE_SQL)
def sparse_ip(spark, sf):
    from vexa.plans.text import doc_index
    q = drop_smallest(DS.query_vectors(load(spark, sf, "benchmark"), "item_id", "text"), 0.2)
    return rounded(DS.inner_products(spark, doc_index(spark, sf).docs(spark), q, K))


# --- O61 search inside named partitions and across all of them --------------
@register("knn_partitions", f"""
WITH {S.CENTROIDS},
named AS ({S.topk(f"SELECT q.qid, b.vec_id, {S.l2('b.embedding', 'q.qv')} AS d FROM embeddings b, q WHERE b.label IN (1, 3)", K, 'ASC', 'vec_id')}),
every AS ({S.topk(f"SELECT q.qid, b.vec_id, {S.l2('b.embedding', 'q.qv')} AS d FROM embeddings b, q", K, 'ASC', 'vec_id')})
SELECT 'named' AS scope, * FROM named UNION ALL SELECT 'all' AS scope, * FROM every""")
def knn_partitions(spark, sf):
    def build():
        path = scratch_path(spark, "partitioned-embeddings")
        write_partitioned(_emb(spark, sf), path, "label")
        return path

    table = spark.read.parquet(IX.shared(spark, sf, ["embeddings"], ("by-label",), build))
    q = _centroids(spark, sf)
    named = _knn(table.where(F.col("label").isin(1, 3)), q).withColumn("scope", F.lit("named"))
    every = _knn(table, q).withColumn("scope", F.lit("all"))
    return named.unionByName(every)


# --- sparse vectors given as maps {index: weight} ------------------------------
MAP_LEAST = 0.1  # weights up to this are not stored


@register("sparse_map_topk", f"""
WITH {S.CENTROIDS},
b AS (SELECT vec_id, unnest(range(0, len(embedding))) AS i, unnest(embedding)::DOUBLE AS w FROM embeddings),
qw AS (SELECT qid, unnest(range(0, len(qv))) AS i, unnest(qv) AS w FROM q),
s AS (SELECT qid, vec_id, sum(b.w * qw.w) AS d FROM b JOIN qw USING (i) WHERE b.w > {MAP_LEAST} AND qw.w > 0 GROUP BY 1, 2)
{S.topk('SELECT * FROM s', K, 'DESC', 'vec_id')}""")
def sparse_map_topk(spark, sf):
    def as_map(v, least):
        pairs = F.transform(v, lambda x, i: F.struct(i.alias("i"), x.cast("double").alias("w")))
        return F.map_from_entries(F.filter(pairs, lambda p: p["w"] > least))

    base = from_map(_emb(spark, sf).select("vec_id", as_map(F.col("embedding"), MAP_LEAST).alias("m")), "vec_id", "m")
    q = from_map(_centroids(spark, sf).select("qid", as_map(F.col("qv"), 0.0).alias("m")), "qid", "m")
    return rounded(sparse_ip_topk(base, q, k=K, id_col="vec_id"))


# --- O62 several vector fields of one row, each with its own metric ---------
@register("knn_multi_field", f"""
WITH {S.CENTROIDS},
f1 AS ({S.topk(f"SELECT q.qid, b.vec_id, {S.l2('b.embedding', 'q.qv')} AS d FROM embeddings b, q", K, 'ASC', 'vec_id')}),
f2 AS ({S.topk(f"SELECT q.qid, b.vec_id, {S.ip('b.embedding[1:32]', 'q.qv[1:32]')} AS d FROM embeddings b, q", K, 'DESC', 'vec_id')})
SELECT 'embedding' AS field, * FROM f1 UNION ALL SELECT 'head32' AS field, * FROM f2""")
def knn_multi_field(spark, sf):
    emb = _emb(spark, sf)
    found = search_many(emb, _centroids(spark, sf), [Search("embedding", "embedding"), Search("head32", "embedding", "IP", dims=(0, 32))],
                        k=K, id_col="vec_id")
    return rounded(found).withColumnRenamed("search", "field")


# --- O63 late fetch of payload columns for the hits -------------------------
@register("knn_fetch_fields", f"""
WITH {S.CENTROIDS},
h AS ({S.topk(f"SELECT q.qid, b.vec_id, {S.l2('b.embedding', 'q.qv')} AS d FROM embeddings b, q", K, 'ASC', 'vec_id')})
SELECT h.*, e.label, d.lang, d.n_chars FROM h
JOIN embeddings e ON e.vec_id = h.vec_id LEFT JOIN documents d ON d.doc_id = h.vec_id""")
def knn_fetch_fields(spark, sf):
    emb = _emb(spark, sf)
    hits = _knn(emb.select("vec_id", "embedding"), _centroids(spark, sf))
    return fetch_fields(hits, [(emb.select("vec_id", "label"), "vec_id", "inner"),
                               (load(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), "lang", "n_chars"),
                                "vec_id", "left")])


# --- O20 the same search at several dimensions ------------------------------
DIMS = (2, 16, 64)


def _dims_sql():
    parts = []
    for d in DIMS:
        cand = f"SELECT q.qid, b.vec_id, {S.l2(f'b.embedding[1:{d}]', f'q.qv[1:{d}]')} AS d FROM embeddings b, q"
        parts.append(f"SELECT {d} AS dim, * FROM ({S.topk(cand, K, 'ASC', 'vec_id')})")
    return f"WITH {S.CENTROIDS}\n" + "\nUNION ALL\n".join(parts)


@register("vector_dims", _dims_sql())
def vector_dims(spark, sf):
    found = search_many(_emb(spark, sf), _centroids(spark, sf), [Search(str(d), "embedding", dims=(0, d)) for d in DIMS], k=K, id_col="vec_id")
    return rounded(found).select("qid", "vec_id", "score", "rank", F.col("search").cast("int").alias("dim"))


# --- the same at 1024 dimensions: each vector repeated with other scales
def _wide_sql():
    def wide(v):
        return f"flatten(list_transform(range(0, 16), lambda r: list_transform({v}, lambda x: x::DOUBLE * (1 + r % 3))))"
    cand = f"SELECT qw.qid, b.vec_id, {S.l2('b.v', 'qw.v')} AS d FROM b, qw"
    return (f"WITH {S.CENTROIDS},\nqw AS (SELECT qid, {wide('qv')} AS v FROM q),\nb AS (SELECT vec_id, {wide('embedding')} AS v FROM embeddings)\n"
            f"{S.topk(cand, K, 'ASC', 'vec_id')}")


def widened(v, times: int = 16):
    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(times - 1)),
                                 lambda r: F.transform(v, lambda x: x.cast("double") * (1 + r % 3))))


@register("vector_dims_wide", _wide_sql())
def vector_dims_wide(spark, sf):
    emb, q = _emb(spark, sf), _centroids(spark, sf)
    return _knn(emb.select("vec_id", widened(F.col("embedding")).alias("embedding")), q.select("qid", widened(F.col("qv")).alias("qv")))


# --- O22 first five components ----------------------------------------------
@register("vector_head", """
SELECT vec_id, list_transform(embedding[1:5], lambda x: round(x::DOUBLE, 6)) AS head FROM embeddings""")
def vector_head(spark, sf):
    return _emb(spark, sf).select(
        "vec_id", F.transform(V.head("embedding", 5), lambda x: F.round(x.cast("double"), 6)).alias("head"))


# --- O10 search iterator: every row by distance, in numbered batches ---------
EXPORT_BATCH = 100
EXPORT_LIMIT = 300


@register("export_batches", f"""
WITH g AS (SELECT list(m ORDER BY pos) AS qv FROM (
             SELECT pos, avg(x::DOUBLE) AS m FROM (
               SELECT unnest(embedding) AS x, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings)
             GROUP BY pos)),
r AS (SELECT b.vec_id, {S.l2('b.embedding', 'g.qv')} AS d FROM embeddings b, g),
n AS (SELECT vec_id, d, row_number() OVER (ORDER BY d, vec_id) AS rn FROM r)
SELECT (rn - 1) // {EXPORT_BATCH} AS batch_no, rn, vec_id, round(d, 6) AS score FROM n WHERE rn <= {EXPORT_LIMIT}""")
def export_batches_q(spark, sf):
    emb = _emb(spark, sf)
    g = centroid_queries(emb.withColumn("_all", F.lit(0)), "_all", "embedding").first()
    scored = emb.select("vec_id", V.l2_sq("embedding", V.literal_vector(g["qv"])).alias("score"))
    path = scratch_path(spark, "export")
    KeysetExport(scored, "score", "vec_id", EXPORT_BATCH).write(path, EXPORT_LIMIT)
    return exported(spark, path).select(F.col("batch_no").cast("long").alias("batch_no"), "rn", "vec_id", F.round("score", 6).alias("score"))
