"""Registered text and hybrid retrieval queries.

Hybrid corpus: ``documents`` joined to ``embeddings`` on doc_id = vec_id.
Hybrid queries: the first document (lowest doc_id) of every language in
that corpus, searched with both its text and its vector -- one query per
language, derived from the data (the reference queries with a corpus row).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vexa.functions.text import text_match, tokenize
from vexa.operators import hybrid as H
from vexa.operators import docscore as DS
from vexa.operators.common import broadcast_query_side
from vexa.operators.knn import centroid_queries, fetch_fields, local_queries, rounded, top_k
from vexa.operators.text import build_index
from vexa.plans import indexes as IX
from vexa.plans import sql_snippets as S
from vexa.plans.filters import TEXT_QUERY
from vexa.plans.registry import load, register

K = 10
HYBRID_LIMIT = 5


def bm25_sql(docs: str, queries: str) -> str:
    """CTEs ending in bm(qid, doc_id, d, rk) for docs(doc_id, text), queries(qid, qtext)."""
    return f"""
bt AS (SELECT doc_id, unnest({S.tokens('text')}) AS term FROM {docs}),
bdl AS (SELECT doc_id, len({S.tokens('text')}) AS dl FROM {docs}),
btf AS (SELECT term, doc_id, count(*) AS tf FROM bt GROUP BY 1, 2),
bdf AS (SELECT term, count(*) AS df FROM btf GROUP BY 1),
bst AS (SELECT count(*)::DOUBLE AS n, avg(dl::DOUBLE) AS avgdl FROM bdl),
bqt AS (SELECT DISTINCT qid, term FROM (SELECT qid, unnest({S.tokens('qtext')}) AS term FROM {queries})),
bs AS (SELECT bqt.qid, btf.doc_id,
         sum(ln(1 + (bst.n - bdf.df + 0.5e0) / (bdf.df + 0.5e0)) * (btf.tf * 2.2e0)
             / (btf.tf + 1.2e0 * (0.25e0 + 0.75e0 * bdl.dl / bst.avgdl))) AS d
       FROM bqt JOIN btf ON btf.term = bqt.term JOIN bdf ON bdf.term = bqt.term
       JOIN bdl ON bdl.doc_id = btf.doc_id, bst GROUP BY 1, 2),
bm AS (SELECT qid, doc_id, d, row_number() OVER (PARTITION BY qid ORDER BY round(d, 9) DESC, doc_id) AS rk FROM bs)"""


@register("tokenize", f"""
SELECT doc_id, len(t) AS n_tokens, t[1] AS first_token, t[-1] AS last_token
FROM (SELECT doc_id, {S.tokens('text')} AS t FROM documents)""")
def tokenize_q(spark, sf):
    d = load(spark, sf, "documents").select("doc_id", tokenize("text").alias("t"))
    return d.select("doc_id", F.size("t").alias("n_tokens"), F.try_element_at("t", F.lit(1)).alias("first_token"),
                    F.try_element_at("t", F.lit(-1)).alias("last_token"))


@register("postings_build", f"""
SELECT term, count(*) AS df, sum(tf) AS total_tf FROM (
  SELECT term, doc_id, count(*) AS tf FROM (SELECT doc_id, unnest({S.tokens('text')}) AS term FROM documents)
  GROUP BY 1, 2) GROUP BY 1""")
def postings_build(spark, sf):
    idx = build_index(spark, load(spark, sf, "documents"))
    return idx.postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total_tf"))


def doc_index(spark, sf):
    """The term vectors of ``documents``, written once for all queries that score them."""
    return IX.shared(spark, sf, ["documents"], ("doc-index",), lambda: DS.build(spark, load(spark, sf, "documents")))


@register("bm25_topk", f"""
WITH {bm25_sql('documents', '(SELECT item_id AS qid, text AS qtext FROM benchmark)')}
SELECT qid, doc_id, round(d, 6) AS score, rk AS rank FROM bm WHERE rk <= {K}""")
def bm25_q(spark, sf):
    return rounded(DS.bm25(spark, doc_index(spark, sf), DS.query_vectors(load(spark, sf, "benchmark"), "item_id", "text"), K))


@register("fulltext_plus_vector", f"""
WITH {S.CENTROIDS}
{S.topk(f"SELECT q.qid, e.vec_id, {S.l2('e.embedding', 'q.qv')} AS d FROM embeddings e JOIN documents t ON t.doc_id = e.vec_id, q WHERE len(list_intersect({S.tokens('t.text')}, ['thon', 'thor'])) > 0", K, 'ASC', 'vec_id')}""")
def fulltext_plus_vector(spark, sf):
    emb = load(spark, sf, "embeddings")
    docs = load(spark, sf, "documents").where(text_match("text", TEXT_QUERY)).select(F.col("doc_id").alias("vec_id"))
    base = emb.join(docs, "vec_id", "left_semi")
    return rounded(top_k(base, centroid_queries(emb, "label", "embedding"), k=K, metric="L2",
                         id_col="vec_id", vec_col="embedding"))


# --- hybrid corpus and its queries ---------------------------------------------
CORPUS_SQL = "(SELECT d.doc_id, d.text, d.lang, e.embedding FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id)"
HQ_SQL = (f"(SELECT doc_id AS qid, text AS qtext, embedding AS qv FROM {CORPUS_SQL} c "
          f"WHERE doc_id IN (SELECT min(doc_id) FROM {CORPUS_SQL} c2 GROUP BY lang))")


def _hybrid(spark, sf):
    docs = load(spark, sf, "documents")
    emb = load(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    corpus = docs.join(emb, "doc_id").select("doc_id", "lang")
    firsts = corpus.groupBy("lang").agg(F.min("doc_id").alias("doc_id")).select("doc_id")  # one row per language
    texts = docs.join(broadcast_query_side(firsts), "doc_id").select("doc_id", "text")
    hq = local_queries(texts.join(emb, "doc_id").select(F.col("doc_id").alias("qid"), F.col("text").alias("qtext"), F.col("embedding").alias("qv")))
    dense = top_k(emb.join(docs.select("doc_id"), "doc_id", "left_semi"), hq, k=HYBRID_LIMIT, metric="IP", id_col="doc_id", vec_col="embedding")
    # also documents without a vector
    sparse = DS.bm25(spark, doc_index(spark, sf), DS.query_vectors(hq, "qid", "qtext"), HYBRID_LIMIT)
    return dense, sparse


def _hybrid_sql_lists():
    dense = (f"SELECT qid, doc_id, d, row_number() OVER (PARTITION BY qid ORDER BY d DESC, doc_id) AS rk FROM ("
             f"SELECT hq.qid, c.doc_id, {S.ip('c.embedding', 'hq.qv')} AS d FROM {CORPUS_SQL} c, {HQ_SQL} hq)")
    return f"""WITH {bm25_sql("documents", HQ_SQL)},
dn AS (SELECT * FROM ({dense}) WHERE rk <= {HYBRID_LIMIT}),
sp AS (SELECT * FROM bm WHERE rk <= {HYBRID_LIMIT})"""


@register("hybrid_rrf", f"""
{_hybrid_sql_lists()},
f AS (SELECT qid, doc_id, sum(1.0e0 / (60 + rk)) AS d FROM (SELECT * FROM dn UNION ALL SELECT * FROM sp) GROUP BY 1, 2)
{S.topk('SELECT * FROM f', HYBRID_LIMIT, 'DESC', 'doc_id')}""")
def hybrid_rrf(spark, sf):
    dense, sparse = _hybrid(spark, sf)
    return rounded(H.rrf([dense, sparse], "doc_id", H.RRF_K, HYBRID_LIMIT))


W_DENSE, W_SPARSE = 0.8, 0.3


def _mm(rel: str, w: float) -> str:
    # scores that tie up to rounding (copies of a text) must normalise alike
    rel = f"(SELECT qid, doc_id, round(d, 9) AS d FROM {rel})"
    return (f"SELECT qid, doc_id, {w}e0 * CASE WHEN max(d) OVER (PARTITION BY qid) = min(d) OVER (PARTITION BY qid) "
            f"THEN 1.0e0 ELSE (d - min(d) OVER (PARTITION BY qid)) / (max(d) OVER (PARTITION BY qid) - "
            f"min(d) OVER (PARTITION BY qid)) END AS s FROM {rel}")


@register("hybrid_weighted", f"""
{_hybrid_sql_lists()},
f AS (SELECT qid, doc_id, sum(s) AS d FROM ({_mm('dn', W_DENSE)} UNION ALL {_mm('sp', W_SPARSE)}) GROUP BY 1, 2)
{S.topk('SELECT * FROM f', HYBRID_LIMIT, 'DESC', 'doc_id')}""")
def hybrid_weighted(spark, sf):
    dense, sparse = _hybrid(spark, sf)
    dense, sparse = rounded(dense, places=9), rounded(sparse, places=9)
    return rounded(H.weighted([(dense, W_DENSE, True), (sparse, W_SPARSE, True)], "doc_id", HYBRID_LIMIT))


@register("rerank_by_scalar", f"""
WITH {S.CENTROIDS},
h AS ({S.topk(f"SELECT q.qid, b.vec_id, {S.l2('b.embedding', 'q.qv')} AS d FROM embeddings b, q", K, 'ASC', 'vec_id')}),
j AS (SELECT h.*, d.n_chars FROM h LEFT JOIN documents d ON d.doc_id = h.vec_id)
SELECT qid, vec_id, score, rank AS vector_rank, n_chars,
       row_number() OVER (PARTITION BY qid ORDER BY n_chars DESC, vec_id) AS rank FROM j""")
def rerank_by_scalar(spark, sf):
    emb = load(spark, sf, "embeddings")
    hits = rounded(top_k(emb, centroid_queries(emb, "label", "embedding"), k=K, metric="L2",
                         id_col="vec_id", vec_col="embedding"))
    docs = load(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), "n_chars")
    return H.rerank(fetch_fields(hits, [(docs, "vec_id", "left")]), "n_chars", "vec_id")
