"""Inverted index and BM25.

Index build (one job, persisted to the shared scratch folder and re-read,
which also cuts lineage):

* postings  ``(term, doc_id, dl, tf)`` -- counted per document where its text
                                          is read, the document length carried along;
* term table ``(term, df)``            -- count per term, map-side partial agg,
                                          so a term in every document costs one
                                          partial row per task;
* N = row count of the input, avgdl = sum(tf) / N.

Postings are range-partitioned and sorted by term before writing, so a
query's terms hit few files and Parquet min/max statistics skip the rest.

Query: the distinct query terms (bounded by the query batch, size-checked
and broadcast) join the term table for idf and the postings for tf; the
per-(query, doc) sums are partially aggregated before the shuffle on
(qid, doc_id), and the k best per query survive a WindowGroupLimit.

BM25: idf = ln(1 + (N - df + 0.5) / (df + 0.5)); with k1 = 1.2, b = 0.75
score = sum over distinct query terms of idf * tf * (k1 + 1) /
(tf + k1 * (1 - b + b * dl / avgdl))   (Robertson & Zaragoza 2009).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vexa.functions.text import explode_tokens, tokenize
from vexa.operators.common import broadcast_query_side, rank_within
from vexa.session import scratch_path

# Fixed BM25 parameters.
K1 = 1.2
B = 0.75
TIE_PLACES = 9


@dataclass
class TextIndex:
    postings: DataFrame   # term, doc_id, dl, tf  (doc length carried on every posting)
    terms: DataFrame      # term, df
    n_docs: int
    avgdl: float


def build_index(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                path: str | None = None) -> TextIndex:
    """One tokenization pass; the document length rides on each posting, so
    a query never joins a per-document table.

    A document's terms are counted where its text is read and written once; both passes of the range partitioning read
    those counts, and the postings are shuffled once.  Only where an id repeats are its postings of equal length added up."""
    from vexa.operators.docscore import term_vectors
    path = path or scratch_path(spark, "text-index")
    term_vectors(docs, id_col, text_col).withColumnRenamed(id_col, "doc_id").write.parquet(f"{path}/counts")
    counted = spark.read.parquet(f"{path}/counts")
    repeated = counted.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count() > 0
    # explode_outer: see ``explode_tokens``
    postings = (counted.select("doc_id", "dl", F.explode_outer(F.arrays_zip("terms", "counts")).alias("t")).filter("t IS NOT NULL")
                .select(F.col("t.terms").alias("term"), "doc_id", "dl", F.col("t.counts").cast("long").alias("tf")))
    n_part = int(spark.conf.get("spark.sql.shuffle.partitions"))
    postings = postings.repartitionByRange(n_part, "term", "doc_id")
    if repeated:
        postings = postings.groupBy("term", "doc_id", "dl").agg(F.sum("tf").alias("tf"))
    postings.sortWithinPartitions("term", "doc_id").write.parquet(f"{path}/postings")
    p = spark.read.parquet(f"{path}/postings")
    n_docs, total = counted.agg(F.count(F.lit(1)), F.sum("dl")).first()  # every document, also those without tokens
    total = total or 0
    avgdl = float(total) / n_docs if n_docs else 0.0
    # df and the largest per-posting contribution (idf aside) of every term:
    # the upper bounds used by pruned queries
    (p.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max(_tf_part(avgdl, K1, B)).alias("max_part"))
     .write.parquet(f"{path}/terms"))
    return TextIndex(p, spark.read.parquet(f"{path}/terms"), int(n_docs), avgdl)


def _tf_part(avgdl: float, k1: float, b: float):
    tf = F.col("tf").cast("double")
    return (tf * F.lit(k1 + 1.0)) / (tf + F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * F.col("dl") / F.lit(avgdl)))


def query_terms(queries: DataFrame, qid_col: str, text_col: str) -> DataFrame:
    t = queries.select(F.col(qid_col).alias("qid"), explode_tokens(tokenize(text_col)).alias("term"))
    return t.where(F.col("term").isNotNull()).distinct()


PRUNE_MARGIN = 1e-6
SEED_TERMS = 3


def bm25_topk(index: TextIndex, qterms: DataFrame, k: int = 10, k1: float = K1, b: float = B,
              prune: bool = False) -> DataFrame:
    """``qterms(qid, term)`` distinct -> ``(qid, doc_id, score, rank)``.

    ``prune=True`` evaluates only documents that hold an *essential* term of
    the query, MaxScore style: with a lower bound theta on the query's k-th
    score (exact scores of a few strong seed postings), terms whose upper
    bounds sum to less than theta cannot lift a document into the top k on
    their own.  The result equals the exhaustive one.  It costs two extra
    scans of the query terms' postings and pays off for short queries with
    common terms over large corpora; for long queries of mostly rare terms
    (the benchmark passages) the exhaustive plan is faster, so it is opt-in."""
    n, avgdl = float(index.n_docs), index.avgdl
    q = qterms.join(index.terms, "term").withColumn(
        "idf", F.log(F.lit(1.0) + (F.lit(n) - F.col("df") + F.lit(0.5)) / (F.col("df") + F.lit(0.5))))
    q = broadcast_query_side(q.select("qid", "term", "idf", (F.col("idf") * F.col("max_part")).alias("ub")))
    part = F.col("idf") * _tf_part(avgdl, k1, b)
    if prune and (k1, b) == (K1, B):
        cand = _essential_candidates(index, q, part, k)
        hits = index.postings.join(q.select("qid", "term", "idf"), "term").join(cand, ["qid", "doc_id"], "left_semi")
    else:
        hits = index.postings.join(q.select("qid", "term", "idf"), "term")
    s = hits.groupBy("qid", "doc_id").agg(F.sum(part).alias("score"))
    # rank on scores rounded to 9 places: exact copies of a document must tie
    # (and fall back to doc_id) whatever order the sum was taken in
    return rank_within(s, ["qid"], [F.round("score", TIE_PLACES).desc(), F.col("doc_id").asc()], k)


def _essential_candidates(index: TextIndex, q: DataFrame, part, k: int) -> DataFrame:
    """(qid, doc_id) pairs that can still reach a query's top k."""
    spark = index.postings.sparkSession
    qt = q.select("qid", "term", "idf")
    # seeds: the k strongest postings of each query's best few terms, scored
    # exactly -- their k-th score is the bound theta
    top_terms = rank_within(q, ["qid"], [F.col("ub").desc(), F.col("term").asc()], SEED_TERMS,
                            name="_r").select("qid", "term")
    strong = index.postings.join(F.broadcast(top_terms), "term").withColumn("_p", _tf_part(index.avgdl, K1, B))
    seeds = rank_within(strong, ["qid"], [F.col("_p").desc(), F.col("doc_id").asc()], k * SEED_TERMS,
                        name="_r").select("qid", "doc_id").distinct()
    seeds = broadcast_query_side(seeds)
    seed_scores = (index.postings.join(qt, "term").join(seeds, ["qid", "doc_id"], "left_semi")
                   .groupBy("qid", "doc_id").agg(F.sum(part).alias("score")))
    kth = seed_scores.groupBy("qid").agg(F.min("score").alias("theta"), F.count(F.lit(1)).alias("n"))
    theta = {r.qid: r.theta for r in kth.collect() if r.n >= k}  # one row per query
    essential = []
    by_q: dict = {}
    for r in q.select("qid", "term", "ub").collect():  # the query-term set, bounded as above
        by_q.setdefault(r.qid, []).append((r.ub, r.term))
    for qid, terms in by_q.items():
        terms.sort()
        th = theta.get(qid)
        acc, i = 0.0, 0
        if th is not None:
            # non-essential prefix: its bounds sum below theta (with a margin
            # larger than the 9-place rounding used for ranking)
            while i < len(terms) and acc + terms[i][0] < th - PRUNE_MARGIN:
                acc += terms[i][0]
                i += 1
        essential.extend((qid, t) for _, t in terms[i:])
    ess = spark.createDataFrame(essential, q.select("qid", "term").schema)
    return (index.postings.join(broadcast_query_side(ess), "term").select("qid", "doc_id").distinct())
