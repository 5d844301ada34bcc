"""Scoring of term vectors by document partition.

Index.  One row per document: its distinct terms with their counts, and its length.  It is written without a shuffle, for a document's
terms are counted where its text is read.  A table of document frequencies goes with it; the number of documents and their mean length are kept
by the index object.

Search.  The queries' terms and weights are broadcast in bounded passes.  A task looks the terms of its documents up in them, adds
each document's contributions query by query, and returns its ``k`` best documents per query: every document is whole in one task, so no
(query, document) pair is shuffled, and a term that occurs everywhere costs no more than its postings.

BM25: idf = ln(1 + (N - df + 0.5) / (df + 0.5)); with k1 = 1.2, b = 0.75 score = sum over distinct query terms of
idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl)) (Robertson & Zaragoza 2009).  Ranks go by scores rounded to 9 places, then by id:
documents of equal terms tie whatever the order of the sum.  A document without an id counts, but is never a hit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vexa.functions.text import tokenize
from vexa.operators.common import rank_within
from vexa.operators.ivf import Tops
from vexa.operators.knn import _arrow_type
from vexa.operators.text import B, K1, TIE_PLACES
from vexa.session import scratch_path

PASS_TERMS = 200_000   # (query, term) pairs broadcast at once
CELLS = 1 << 21        # scores, and contributions, held at once
ENTRIES = 1 << 18      # tokens, or terms of documents, worked on at once by a task


@dataclass(frozen=True)
class DocIndex:
    path: str
    n_docs: int
    avgdl: float

    def docs(self, spark: SparkSession) -> DataFrame:
        """(doc_id, dl, terms, counts)."""
        return spark.read.parquet(f"{self.path}/docs")

    def frequencies(self, spark: SparkSession) -> DataFrame:
        """(term, df)."""
        return spark.read.schema("term string, df long").parquet(f"{self.path}/terms")


def _lengths(lists: pa.Array) -> np.ndarray:
    return lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _entry_runs(lists: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of rows whose lists have ``ENTRIES`` entries together at most; a longer list is a run of its own."""
    upto = np.concatenate([[0], np.cumsum(_lengths(lists))])
    lo = 0
    while lo < len(lists):
        hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] + ENTRIES, side="right")) - 1)
        yield lo, min(hi, len(lists))
        lo = hi


def term_vectors(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, dl, terms, counts): the distinct terms of each text, in order of first use by its task."""
    tok = docs.select(id_col, tokenize(text_col).alias("tokens"))
    out = T.StructType([docs.schema[id_col], T.StructField("dl", T.LongType()), T.StructField("terms", T.ArrayType(T.StringType())),
                        T.StructField("counts", T.ArrayType(T.IntegerType()))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in _entry_runs(b.column(1)):
                yield counted(b.slice(lo, hi - lo))

    def counted(b: pa.RecordBatch) -> pa.RecordBatch:
        tokens = b.column(1)
        lens = _lengths(tokens)
        coded = tokens.flatten().dictionary_encode()
        # by document and term, in the terms' own order, so that equal texts give equal rows
        rank = np.empty(len(coded.dictionary), np.int64)
        rank[pc.sort_indices(coded.dictionary).to_numpy()] = np.arange(len(coded.dictionary))
        pair = np.repeat(np.arange(b.num_rows), lens) * max(len(rank), 1) + rank[coded.indices.to_numpy(zero_copy_only=False)]
        found, n = np.unique(pair, return_counts=True)
        doc, term = found // max(len(rank), 1), found % max(len(rank), 1)
        offs = pa.array(np.searchsorted(doc, np.arange(b.num_rows + 1)).astype(np.int32))
        names = coded.dictionary.take(pc.sort_indices(coded.dictionary)).take(pa.array(term)).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(lens), pa.ListArray.from_arrays(offs, names), pa.ListArray.from_arrays(offs, pa.array(n.astype(np.int32)))],
            [id_col, "dl", "terms", "counts"])

    return tok.mapInArrow(count, out)


def build(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DocIndex:
    path = path or scratch_path(spark, "doc-index")
    term_vectors(docs, id_col, text_col).withColumnRenamed(id_col, "doc_id").write.parquet(f"{path}/docs")
    rows = spark.read.parquet(f"{path}/docs")
    # explode_outer: for explode Spark would infer a filter on the array and evaluate it twice
    terms = rows.select(F.explode_outer("terms").alias("term")).filter("term IS NOT NULL")
    terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")).write.parquet(f"{path}/terms")
    n, total = rows.agg(F.count(F.lit(1)), F.sum("dl")).first()
    return DocIndex(path, n, (total or 0) / n if n else 0.0)


def query_vectors(queries: DataFrame, qid_col: str, text_col: str) -> DataFrame:
    """(qid, term, w): the distinct terms of the query texts with their counts."""
    v = term_vectors(queries.select(F.col(qid_col).alias("qid"), text_col), "qid", text_col)
    pairs = v.select("qid", F.explode_outer(F.arrays_zip("terms", "counts")).alias("t")).filter("t IS NOT NULL")
    return pairs.groupBy("qid", F.col("t.terms").alias("term")).agg(F.sum("t.counts").cast("double").alias("w"))


def bm25(spark: SparkSession, index: DocIndex, queries: DataFrame, k: int = 10, k1: float = K1, b: float = B) -> DataFrame:
    """``queries`` (qid, term, ...) with distinct terms per query -> (qid, doc_id, score, rank)."""
    n = float(index.n_docs)
    idf = F.log(F.lit(1.0) + (F.lit(n) - F.col("df") + F.lit(0.5)) / (F.col("df") + F.lit(0.5)))
    weighted = queries.select("qid", "term").join(index.frequencies(spark), "term").select("qid", "term", idf.alias("w"))
    found = _search(index.docs(spark), weighted, k, ("bm25", k1, b, index.avgdl), places=TIE_PLACES)
    return rank_within(found, ["qid"], [F.round("score", TIE_PLACES).desc(), F.col("doc_id").asc()], k)


def inner_products(spark: SparkSession, docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id") -> DataFrame:
    """Sparse inner products of (id, terms, counts) with ``queries`` (qid, term, w): (qid, id, score, rank)."""
    found = _search(docs.select(F.col(id_col).alias("doc_id"), F.lit(0).cast("long").alias("dl"), "terms", "counts"), queries, k, ("dot",))
    found = found.withColumnRenamed("doc_id", id_col)
    return rank_within(found, ["qid"], [F.col("score").desc(), F.col(id_col).asc()], k)


def _search(docs: DataFrame, weighted: DataFrame, k: int, rule: tuple, places: int | None = None) -> DataFrame:
    spark = docs.sparkSession
    qid_type, id_type = weighted.schema["qid"].dataType, docs.schema["doc_id"].dataType
    out = T.StructType([T.StructField("qid", qid_type), T.StructField("doc_id", id_type), T.StructField("score", T.DoubleType())])
    path = scratch_path(spark, "query-terms")
    weighted.write.parquet(path)  # the joins behind it run once for all passes
    weighted = spark.read.schema(weighted.schema).parquet(path)
    passes = max(1, -(-weighted.count() // PASS_TERMS))
    found = None
    for p in range(passes):
        part = weighted.filter(F.pmod(F.xxhash64("qid"), F.lit(passes)) == p) if passes > 1 else weighted
        rows = part.select("qid", "term", "w").toArrow()  # about PASS_TERMS rows
        if not rows.num_rows:
            continue
        shared = spark.sparkContext.broadcast(_query_lists(rows))
        hits = docs.select("doc_id", "dl", "terms", "counts").filter("doc_id IS NOT NULL").mapInArrow(_scan(shared, k, rule, places, _arrow_type(qid_type), _arrow_type(id_type)), out)
        found = hits if found is None else found.unionByName(hits)
    return spark.createDataFrame([], out) if found is None else found


def _query_lists(rows: pa.Table):
    """Query ids, terms, and for each term the queries that hold it with their weights."""
    qids = rows.column("qid").combine_chunks().dictionary_encode()
    terms = rows.column("term").combine_chunks().dictionary_encode()
    who, term = qids.indices.to_numpy(zero_copy_only=False), terms.indices.to_numpy(zero_copy_only=False)
    order = np.lexsort((who, term))
    first = np.searchsorted(term[order], np.arange(len(terms.dictionary) + 1))
    return qids.dictionary.to_pylist(), terms.dictionary, first, who[order].astype(np.int64), rows.column("w").to_numpy()[order]


def _scan(shared, k: int, rule: tuple, places: int | None, qid_type, id_type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, terms, first, who, weight = shared.value
        tops = Tops(1, len(qids), k)
        everyone = np.arange(len(qids))
        for batch in batches:
            for b in (batch.slice(lo, hi - lo) for lo, hi in _entry_runs(batch.column(2))):
                lens = _lengths(b.column(2))
                at = pc.index_in(b.column(2).flatten(), value_set=terms).fill_null(-1).to_numpy(zero_copy_only=False)
                tf = b.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                doc = np.repeat(np.arange(b.num_rows), lens)
                known = at >= 0
                at, tf, doc = at[known], tf[known], doc[known]
                if rule[0] == "bm25":
                    _, k1, bb, avgdl = rule
                    dl = b.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
                    part = (tf * (k1 + 1.0)) / (tf + k1 * ((1.0 - bb) + bb * dl[doc] / avgdl))
                else:
                    part = tf
                n = first[at + 1] - first[at]
                ids = b.column(0).to_numpy(zero_copy_only=False)
                for lo, hi in _doc_runs(doc, n, b.num_rows, len(qids)):
                    s = slice(*np.searchsorted(doc, [lo, hi]))
                    if s.stop == s.start:
                        continue
                    c = n[s]
                    pos = np.repeat(first[at[s]] - (np.cumsum(c) - c), c) + np.arange(c.sum())
                    cell = who[pos] * (hi - lo) + np.repeat(doc[s] - lo, c)
                    value = np.repeat(part[s], c) * weight[pos]
                    score = np.bincount(cell, weights=value, minlength=len(qids) * (hi - lo)).reshape(len(qids), -1)
                    met = np.zeros(score.size, bool)
                    met[cell] = True
                    keys = np.where(met.reshape(score.shape), -(score if places is None else np.round(score, places)), np.inf)
                    tops.add(0, everyone, keys, ids[lo:hi], score)
        _, q, _, ids = tops.rows()
        yield pa.RecordBatch.from_arrays([pa.array([qids[i] for i in q], qid_type), pa.array(ids, id_type), pa.array(tops.payload())],
                                         ["qid", "doc_id", "score"])

    return run


def _doc_runs(doc: np.ndarray, n: np.ndarray, rows: int, queries: int) -> Iterator[tuple[int, int]]:
    """Runs of documents whose scores and contributions stay within ``CELLS`` each; a document with more is a run of its own."""
    per = np.bincount(doc, weights=n, minlength=rows).astype(np.int64)
    upto = np.concatenate([[0], np.cumsum(np.maximum(per, queries))])
    lo = 0
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] + CELLS, side="right")) - 1)
        yield lo, min(hi, rows)
        lo = min(hi, rows)
