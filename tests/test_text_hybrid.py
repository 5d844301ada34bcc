import math
from collections import Counter

import pyarrow as pa
import regex

from vexa.functions.text import text_match
from vexa.operators import docscore as DS
from vexa.operators import hybrid as H
from vexa.operators.sparse import from_map, sparse_ip_topk
from vexa.operators.text import bm25_topk, build_index, query_terms

DOCS = [(0, "river boat timetable"), (1, "cold mountain lake"), (2, "paper kite festival")]


def test_text_match_any_token(spark):
    df = spark.createDataFrame(DOCS, "id long, text string")
    got = sorted(r.id for r in df.where(text_match("text", "boat cold")).collect())
    assert got == [0, 1]


def _bm25(docs, query, k1=1.2, b=0.75):
    tok = {i: regex.findall(r"[\p{L}\p{N}]+", t.lower()) for i, t in docs}
    n = len(docs)
    avgdl = sum(len(t) for t in tok.values()) / n
    df = Counter(w for t in tok.values() for w in set(t))
    out = {}
    for i, t in tok.items():
        tf = Counter(t)
        s = 0.0
        for w in set(regex.findall(r"[\p{L}\p{N}]+", query.lower())):
            if tf[w]:
                idf = math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))
                s += idf * tf[w] * (k1 + 1) / (tf[w] + k1 * (1 - b + b * len(t) / avgdl))
        if s:
            out[i] = s
    return out


def test_bm25_matches_formula(spark):
    docs = DOCS + [(3, "cold cold timetable of boat kite"), (4, "Über große Maschinen")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    idx = build_index(spark, d)
    q = spark.createDataFrame([(1, "cold boat kite")], "qid long, text string")
    got = {r.doc_id: r.score for r in bm25_topk(idx, query_terms(q, "qid", "text"), 10).collect()}
    want = _bm25(docs, "cold boat kite")
    assert got.keys() == want.keys()
    assert all(math.isclose(got[i], want[i], rel_tol=1e-12) for i in want)


def test_sparse_drop_ratio(spark):
    base = from_map(spark.createDataFrame([(0, {2: 0.4, 31: 0.6, 77: 0.9}), (1, {5: 0.2, 48: 0.5, 77: 0.7})],
                                          "id long, v map<int,float>"), "id", "v").withColumnRenamed("term", "term")
    q = from_map(spark.createDataFrame([(7, {2: 0.2, 77: 1.0, 48: 0.05, 5: 0.01, 31: 0.3})],
                                       "qid long, v map<int,float>"), "qid", "v")
    got = [(r.id, round(r.score, 6)) for r in sparse_ip_topk(base, q, k=2, drop_ratio=0.2).orderBy("rank").collect()]
    # floor(0.2 * 5) = 1 dropped: index 5 (weight 0.01)
    assert got == [(0, round(0.4 * 0.2 + 0.6 * 0.3 + 0.9 * 1.0, 6)), (1, round(0.5 * 0.05 + 0.7 * 1.0, 6))]


def test_rrf_and_weighted(spark):
    a = spark.createDataFrame([(1, 10, 0.9, 1), (1, 11, 0.8, 2)], "qid long, id long, score double, rank long")
    b = spark.createDataFrame([(1, 11, 5.0, 1), (1, 12, 1.0, 2)], "qid long, id long, score double, rank long")
    r = {x.id: x.score for x in H.rrf([a, b], "id", 60, 5).collect()}
    assert math.isclose(r[11], 1 / 62 + 1 / 61) and math.isclose(r[10], 1 / 61) and math.isclose(r[12], 1 / 62)
    w = {x.id: x.score for x in H.weighted([(a, 0.8, True), (b, 0.3, True)], "id", 5).collect()}
    assert math.isclose(w[10], 0.8) and math.isclose(w[11], 0.3) and math.isclose(w[12], 0.0)


def test_bm25_pruned_equals_exhaustive(spark):
    from tests.conftest import SF
    from vexa.plans.registry import load
    idx = build_index(spark, load(spark, SF, "documents"))
    qt = query_terms(load(spark, SF, "benchmark"), "item_id", "text")
    full = sorted(tuple(r) for r in bm25_topk(idx, qt, 10, prune=False).collect())
    pruned = sorted(tuple(r) for r in bm25_topk(idx, qt, 10, prune=True).collect())
    assert len(full) > 0
    assert [(a[0], a[1], a[3]) for a in full] == [(b[0], b[1], b[3]) for b in pruned]
    assert all(math.isclose(a[2], b[2], rel_tol=1e-12) for a, b in zip(full, pruned))


def test_term_vectors_work_on_bounded_runs(spark, monkeypatch):
    """Rows of any length, cut into runs of few tokens, give the vectors and hits of one run."""
    docs = [(i, " ".join(f"w{(i * j) % 17}" for j in range(i % 23))) for i in range(1, 200)] + [(500, None), (501, ""), (502, "w3 " * 400)]
    lists = pa.array([["a"] * n for n in (0, 3, 9, 0, 2, 2, 1)])
    monkeypatch.setattr(DS, "ENTRIES", 4)
    assert list(DS._entry_runs(lists)) == [(0, 2), (2, 3), (3, 6), (6, 7)]
    d = spark.createDataFrame(docs, "doc_id long, text string").coalesce(2)
    q = spark.createDataFrame([(1, "w3 w5 w11"), (2, "w1")], "qid long, text string")

    def run(entries):
        monkeypatch.setattr(DS, "ENTRIES", entries)  # travels with the module's functions in local mode
        vectors = {r.doc_id: (r.dl, r.terms, r.counts) for r in DS.term_vectors(d, "doc_id", "text").collect()}
        idx = DS.build(spark, d)
        return vectors, sorted(tuple(r) for r in DS.bm25(spark, idx, DS.query_vectors(q, "qid", "text"), 7).collect())

    assert run(4) == run(1 << 30)


def test_postings_are_counted_where_the_text_is_read(spark):
    """One shuffle of postings; repeated and null ids add up as far as their lengths are equal."""
    docs = [(1, "a b a"), (1, "a c c"), (1, "a"), (None, "b b"), (None, "b x"), (2, None), (3, "!"), (4, "B a")]
    idx = build_index(spark, spark.createDataFrame(docs, "doc_id long, text string"))
    got = sorted(((r.term, r.doc_id, r.dl, r.tf) for r in idx.postings.collect()), key=str)
    want = Counter()
    for i, t in docs:
        words = regex.findall(r"[\p{L}\p{N}]+", (t or "").lower())
        for w in words:
            want[w, i, len(words)] += 1
    assert got == sorted(((*k, n) for k, n in want.items()), key=str)
    assert idx.n_docs == len(docs) and idx.avgdl == sum(want.values()) / len(docs)
    assert {r.term: r.df for r in idx.terms.collect()} == Counter(k[0] for k in want)
    counts = spark.read.parquet(idx.postings.inputFiles()[0].split("/postings/")[0] + "/counts")
    assert counts.count() == len(docs)
