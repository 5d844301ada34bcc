import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vexa.functions import vectors as V
from vexa.operators.knn import centroid_queries, export_batches, top_k


def _base(spark, rows):
    return spark.createDataFrame(rows, "id long, vector array<float>")


def _q(spark, rows):
    return spark.createDataFrame(rows, "qid long, qv array<double>")


def brute(base, q, k, metric):
    out = {}
    for qid, qv in q:
        s = []
        for i, v in base:
            if v is None or len(v) != len(qv):
                continue
            a, b = np.array(qv, float), np.array(v, float)
            if metric == "L2":
                d = float(((a - b) ** 2).sum())
            elif metric == "IP":
                d = -float(a @ b)
            else:
                n = np.linalg.norm(a) * np.linalg.norm(b)
                d = -(0.0 if n == 0 else float(a @ b) / n)
            s.append((d, i))
        out[qid] = [i for _, i in sorted(s)[:k]]
    return out


@pytest.mark.parametrize("metric", ["L2", "IP", "COSINE"])
def test_topk_matches_brute_force(spark, metric):
    rng = np.random.default_rng(3)
    base = [(i, [float(x) for x in rng.normal(size=8).astype(np.float32)]) for i in range(300)]
    qs = [(q, [float(x) for x in rng.normal(size=8)]) for q in range(7)]
    got = top_k(_base(spark, base).repartition(5), _q(spark, qs), k=10, metric=metric, id_col="id", vec_col="vector")
    res = {}
    for r in got.orderBy("qid", "rank").collect():
        res.setdefault(r.qid, []).append(r.id)
    assert res == brute(base, qs, 10, metric)


def test_ties_broken_by_id_and_partition_independent(spark):
    base = [(i, [1.0, 0.0]) for i in range(50, 0, -1)] + [(100, [0.0, 0.0])]
    q = _q(spark, [(1, [0.0, 0.0])])
    for parts in (1, 3, 17):
        got = top_k(_base(spark, base).repartition(parts), q, k=5, id_col="id", vec_col="vector")
        assert [r.id for r in got.orderBy("rank").collect()] == [100, 1, 2, 3, 4]


def test_k_larger_than_n_null_and_wrong_dim_skipped(spark):
    base = _base(spark, [(1, [1.0, 1.0]), (2, None), (3, [1.0]), (4, [2.0, 2.0])])
    got = top_k(base, _q(spark, [(9, [0.0, 0.0])]), k=10, id_col="id", vec_col="vector")
    assert [(r.id, r.rank) for r in got.orderBy("rank").collect()] == [(1, 1), (4, 2)]


def test_empty_after_filter_and_multi_pass(spark):
    base = _base(spark, [(i, [float(i), 1.0]) for i in range(20)])
    q = _q(spark, [(j, [float(j), 0.0]) for j in range(6)])
    assert top_k(base.where("id < 0"), q, k=3, id_col="id", vec_col="vector").count() == 0
    one = top_k(base, q, k=3, id_col="id", vec_col="vector").orderBy("qid", "rank").collect()
    many = top_k(base, q, k=3, id_col="id", vec_col="vector", max_queries_per_pass=2).orderBy("qid", "rank").collect()
    assert [tuple(r) for r in one] == [tuple(r) for r in many]


def test_zero_vector_cosine_is_zero(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    r = df.select(V.cosine("a", "b").alias("c"), V.normalize("a").alias("n")).first()
    assert r.c == 0.0 and list(r.n) == [0.0, 0.0]


def test_hamming_and_jaccard_bits(spark):
    df = spark.createDataFrame([([1.0, -1.0, 2.0, -3.0], [1.0, 1.0, -2.0, -3.0])], "a array<double>, b array<double>")
    bits = df.select(V.sign_bits("a", 4).alias("x"), V.sign_bits("b", 4).alias("y"))
    r = bits.select(V.hamming("x", "y").alias("h"), V.jaccard("x", "y").alias("j")).first()
    assert r.h == 2 and math.isclose(r.j, 1 - 1 / 3)


def test_unit_vectors_l2_and_cosine_rank_alike(spark):
    rng = np.random.default_rng(5)
    vs = rng.normal(size=(100, 6))
    vs /= np.linalg.norm(vs, axis=1, keepdims=True)
    base = _base(spark, [(i, [float(x) for x in v]) for i, v in enumerate(vs)])
    q = _q(spark, [(0, [float(x) for x in vs[0]])])
    a = top_k(base, q, k=10, metric="L2", id_col="id", vec_col="vector").orderBy("rank").collect()
    b = top_k(base, q, k=10, metric="COSINE", id_col="id", vec_col="vector").orderBy("rank").collect()
    assert [r.id for r in a] == [r.id for r in b]


def test_centroids_and_export_batches(spark):
    df = spark.createDataFrame([(1, 0, [1.0, 3.0]), (2, 0, [3.0, 5.0]), (3, 1, [0.0, 0.0])],
                               "id long, g int, vector array<float>")
    c = {r.qid: list(r.qv) for r in centroid_queries(df, "g", "vector").collect()}
    assert c == {0: [2.0, 4.0], 1: [0.0, 0.0]}
    scored = spark.range(0, 250).select(F.col("id"), (F.col("id") % 10).cast("double").alias("score"))
    out = export_batches(scored, "score", "id", 100, limit=230).orderBy("rn").collect()
    assert len(out) == 230 and out[0].id == 0 and out[1].id == 10 and out[-1].batch_no == 2
    assert [r.rn for r in out] == list(range(1, 231))


@pytest.mark.parametrize("n_queries", [1, 10])
@pytest.mark.parametrize("metric", ["L2", "IP", "COSINE"])
def test_many_splits_keep_every_hit(spark, metric, n_queries):
    rng = np.random.default_rng(11)
    base = [(i, [float(x) for x in rng.normal(size=16).astype(np.float32)]) for i in range(500)]
    qs = [(q, [float(x) for x in rng.normal(size=16)]) for q in range(n_queries)]
    got = top_k(_base(spark, base).repartition(250), _q(spark, qs), k=10, metric=metric, id_col="id", vec_col="vector")
    res = {}
    for r in got.orderBy("qid", "rank").collect():
        res.setdefault(r.qid, []).append(r.id)
    assert res == brute(base, qs, 10, metric)


def test_l2_far_from_the_origin(spark):
    rng = np.random.default_rng(12)
    base = [(i, (10_000 + rng.normal(scale=0.001, size=64)).tolist()) for i in range(3000)]
    qs = [(q, (10_000 + rng.normal(scale=0.001, size=64)).tolist()) for q in range(3)]
    df = spark.createDataFrame(base, "id long, vector array<double>").repartition(7)
    got = top_k(df, _q(spark, qs), k=10, id_col="id", vec_col="vector").orderBy("qid", "rank").collect()
    want = brute(base, qs, 10, "L2")
    assert {q: [r.id for r in got if r.qid == q] for q, _ in qs} == want
    b = dict(base)
    for r in got:
        assert r.score == pytest.approx(((np.array(b[r.id]) - np.array(qs[r.qid][1])) ** 2).sum(), rel=1e-6)


def test_queries_of_different_lengths_are_an_error(spark):
    with pytest.raises(ValueError):
        top_k(_base(spark, [(1, [1.0, 1.0])]), _q(spark, [(1, [0.0, 0.0]), (2, [0.0])]), id_col="id", vec_col="vector")


def test_export_puts_rows_without_score_last(spark):
    scored = spark.createDataFrame([(0, 5.0), (1, 1.0), (2, None), (3, 2.0)], "id long, score double")
    for limit in (2, 3, 10):
        got = [r.id for r in export_batches(scored, "score", "id", 2, limit=limit).orderBy("rn").collect()]
        assert got == [1, 3, 0, 2][:limit]


def test_limited_export_keeps_first_rows(spark):
    scored = spark.range(0, 3000, 1, 6).select(F.col("id"), ((F.col("id") * 7919) % 1000).cast("double").alias("score"))
    got = [(r.rn, r.id, r.batch_no) for r in export_batches(scored, "score", "id", 25, limit=100).orderBy("rn").collect()]
    want = sorted(((s, i) for i, s in ((i, float((i * 7919) % 1000)) for i in range(3000))))[:100]
    assert [(rn, i) for rn, i, _ in got] == [(n + 1, i) for n, (_, i) in enumerate(want)]
    assert got[-1][2] == 3
