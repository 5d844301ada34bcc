import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from vexa.operators import common
from vexa.operators import dml as D
from vexa.operators import docscore as DS
from vexa.operators.aggregates import order_statistics
from vexa.operators.knn import top_k
from vexa.operators.multiknn import Search, search_many
from vexa.plans.registry import load


def rows(df):
    return sorted((r.qid, r.rank, r.vec_id, round(r.score, 9)) for r in df.collect())


def test_several_searches_in_one_scan_equal_single_ones(spark):
    emb = load(spark, SF, "embeddings").withColumn("other", F.transform("embedding", lambda x: x * (1 + F.col("vec_id") % 5)))
    emb = emb.withColumn("other", F.when(F.col("vec_id") % 7 != 0, F.col("other")))
    q = emb.where("vec_id % 50 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qv"))
    few = F.col("label") == 3
    found = search_many(emb, q, [Search("l2", "embedding"), Search("ip", "other", "IP"), Search("cos", "other", "COSINE", few),
                                 Search("head", "embedding", "L2", None, (0, 8)), Search("none", "embedding", "L2", F.lit(False))],
                        k=5, id_col="vec_id").cache()

    def part(name):
        return rows(found.where(F.col("search") == name))

    def single(base, queries, **kw):
        return rows(top_k(base, queries, k=5, id_col="vec_id", **kw))

    assert part("l2") == single(emb, q, vec_col="embedding")
    assert part("ip") == single(emb, q, vec_col="other", metric="IP")
    assert part("cos") == single(emb.where(few), q, vec_col="other", metric="COSINE")
    assert part("head") == single(emb.withColumn("e8", F.slice("embedding", 1, 8)), q.withColumn("qv", F.slice("qv", 1, 8)), vec_col="e8")
    assert part("none") == []
    assert "BatchScan" not in found._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("percent", [0.0, 0.4, 20.0, 100.0])
def test_sample_of_each_segment_by_counting(spark, percent):
    data = [(s, k) for s in range(4) for k in range(37 * s)] + [(9, 5)] * 40 + [(None, 1), (None, 2), (8, None), (8, 3)]
    df = spark.createDataFrame(data, "seg int, k long").repartition(5)
    got = sorted(D.sample_keys_per_segment(df, "seg", "k", percent).collect(), key=str)
    want = []
    for s in {s for s, _ in data}:
        own = [k for t, k in data if t == s]
        own.sort(key=lambda k: ("", -1) if k is None else (hashlib.md5(str(k).encode()).hexdigest(), k))
        want += [(s, k) for k in own[:math.floor(percent * len(own) / 100)]]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_order_statistics(spark):
    df = spark.createDataFrame([("a", float(x)) for x in range(100)] + [("b", 5.0)] * 3, "g string, v double")
    got = {r.g: tuple(r)[1:] for r in order_statistics(df, ["g"], "v", lambda n: [F.lit(0), F.floor(n / 2), n - 1]).collect()}
    assert got == {"a": (100, 0.0, 50.0, 99.0), "b": (3, 5.0, 5.0, 5.0)}


def test_a_side_is_evaluated_once_and_measured(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    changes = spark.range(10, 20).withColumn("v", F.lit(1)).mapInArrow(count, "id long, v int")
    base = spark.range(15).withColumn("v", F.lit(0))
    out = D.upsert(base, changes, ["id"])
    assert sorted(tuple(r) for r in out.collect()) == [(i, 0) for i in range(10)] + [(i, 1) for i in range(10, 20)]
    assert seen.value == 10
    big = spark.range(1000).withColumn("s", F.sha2(F.col("id").cast("string"), 256))
    assert "broadcast" in common.broadcast_if_small(big)._jdf.queryExecution().logical().toString().lower()
    monkeypatch.setattr(common, "BROADCAST_BYTES", 1000)
    assert "broadcast" not in common.broadcast_if_small(big)._jdf.queryExecution().logical().toString().lower()


def test_document_scores_of_odd_texts_and_many_passes(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "apple apple pear"), (2, "Pear"), (3, None), (4, ""), (5, "!!"), (6, "apple apple pear"), (None, "plum")],
                                 "doc_id long, text string")
    index = DS.build(spark, docs)
    assert (index.n_docs, index.avgdl) == (7, 8 / 7)
    assert {r.term: r.df for r in index.frequencies(spark).collect()} == {"apple": 2, "pear": 3, "plum": 1}
    q = spark.createDataFrame([(10, "APPLE pear zebra"), (11, "pear pear"), (12, ""), (13, None), (14, "plum")], "qid long, qt string")
    want = None
    for limit in (200_000, 1):
        monkeypatch.setattr(DS, "PASS_TERMS", limit)
        got = [tuple(r) for r in DS.bm25(spark, index, DS.query_vectors(q, "qid", "qt"), 2).orderBy("qid", "rank").collect()]
        assert want is None or got == want
        want = got

    def score(tf, dl, df):
        return math.log(1 + (7 - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / (8 / 7)))
    both = score(2, 3, 2) + score(1, 3, 3)
    assert [(r[0], r[1], r[3]) for r in want] == [(10, 1, 1), (10, 6, 2), (11, 2, 1), (11, 1, 2)]
    assert want[0][2] == want[1][2] == pytest.approx(both) and want[2][2] == pytest.approx(score(1, 1, 3))
    ip = DS.inner_products(spark, index.docs(spark), DS.query_vectors(q, "qid", "qt"), 5).where("qid = 10").orderBy("rank").collect()
    assert [(r.doc_id, r.score) for r in ip] == [(1, 3.0), (6, 3.0), (2, 1.0)]
