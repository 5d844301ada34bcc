import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from vexa.functions import vectors as V
from vexa.operators import evaluate as E
from vexa.operators import ivf, lsh
from vexa.operators.knn import top_k
from vexa.plans.registry import load

TABLES = [SF, "/root/testdata/sf0.01", "/root/testdata/sf0.1"]


def twentieths(spark, sf):
    emb = load(spark, sf, "embeddings")
    q = emb.where("vec_id % 20 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qv"))
    truth = top_k(emb, q, k=10, id_col="vec_id", vec_col="embedding").cache()
    return emb, q, truth


def recall(found, truth):
    return E.mean_recall(E.recall_per_query(found, truth, "vec_id", 10)).first()["recall"]


def rows(df):
    return sorted((r.qid, r.rank, r.vec_id, round(r.score, 6)) for r in df.collect())


@pytest.mark.parametrize("sf", TABLES)
def test_ivf_recall_and_work_fall_with_the_probes(spark, sf):
    emb, q, truth = twentieths(spark, sf)
    idx = ivf.build(spark, emb, "vec_id", "embedding")
    assert 0 < idx.nprobe < idx.nlist
    measured, work = [], []
    for p in (1, idx.nprobe, idx.nlist):
        scored = spark.sparkContext.accumulator(0)
        measured.append(recall(ivf.search(spark, idx, q, nprobe=p, scored=scored), truth))
        work.append(scored.value / (q.count() * emb.count()))
    print(sf, idx.nlist, idx.nprobe, measured, work)
    assert measured[1] >= 0.9 and measured[2] == 1.0 and measured[0] < measured[1]
    assert work[0] < 3 / idx.nlist and work[0] < work[1] < work[2] == 1.0


@pytest.mark.parametrize("sf", TABLES)
def test_codes_leave_few_rows_to_score_and_lose_none(spark, sf):
    emb, q, truth = twentieths(spark, sf)
    idx = ivf.build(spark, emb, "vec_id", "embedding", sub_spaces=32)
    scored = spark.sparkContext.accumulator(0)
    found = ivf.exact_search(spark, idx, q, scored=scored)
    assert rows(found) == rows(truth)
    share = scored.value / (q.count() * emb.count())
    print(sf, "share scored", share)
    assert share < 0.2
    size = idx.table(spark).where("cell >= 0").agg(F.max(F.octet_length("_code")).alias("c"), F.max(F.octet_length("_error")).alias("e")).first()
    assert (size.c, size.e) == (32, 32)  # one byte each


def test_whole_cells_drop_out_where_rows_cluster(spark):
    rng = np.random.default_rng(3)
    centres = 20 * rng.normal(size=(12, 16))
    pts = [(i, [float(v) for v in centres[i % 12] + 0.1 * rng.normal(size=16)]) for i in range(1200)]
    df = spark.createDataFrame(pts, "vec_id long, embedding array<double>")
    q = df.where("vec_id % 100 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qv"))
    idx = ivf.build(spark, df, "vec_id", "embedding", nlist=12, sub_spaces=8)
    scored = spark.sparkContext.accumulator(0)
    found = ivf.exact_search(spark, idx, q, first_probe=1, scored=scored)
    assert rows(found) == rows(top_k(df, q, k=10, id_col="vec_id", vec_col="embedding"))
    assert scored.value <= 12 * 200


def test_index_is_read_again_and_odd_rows_are_never_found(spark):
    nan = float("nan")
    odd = [(i, [float(i), float(i % 3)]) for i in range(40)] + [(100, None), (101, [1.0]), (102, [nan, 1.0]), (103, [1.0, None]), (7, [7.0, 1.0])]
    df = spark.createDataFrame(odd, "vec_id long, embedding array<double>")
    q = spark.createDataFrame([(1, [3.2, 0.5]), (2, [38.0, 1.0]), (3, None)], "qid int, qv array<double>")
    idx = ivf.build(spark, df, "vec_id", "embedding", nlist=5, sub_spaces=2)
    again = ivf.open_index(spark, idx.path)
    assert again == idx and idx.table(spark).count() == len(odd)
    truth = rows(top_k(df.where("vec_id < 100"), q.where("qv IS NOT NULL"), k=10, id_col="vec_id", vec_col="embedding"))
    assert rows(ivf.search(spark, again, q, nprobe=again.nlist)) == truth == rows(ivf.exact_search(spark, again, q))
    with pytest.raises(ValueError):
        ivf.search(spark, again, spark.createDataFrame([(1, [1.0])], "qid int, qv array<double>"))
    empty = ivf.build(spark, df.limit(0), "vec_id", "embedding", sub_spaces=2)
    assert ivf.search(spark, empty, q).count() == 0


@pytest.mark.parametrize("metric", ["L2", "IP", "COSINE"])
def test_settings_and_filters_in_one_scan_equal_single_searches(spark, metric):
    emb, q, _ = twentieths(spark, SF)
    idx = ivf.build(spark, emb, "vec_id", "embedding", nlist=9)
    filters = {"all": None, "some": F.col("label") >= 5, "none": F.col("label") > 99}
    found = ivf.search_settings(spark, idx, q, [1, 9, 4], filters, k=5, metric=metric).cache()
    for name, cond in filters.items():
        for p in (1, 4, 9):
            one = ivf.search(spark, idx, q, k=5, nprobe=p, metric=metric, where=cond)
            part = found.where((F.col("filter_name") == name) & (F.col("nprobe") == p))
            assert rows(part) == rows(one)
            if p == 9:
                base = emb if cond is None else emb.where(cond)
                assert rows(one) == rows(top_k(base, q, k=5, metric=metric, id_col="vec_id", vec_col="embedding"))


@pytest.mark.parametrize("sf", TABLES)
@pytest.mark.parametrize("factor", [1.0, 500.0])
def test_lsh_recall_with_few_pairs_at_any_scale(spark, sf, factor):
    if factor != 1.0 and sf != SF:
        return
    emb, q, truth = twentieths(spark, sf)
    emb = emb.withColumn("embedding", F.transform("embedding", lambda x: x * factor))
    q = q.withColumn("qv", F.transform("qv", lambda x: x * factor))
    tables = lsh.learn(emb, "vec_id", "embedding")
    scored = spark.sparkContext.accumulator(0)
    found = lsh.search(emb, q, tables, id_col="vec_id", vec_col="embedding", scored=scored)
    got = recall(found, truth)
    share = scored.value / (q.count() * emb.count())
    print(sf, factor, "recall", got, "share", share, "reach", tables.reach, "differ", tables.differ)
    assert got >= 0.9 and share < 0.2


@pytest.mark.parametrize("sf", TABLES)
def test_minhash_recall_for_bit_vectors(spark, sf):
    emb = load(spark, sf, "embeddings").select("vec_id", V.sign_bits("embedding", 64).alias("bits"))
    q = emb.where("vec_id % 20 = 0").select(F.col("vec_id").alias("qid"), F.col("bits").alias("qv"))
    truth = top_k(emb, q, k=10, metric="JACCARD", id_col="vec_id", vec_col="bits")
    scored = spark.sparkContext.accumulator(0)
    found = lsh.minhash_search(emb, q, lsh.learn_minhash(emb, "vec_id", "bits"), id_col="vec_id", vec_col="bits", scored=scored)
    # hits at the same distance as the k-th are as good: compare distances
    worst = truth.groupBy("qid").agg(F.max("score").alias("kth"))
    good = found.join(worst, "qid").where(F.col("score") <= F.col("kth") + 1e-12).count() / (10 * q.count())
    share = scored.value / (q.count() * emb.count())
    print(sf, "recall", good, "share", share)
    assert good >= 0.9


def test_probes_are_all_buckets_within_reach():
    rng = np.random.default_rng(1)
    t = lsh.SignTables(None, None, None, None, None, reach=0.8)
    y = rng.normal(size=(2, 7))
    got = set(t.probes(y))
    for k in range(2):
        own = int((y[k] > 0) @ (1 << np.arange(7)))
        for b in range(128):
            cost = sum(y[k, i] ** 2 for i in range(7) if (own ^ b) >> i & 1)
            assert ((k, b) in got) == (cost <= 0.8)


def test_sign_bits_of_any_dimension(spark):
    nan = float("nan")
    vecs = [[1.0, -1.0, 0.0] * 25, [0.5] * 75, [None, 1.0], [], None, [nan] + [-1.0] * 74]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vecs)], "id int, v array<double>")
    got = {r.id: r.b for r in df.select("id", V.sign_bits("v", 75).alias("b")).collect()}
    for i, v in enumerate(vecs):
        bits = sum(1 << j for j, x in enumerate(v or []) if x is not None and (x > 0 or x != x))
        assert [w & (2 ** 64 - 1) for w in got[i]] == [bits & (2 ** 64 - 1), bits >> 64]


def test_cells_beyond_mllib_equal_kmeans_in_memory(spark, monkeypatch):
    """No round of the k-means sends more to the driver than one number for each row of the sample."""
    def mllib(*a, **b):
        raise AssertionError("MLlib sends the distances of all pairs of centres to the driver")

    monkeypatch.setattr("pyspark.ml.clustering.KMeans", mllib)
    monkeypatch.setattr(ivf, "BLOCK_CELLS", 40_000)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 8))
    got = ivf._coarse(spark, x, 300, 42)
    assert got.shape == (300, 8) and np.allclose(got, ivf._lloyd(x, 300, 42))


def test_recall_with_cells_beyond_mllib(spark, monkeypatch):
    monkeypatch.setattr(ivf, "MLLIB_CELLS", 8)
    emb, q, truth = twentieths(spark, "/root/testdata/sf0.01")
    idx = ivf.build(spark, emb, "vec_id", "embedding")
    assert idx.nlist > 8 and recall(ivf.search(spark, idx, q), truth) >= 0.9
