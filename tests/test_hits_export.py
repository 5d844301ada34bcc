import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from vexa.operators import dml as D
from vexa.operators.aggregates import exact_percentile
from vexa.operators.export import KeysetExport, exported
from vexa.operators.knn import top_k
from vexa.plans.registry import load
from vexa.session import scratch_path
from vexa.sources import io as IO
from vexa.streaming import jobs as J
from vexa.streaming.hits import KeptHits


def rows(df):
    return sorted((r.qid, r.rank, r.vec_id, round(r.score, 9)) for r in df.collect())


def queries(spark):
    emb = load(spark, SF, "embeddings")
    return emb, emb.where("vec_id < 6").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qv"))


def exact(df, q, k=10):
    return rows(top_k(df, q, k=k, id_col="vec_id", vec_col="embedding"))


def test_each_batch_answers_for_its_prefix_and_replay_changes_nothing(spark):
    emb, q = queries(spark)
    parts = [emb.where("vec_id < 4"), emb.where("vec_id >= 4 AND vec_id < 15"), emb.where("vec_id >= 15 AND vec_id < 300"), emb.where("vec_id >= 300")]
    kept = KeptHits(spark, q, scratch_path(spark, "kept"), id_col="vec_id", vec_col="embedding", k=10, spare=3)
    batches: dict[int, list] = {}

    def on_batch(df, b):
        batches[b] = [r.vec_id for r in df.select("vec_id").collect()]
        kept.add(df, b)
        kept.add(df, b)  # foreachBatch may repeat a batch

    J.run_arrivals(spark, parts, on_batch, "kept", files_per_trigger=1)
    seen: list[int] = []
    for b in sorted(batches):
        seen += batches[b]
        assert rows(kept.at(b)) == exact(emb.where(F.col("vec_id").isin(seen)), q)
    assert len(seen) == emb.count() and rows(kept.at()) == exact(emb, q)


def test_reads_as_of_a_version_while_rows_go_and_withdrawn_hits_are_refilled(spark):
    emb, q = queries(spark)
    kept = KeptHits(spark, q, scratch_path(spark, "going"), id_col="vec_id", vec_col="embedding", k=10, spare=4)
    kept.add(emb, 0)
    live, states, searched = emb, [exact(emb, q)], []
    full = KeptHits._search
    for b in range(1, 6):
        hit = [r.vec_id for r in kept.at().where("rank % 3 = 0").select("vec_id").distinct().collect()]
        gone = emb.where(F.col("vec_id").isin(hit))
        live = live.join(gone.select("vec_id"), "vec_id", "left_anti").select(*emb.columns)
        kept._search = lambda t, qs: (searched.append((b, qs.count())), full(kept, t, qs))[1]
        kept.remove(gone.select("vec_id"), b, live)
        kept.remove(gone.select("vec_id"), b, live)
        states.append(exact(live, q))
    for b, want in enumerate(states):  # every version is still readable
        assert rows(kept.at(b)) == want
    assert searched and all(n <= 6 for _, n in searched) and 1 not in {b for b, _ in searched}  # the spare hits serve the first deletion
    kept.add(emb.where("vec_id = 0").withColumn("vec_id", F.lit(9000).cast("long")), 6)
    again = live.unionByName(emb.where("vec_id = 0").withColumn("vec_id", F.lit(9000).cast("long")))
    assert rows(kept.at()) == exact(again, q)


def test_additions_after_deletions_never_hide_older_rows(spark):
    df = spark.createDataFrame([(i, [float(i)]) for i in range(40)], "vec_id long, embedding array<double>")
    q = spark.createDataFrame([(1, [0.0])], "qid int, qv array<double>")
    kept = KeptHits(spark, q, scratch_path(spark, "hide"), id_col="vec_id", vec_col="embedding", k=3, spare=2)
    kept.add(df.where("vec_id < 20"), 0)
    kept.remove(df.where("vec_id IN (0, 1)").select("vec_id"), 1, df.where("vec_id >= 2 AND vec_id < 20"))
    kept.add(df.where("vec_id >= 20"), 2)
    live = df.where("vec_id >= 2")
    assert rows(kept.at()) == exact(live, q, 3)
    kept.remove(df.where("vec_id < 39").select("vec_id"), 3, df.where("vec_id = 39"))
    assert [r.vec_id for r in kept.at().collect()] == [39]
    kept.remove(df.select("vec_id"), 4, df.limit(0))
    assert kept.at().count() == 0


def scored(spark):
    nan = float("nan")
    data = [(i, float(i % 7)) for i in range(50)] + [(None, 3.0), (60, None), (61, None), (None, None), (62, nan), (63, 3.0), (63, 3.0), (64, float("-inf"))]
    return spark.createDataFrame(data, "id long, score double").repartition(5), data


@pytest.mark.parametrize("ascending", [True, False])
@pytest.mark.parametrize("batch, chunk, ranges", [(7, 7, 4), (10, 35, 3), (100, 1000, 8)])
def test_export_in_batches_keeps_order_and_loses_nothing(spark, ascending, batch, chunk, ranges):
    df, data = scored(spark)
    path = scratch_path(spark, "export")
    n = KeysetExport(df, "score", "id", batch, ascending, ranges=ranges, chunk_rows=chunk).write(path)
    got = exported(spark, path).orderBy("rn").collect()
    assert n == -(-len(data) // batch) and [r.rn for r in got] == list(range(1, len(data) + 1))
    assert all(r.batch_no == (r.rn - 1) // batch for r in got)

    def key(r):
        i, s = r
        if s is None:
            return (2, 0, i is not None, i or 0)
        return (1, 0, i is not None, i or 0) if math.isnan(s) else (0, s if ascending else -s, i is not None, i or 0)
    want = sorted(data, key=key)
    assert [(r.id, str(r.score)) for r in got] == [(i, str(s)) for i, s in want]


def test_export_goes_on_after_any_batch(spark):
    df, data = scored(spark)
    layout, whole = scratch_path(spark, "layout"), scratch_path(spark, "whole")
    KeysetExport(df, "score", "id", 9, ranges=4, layout=layout).write(whole)
    want = [tuple(r) for r in exported(spark, whole).orderBy("rn").select("rn", "id", "_tie").collect()]
    for stop in (9, 20, 27, 54):
        path = scratch_path(spark, "part")
        KeysetExport(df, "score", "id", 9, ranges=4, layout=layout, chunk_rows=9).write(path, limit=stop)
        again = KeysetExport(df, "score", "id", 9, ranges=4, layout=layout, chunk_rows=18)
        reads = []
        inner = again.rows_behind
        again.rows_behind = lambda c, n: (reads.append(c), inner(c, n))[1]
        again.write(path)
        assert [tuple(r) for r in exported(spark, path).orderBy("rn").select("rn", "id", "_tie").collect()] == want
        assert reads[0] is not None and len(reads) <= -(-(len(data) - 9 * (stop // 9)) // 18)
    empty = KeysetExport(df.limit(0), "score", "id", 9)
    assert empty.write(scratch_path(spark, "none")) == 0


def test_percentile_by_selection(spark):
    rng = np.random.default_rng(0)
    groups = {"one": [4.25] * 500, "many": list(rng.exponential(3.0, 3001)), "wide": list(rng.normal(size=200) * 10.0 ** rng.integers(-300, 300, 200)),
              "ends": [-1.7e308, 1.7e308, 0.0, 5e-324, 1e-323], "few": [1.0, 2.0], "single": [9.0], "mixed": [1.0] * 99 + [1.0 + 2 ** -52] * 101}
    data = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("nulls", None), ("one", None), (None, 3.0), (None, 4.0)]
    df = spark.createDataFrame(data, "g string, v double").repartition(7)
    for p in (0.0, 0.5, 0.99, 1.0):
        got = {r.g: r.p for r in exact_percentile(df, ["g"], "v", p).collect()}
        assert got["nulls"] is None and got[None] == pytest.approx(np.percentile([3.0, 4.0], 100 * p))
        for g, vs in groups.items():
            if g != "ends":
                assert got[g] == pytest.approx(np.percentile(vs, 100 * p), rel=1e-12), (g, p)
    inf = float("inf")
    odd = spark.createDataFrame([("a", x) for x in (-inf, -inf, 1.0, inf)] + [("b", float("nan")), ("b", 1.0)], "g string, v double")
    assert {r.g: str(r.p) for r in exact_percentile(odd, ["g"], "v", 1.0).collect()} == {"a": "inf", "b": "nan"}
    assert {r.g: str(r.p) for r in exact_percentile(odd, ["g"], "v", 0.0).collect()} == {"a": "-inf", "b": "1.0"}
    plan = exact_percentile(df, ["g"], "v", 0.99)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    assert [r.p for r in exact_percentile(df.where("g = 'many'"), [], "v", 0.5).collect()] == [pytest.approx(np.median(groups["many"]))]


def test_high_dimensions_stay_within_a_block(spark):
    from vexa.operators import knn
    rng = np.random.default_rng(5)
    dim, n = 4096, 300
    base = rng.normal(size=(n, dim)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(base)], "vec_id long, embedding array<float>").repartition(1)
    q = spark.createDataFrame([(i, base[i].tolist()) for i in range(3)], "qid int, qv array<double>")
    found = top_k(df, q, k=5, id_col="vec_id", vec_col="embedding").collect()
    d = ((base[:3, None].astype(float) - base[None].astype(float)) ** 2).sum(-1)
    for r in found:
        assert r.vec_id == np.argsort(d[r.qid], kind="stable")[r.rank - 1]
    # a batch of 10,000 rows as the task sees it
    import pyarrow as pa
    import tracemalloc
    flat = np.zeros(10_000 * dim, np.float32)
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(10_000)), pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, dim, dtype=np.int32), pa.array(flat))],
                                       ["vec_id", "embedding"])

    class Shared:
        value = (np.arange(10), rng.normal(size=(10, dim)), None)
    run = knn._partition_topk(Shared, 10, "L2", "vec_id", "embedding", pa.int64(), pa.int64())
    tracemalloc.start()
    out = list(run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(b.num_rows for b in out) == 100 and peak < 300e6


def test_generated_rows_do_not_depend_on_partitions(spark):
    fields = [("seq", "sequence", 5, 3), ("skey", "string_key", 16), ("n", "long", 7), ("u", "uniform", 2, 4), ("z", "normal", 1, 2),
              ("v", "normal_vector", 3), ("w", "uniform_vector", 2)]
    got = [sorted(tuple(r) for r in IO.generate_table(spark.range(4000).repartition(n), "id", fields, 3).collect()) for n in (1, 16)]
    assert got[0] == got[1]
    z = np.array([r[5] for r in got[0]])
    assert abs(z.mean() - 1) < 0.15 and abs(z.std() - 2) < 0.15 and len({r[2] for r in got[0]}) == 4000
    assert got[0][10][1] == 35 and all(2 <= r[4] < 4 and 0 <= r[3] < 7 for r in got[0])
    other = {r.id: r.z for r in IO.generate_table(spark.range(4000), "id", fields[4:5], 3).collect()}
    assert all(other[r[0]] == r[5] for r in got[0])
    with pytest.raises(ValueError):
        IO.generate_table(spark.range(1), "id", [("x", "colour")], 1)


def test_a_session_reads_its_own_last_write(spark):
    log = spark.createDataFrame([("k", 1.0, 100, 0), ("k", 2.0, 200, 1), ("k", 3.0, 300, 2), ("j", 9.0, 150, 1), ("j", 8.0, 290, 2)],
                                "key string, v double, t long, w int").withColumn("t", F.timestamp_seconds("t"))
    own = D.last_commits(log, "w", "t")
    got = D.session_snapshots(log, own, ["key"], "t", "w", F.timestamp_seconds(F.lit(300)), 140).collect()
    # the bounded cutoff is 160: writer 0 reads up to it, writer 1 its own 200, writer 2 everything
    assert sorted((r.session, r.key, r.v) for r in got) == [(0, "j", 9.0), (0, "k", 1.0), (1, "j", 9.0), (1, "k", 2.0), (2, "j", 8.0), (2, "k", 3.0)]
