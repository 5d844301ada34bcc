from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SF
from vexa.operators import ann as A
from vexa.operators.knn import top_k
from vexa.plans.registry import load
from vexa.session import scratch_path
from vexa.sources import schema as SC
from vexa.sources.versioned import VersionedTable
from vexa.streaming import jobs as J

DECL = T.StructType([SC.field("id", T.LongType(), pk=True), SC.field("v", T.ArrayType(T.FloatType()), dim=2),
                     SC.field("s", T.StringType(), max_length=3)])


def test_strict_and_dynamic_modes(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], "abc", 7), (2, [1.0], "abcd", 8), (None, [1.0, 1.0], "a", 9)],
                               "id long, v array<float>, s string, extra int")
    strict = {r.id: (r.valid, r.reason) for r in SC.validate(df, DECL).collect()}
    assert all(not ok and why.startswith("undeclared field") for ok, why in strict.values())
    dyn = sorted(((r.id, r.valid, r.reason) for r in SC.validate(df, DECL, dynamic=True).collect()),
                 key=lambda x: (x[0] is None, x[0]))
    assert dyn == [(1, True, None), (2, False, "wrong dim v"), (None, False, "null key id")]
    packed = SC.pack_dynamic(df.where("id = 1"), DECL)
    assert packed.select(SC.dynamic_value("meta", "extra", "int").alias("x")).first().x == 7


def test_uncommitted_version_is_invisible(spark):
    t = VersionedTable(spark, scratch_path(spark, "versions"))
    t.publish(spark.range(3))
    # a writer that died after writing data but before its commit marker
    spark.range(100).write.parquet(f"{t.root}/v-000002")
    assert t.current() == "v-000001" and t.read().count() == 3
    assert t.publish(spark.range(5)) == "v-000003" and t.read().count() == 5


def test_ivf_full_probe_is_exact(spark):
    emb = load(spark, SF, "embeddings")
    idx = A.ivf_build(spark, emb, "vec_id", "embedding", 4, seed=7)
    q = emb.where("label = 1").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qv"))
    full = sorted(tuple(r) for r in A.ivf_search(spark, idx, q, k=5, nprobe=4).collect())
    exact = sorted(tuple(r) for r in top_k(emb, q, k=5, id_col="vec_id", vec_col="embedding").collect())
    assert [(a[0], a[1], a[3]) for a in full] == [(b[0], b[1], b[3]) for b in exact]


def test_stream_replay_deduplicated_within_watermark(spark):
    e = load(spark, SF, "events").select("event_id", "ts")
    parts = [e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1")]
    parts.append(parts[0])  # the same rows arrive again
    table = J.stream_into_table(spark, parts, "dedupe-test", dedupe=(["event_id"], "ts", "40 days"))
    assert table.count() == e.count()
    assert table.select("event_id").distinct().count() == e.count()


def test_import_checks_every_file(spark):
    from pyspark.sql import types as T

    from vexa.session import scratch_path
    from vexa.sources import io as IO

    declared = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    paths = []
    for kind in ("long", "string"):
        path = scratch_path(spark, f"mixed-{kind}")
        spark.range(5).selectExpr("id AS a", f"CAST(id AS {kind}) AS b").coalesce(1).write.parquet(path)
        paths += IO.list_files(spark, path)
    for files, ok in ((paths, False), (paths[::-1], False), (paths[:1], True)):
        target = scratch_path(spark, "mixed-target")
        assert IO.bulk_import(spark, files, target, declared) is ok
        if ok:
            assert spark.read.parquet(target).count() == 5
