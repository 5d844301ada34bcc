import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vexa.session import scratch_path
from vexa.sources import footers as FT
from vexa.sources import io as IO
from vexa.sources import schema as SC
from vexa.sources.manifest import ManifestTable
from vexa.sources.versioned import SchemaViolation, VersionedTable

DECL = T.StructType([T.StructField("a", T.LongType()), T.StructField("v", T.ArrayType(T.FloatType())), T.StructField("s", T.StringType())])


def written(spark, df, n, name="src"):
    path = scratch_path(spark, name)
    df.repartitionByRange(n, "a").write.parquet(path)
    return path


def rows(spark, n):
    return spark.range(n).select(F.col("id").alias("a"), F.array(F.col("id").cast("float")).alias("v"), F.col("id").cast("string").alias("s"))


def files_below(spark, path):
    return {(r.path, r.file_bytes) for r in FT.data_files(spark, path, "").collect()}


def test_import_writes_no_data_byte(spark):
    # 200 files of uneven size
    uneven = rows(spark, 20_000).withColumn("p", F.floor(F.sqrt(F.col("a") * 2)).cast("int"))
    path = scratch_path(spark, "uneven")
    uneven.repartition(200, "p").sortWithinPartitions("p").drop("p").write.option("maxRecordsPerFile", 150).parquet(path)
    files = FT.data_files(spark, path)
    assert files.count() >= 150 and files.select(F.count_distinct("file_bytes")).first()[0] > 20
    before = files_below(spark, path)
    root = scratch_path(spark, "manifest")
    table = ManifestTable(spark, root, DECL)
    r = table.import_files(files)
    assert r.accepted and r.added_files == len(before) and r.added_rows == 20_000
    assert files_below(spark, path) == before
    manifest = [f for f, _ in files_below(spark, root) if f.endswith(".parquet")]
    assert len(manifest) == 1  # the manifest itself, whatever the data
    back = table.read()
    assert back.count() == table.count() == 20_000 and back.schema == DECL
    assert {f.split("/")[-1] for f in back.inputFiles()} == {p.split("/")[-1] for p, _ in before}
    assert back.agg(F.sum("a")).first()[0] == sum(range(20_000))


def test_second_import_adds_nothing_and_new_files_make_a_version(spark):
    a, b = written(spark, rows(spark, 100), 3), written(spark, rows(spark, 50), 2)
    table = ManifestTable(spark, scratch_path(spark, "manifest"), DECL)
    first = table.import_files(FT.data_files(spark, a))
    again = table.import_files(FT.data_files(spark, a).unionByName(FT.data_files(spark, a)))
    assert (again.accepted, again.added_files, again.version) == (True, 0, first.version)
    both = table.import_files(FT.data_files(spark, a).unionByName(FT.data_files(spark, b)))
    assert both.added_rows == 50 and both.version != first.version
    assert table.read(first.version).count() == 100 and table.read().count() == 150


@pytest.mark.parametrize("bad, why", [
    (lambda df: df.withColumn("a", F.col("a").cast("int")), "field a is int, declared bigint"),
    (lambda df: df.drop("s"), "missing field s"),
    (lambda df: df.withColumn("x", F.lit(1)), "undeclared field x"),
    (lambda df: df.withColumn("v", F.col("v").cast("array<double>")), "field v is array<double>, declared array<float>"),
])
def test_mixed_set_is_rejected_with_nothing_published(spark, bad, why):
    good, other = written(spark, rows(spark, 40), 2), written(spark, bad(rows(spark, 10)), 1)
    table = ManifestTable(spark, scratch_path(spark, "manifest"), DECL)
    r = table.import_files(FT.data_files(spark, good).unionByName(FT.data_files(spark, other)))
    assert not r.accepted and r.version is None and table.count() == 0 and table.read().count() == 0
    assert {x.reason for x in r.reasons.collect()} == {why}
    assert table.import_files(FT.data_files(spark, good)).accepted


def test_no_parquet_file_and_replaced_file(spark):
    path = written(spark, rows(spark, 30), 1)
    text = scratch_path(spark, "text")
    rows(spark, 3).select("s").write.text(text)
    table = ManifestTable(spark, scratch_path(spark, "manifest"), DECL)
    assert table.import_files(FT.data_files(spark, path)).accepted
    assert not table.import_files(FT.data_files(spark, text, ".txt")).accepted
    rows(spark, 5).coalesce(1).write.mode("overwrite").parquet(path)
    held = FT.data_files(spark, path).first()
    old = table.entries().first().path
    local = old.replace("file://", "").replace("file:", "")
    import shutil
    shutil.copy(held.path.replace("file://", "").replace("file:", ""), local)
    r = table.import_files(FT.listed(spark, [old]))
    assert not r.accepted and r.reasons.first().reason == "replaced since its import"


def test_a_path_that_only_spark_can_open(spark):
    path = written(spark, rows(spark, 30), 2)
    local = path if path.startswith("file:") else f"file://{path}"
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.vexa.link./in", local)
    files = FT.data_files(spark, "viewfs://vexa/in")
    assert all(f.path.startswith("viewfs://vexa/in/") for f in files.collect())
    assert sorted(f.num_rows for f in FT.footers(files).collect()) == sorted(f.num_rows for f in FT.footers(FT.data_files(spark, path)).collect())
    table = ManifestTable(spark, scratch_path(spark, "manifest"), DECL)
    assert table.import_files(files).added_rows == 30 and table.read().count() == 30


def test_row_groups_equal_another_reader(spark):
    path = scratch_path(spark, "groups")
    # small row groups, nulls, an empty column and a nested one
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 != 0, (F.col("id") / 7 - 100)).alias("d"), F.lit(None).cast("int").alias("none"),
                                  F.array("id").alias("list"), F.concat(F.lit("k"), F.col("id")).alias("s"))
    df.coalesce(1).write.option("parquet.block.size", 20_000).option("parquet.page.size", 2000).option(
        "parquet.block.row.count.limit", 700).parquet(path)
    got = FT.row_groups(FT.footers(FT.data_files(spark, path))).filter("column_name <> 'list'").collect()
    local = got[0].path.replace("file://", "").replace("file:", "")
    want = duckdb.sql(f"select row_group_id, path_in_schema, row_group_num_rows, stats_null_count, stats_min_value, stats_max_value, "
                      f"total_compressed_size from parquet_metadata('{local}') where path_in_schema not like 'list%'").fetchall()
    assert len({w[0] for w in want}) > 3

    def number(x):
        return x if x is None or not x.replace(".", "").replace("-", "").isdigit() else float(x)
    assert sorted((g.row_group, g.column_name, g.num_rows, g.num_nulls, number(g.min_value), number(g.max_value), g.compressed_bytes) for g in got) == \
        sorted((w[0], w[1], w[2], w[3], number(w[4]), number(w[5]), w[6]) for w in want)
    prof = {r.column_name: r for r in FT.column_profile(FT.footers(FT.data_files(spark, path)), df.schema).collect()}
    assert (prof["id"].min_value, prof["id"].max_value, prof["id"].num_rows) == ("0", "4999", 5000)
    assert prof["none"].num_nulls == 5000 and prof["none"].min_value is None and prof["list"].min_value is None
    assert prof["d"].num_nulls == 1667 and float(prof["d"].min_value) == df.agg(F.min("d")).first()[0]


def test_bulk_import_copies_each_file_once(spark):
    a, b = written(spark, rows(spark, 100), 3), written(spark, rows(spark, 50), 2)
    target = scratch_path(spark, "bulk")
    fa, fb = IO.list_files(spark, a), IO.list_files(spark, b)
    for files, n in ((fa, 100), (fa, 100), (fa[:1] + fb, 150), (fb, 150)):
        assert IO.bulk_import(spark, files, target, DECL)
        assert IO.read_imported(spark, target).count() == n
    lacking = written(spark, rows(spark, 5).drop("s"), 1)
    assert not IO.bulk_import(spark, IO.list_files(spark, lacking), target, DECL)
    assert IO.read_imported(spark, target).count() == 150


def test_every_published_version_keeps_the_declared_schema(spark):
    declared = T.StructType([SC.field("a", T.LongType(), pk=True), SC.field("v", T.ArrayType(T.FloatType()), dim=1),
                             SC.field("s", T.StringType(), max_length=3)])
    t = VersionedTable(spark, scratch_path(spark, "strict"), declared)
    good = rows(spark, 50)
    v = t.publish(good)
    for bad, why in ((good.withColumn("x", F.lit(1)), "undeclared field x"), (good.drop("s"), "missing field s"),
                     (good.withColumn("s", F.when(F.col("a") == 7, "long").otherwise(F.col("s"))), "1 rows: too long s"),
                     (good.withColumn("a", F.col("a").cast("int")), "field a is int"),
                     (good.withColumn("v", F.when(F.col("a") != 3, F.col("v"))), "1 rows: null vector v")):
        with pytest.raises(SchemaViolation, match=why):
            t.publish(bad)
        assert t.current() == v and t.read().count() == 50
    assert t.publish(good.limit(5)) != v and t.read().count() == 5
