"""Registered source / sink / schema / partition queries (O01-O06, O08, O09,
O11-O19)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vexa.functions import predicates as P
from vexa.functions import vectors as V
from vexa.plans import search as SQ
from vexa.plans.registry import QUERIES, load, register
from vexa.session import scratch_path
from vexa.sources import footers as FT
from vexa.sources import io as IO
from vexa.sources import manifest as MF
from vexa.sources import schema as SC


@register("scan_parquet_dir", """
SELECT l_orderkey, l_partkey, l_quantity, l_shipdate FROM lineitem""")
def scan_parquet_dir(spark, sf):
    return IO.scan_parquet_dir(spark, sf, ["l_orderkey", "l_partkey", "l_quantity", "l_shipdate"],
                               glob="lineitem*.parquet")


CONFORMED = T.StructType([T.StructField("pk", T.StringType()), T.StructField("vector", T.ArrayType(T.FloatType())),
                          T.StructField("label", T.LongType())])


@register("rewrite_conform", """
SELECT vec_id::VARCHAR AS pk, embedding::FLOAT[] AS vector, label::BIGINT AS label FROM embeddings""")
def rewrite_conform(spark, sf):
    e = load(spark, sf, "embeddings").select(F.col("vec_id").alias("pk"), F.col("embedding").alias("vector"), "label")
    return IO.conform(e, CONFORMED)


@register("sink_parquet_sized", """
SELECT count(*) AS total_rows, true AS within_limit, true AS enough_files FROM lineitem""")
def sink_parquet_sized(spark, sf):
    path = scratch_path(spark, "sized")
    IO.write_sized(load(spark, sf, "lineitem"), path, 10_000)
    c = IO.per_file_counts(spark.read.parquet(path))
    return c.agg(F.sum("num_rows").cast("long").alias("total_rows"),
                 (F.max("num_rows") <= 10_000).alias("within_limit"),
                 (F.count(F.lit(1)) >= F.ceil(F.sum("num_rows") / 10_000)).alias("enough_files"))


LINEITEM_DECL = T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
                              T.StructField("l_returnflag", T.StringType()), T.StructField("l_quantity", T.DoubleType())])


@register("bulk_import_append", """
SELECT l_returnflag, count(*) AS num_rows FROM lineitem GROUP BY 1""")
def bulk_import_append(spark, sf):
    prepared = scratch_path(spark, "prepared")
    IO.write_sized(IO.conform(load(spark, sf, "lineitem"), LINEITEM_DECL), prepared, 10_000)
    target = scratch_path(spark, "imported")
    IO.bulk_import(spark, IO.list_files(spark, prepared), target, LINEITEM_DECL)
    IO.bulk_import(spark, IO.list_files(spark, prepared), target, LINEITEM_DECL)  # given again, the files add nothing
    return IO.read_imported(spark, target).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("num_rows"))


@register("import_without_rewrite", """
SELECT 'first' AS file_set, true AS accepted, count(*) AS imported_rows, count(*) AS visible_rows FROM lineitem
UNION ALL SELECT 'again', true, 0, count(*) FROM lineitem
UNION ALL SELECT 'mixed', false, 0, count(*) FROM lineitem""")
def import_without_rewrite(spark, sf):
    """The files of ``lineitem`` where they lie; given again; and together with files of another table."""
    path = f"{sf.rstrip('/')}/lineitem.parquet"
    table = MF.ManifestTable(spark, scratch_path(spark, "import-manifest"), load(spark, sf, "lineitem").schema)
    good = FT.data_files(spark, path)
    mixed = good.unionByName(FT.data_files(spark, f"{sf.rstrip('/')}/orders.parquet"))
    out = None
    for name, files in (("first", good), ("again", good), ("mixed", mixed)):
        r = table.import_files(files)
        row = table.read().agg(F.lit(name).alias("file_set"), F.lit(r.accepted).alias("accepted"),
                               F.lit(r.added_rows).cast("long").alias("imported_rows"), F.count(F.lit(1)).alias("visible_rows"))
        out = row if out is None else out.unionByName(row)
    return out


def _profile_sql():
    kinds = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
             "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string",
             "l_shipdate": "timestamp_ntz"}
    def value(agg, c, t):
        return f"({agg}({c}) + 0e0)::VARCHAR" if t == "double" else f"{agg}({c})::VARCHAR"  # no negative zero
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS num_rows, (count(*) - count({c}))::BIGINT AS num_nulls, "
        f"{value('min', c, t)} AS min_value, {value('max', c, t)} AS max_value FROM lineitem" for c, t in kinds.items())


@register("parquet_profile", _profile_sql())
def parquet_profile(spark, sf):
    """From the footers alone; the oracle reads the rows."""
    found = FT.footers(FT.data_files(spark, f"{sf.rstrip('/')}/lineitem.parquet"))
    return FT.column_profile(found, load(spark, sf, "lineitem").schema).select(
        "column_name", "data_type", "num_rows", "num_nulls", "min_value", "max_value")


@register("parquet_row_groups")
def parquet_row_groups(spark, sf):
    """Rows, bytes and extremes of every row group and column of ``documents``; compared with a footer reader in the tests."""
    return FT.row_groups(FT.footers(FT.data_files(spark, f"{sf.rstrip('/')}/documents.parquet")))


@register("sink_json_results", SQ.ORACLES_KNN_L2)
def sink_json_results(spark, sf):
    hits = QUERIES["knn_l2"](spark, sf)
    path = scratch_path(spark, "json-results")
    hits.write.json(path)
    return spark.read.schema(hits.schema).json(path)


@register("pk_text_files", "SELECT o_orderkey % 20 AS seg, o_orderkey AS pk FROM orders")
def pk_text_files(spark, sf):
    path = scratch_path(spark, "pk-text")
    o = load(spark, sf, "orders").withColumn("seg", F.col("o_orderkey") % 20)
    IO.write_key_text(o, path, "o_orderkey", "seg")
    return IO.read_key_text(spark, path).select(F.col("seg").cast("long").alias("seg"), "pk")


GEN_SEED, GEN_DIM = 7, 4


@register("generate_rows", f"""
SELECT o_orderkey AS pk,
  round(('0x' || substr(md5('{GEN_SEED}-' || o_orderkey), 1, 8))::BIGINT / 4294967296.0e0, 9) AS random,
  list_transform(range(1, {GEN_DIM} + 1), lambda i:
    round(('0x' || substr(md5('{GEN_SEED}-' || o_orderkey || '-' || i), 1, 8))::BIGINT / 4294967296.0e0, 9)) AS vector
FROM orders""")
def generate_rows(spark, sf):
    g = IO.generate_rows(load(spark, sf, "orders"), "o_orderkey", GEN_SEED, GEN_DIM)
    return g.select("pk", F.round("random", 9).alias("random"),
                    F.transform("vector", lambda x: F.round(x, 9)).alias("vector"))


GEN_FIELDS = [("seq", "sequence", 100, 2), ("skey", "string_key", 12), ("bucket", "long", 1000), ("score", "uniform", -1, 1),
              ("gauss", "normal", 10, 2), ("direction", "normal_vector", 4)]


def _gen_sql():
    def uni(*parts):
        return f"(('0x' || substr(md5('{GEN_SEED}-' || " + " || '-' || ".join(parts) + "), 1, 8))::BIGINT / 4294967296.0e0)"

    def gauss(*parts):
        u, v = uni(*parts, "'u'"), uni(*parts, "'v'")
        return f"(sqrt(-2.0e0 * ln(1.0e0 - {u})) * cos(2 * pi() * {v}))"

    k = "o_orderkey"
    return f"""
SELECT {k}, 100 + 2 * {k} AS seq, substr(md5('{GEN_SEED}-skey-' || {k}), 1, 12) AS skey,
  ('0x' || substr(md5('{GEN_SEED}-bucket-' || {k}), 1, 15))::BIGINT % 1000 AS bucket,
  round(-1.0e0 + 2.0e0 * {uni("'score'", k)}, 6) AS score, round(10.0e0 + 2.0e0 * {gauss("'gauss'", k)}, 6) AS gauss,
  list_transform(range(1, 5), lambda i: round({gauss("'direction'", k, "i")}, 6)) AS direction FROM orders"""


@register("generate_typed_rows", _gen_sql())
def generate_typed_rows(spark, sf):
    g = IO.generate_table(load(spark, sf, "orders"), "o_orderkey", GEN_FIELDS, GEN_SEED)
    return g.select("o_orderkey", "seq", "skey", "bucket", F.round("score", 6).alias("score"), F.round("gauss", 6).alias("gauss"),
                    F.transform("direction", lambda x: F.round(x, 6)).alias("direction"))


# target schema of the size estimate: INT64 pk, DOUBLE random, FLOAT_VECTOR(64)
EST_WIDTH = IO.row_width([("INT64", 0), ("DOUBLE", 0), ("FLOAT_VECTOR", 64)])


@register("estimate_rows_by_size", f"""
WITH s AS (SELECT l_orderkey % 8 AS seg, count(*) AS size_kb FROM lineitem GROUP BY 1),
e AS (SELECT seg, size_kb, floor(size_kb * 1024 / {EST_WIDTH})::BIGINT AS est_rows FROM s),
b AS (SELECT *, unnest(range(0, greatest(ceil(est_rows / {5 * 1024 * 1024 // EST_WIDTH}) - 1, 0)::BIGINT + 1)) AS batch_no FROM e)
SELECT seg, size_kb, est_rows, batch_no, least({5 * 1024 * 1024 // EST_WIDTH}, est_rows - batch_no * {5 * 1024 * 1024 // EST_WIDTH}) AS batch_rows FROM b""")
def estimate_rows_by_size(spark, sf):
    spec = load(spark, sf, "lineitem").groupBy((F.col("l_orderkey") % 8).alias("seg")).agg(
        F.count(F.lit(1)).alias("size_kb"))
    return IO.estimate_batches(spec, "size_kb", "KB", EST_WIDTH)


# --- schema ---------------------------------------------------------------
EMB_DECL = T.StructType([SC.field("vec_id", T.LongType(), pk=True),
                         SC.field("embedding", T.ArrayType(T.FloatType()), dim=64),
                         SC.field("label", T.IntegerType())])


@register("validate_schema_strict", """
SELECT vec_id, NOT coalesce(label = 3, false) AS valid,
       CASE WHEN label = 3 THEN 'wrong dim embedding' END AS reason FROM embeddings""")
def validate_schema_strict(spark, sf):
    e = load(spark, sf, "embeddings")
    # the vectors of label 3 arrive one component short
    bad = e.withColumn("embedding", F.when(F.col("label") == 3, F.slice("embedding", 1, 63))
                       .otherwise(F.col("embedding")))
    return SC.validate(bad, EMB_DECL).select("vec_id", "valid", "reason")


EVENT_DECL = T.StructType([SC.field("event_id", T.LongType(), pk=True), SC.field("ts", T.TimestampNTZType()),
                           SC.field("event_type", T.StringType(), max_length=16)])


@register("dynamic_fields", """
SELECT event_id, user_id, json_extract(props, '$.k')::INTEGER AS k FROM events
WHERE json_extract(props, '$.k')::INTEGER > 90""")
def dynamic_fields(spark, sf):
    e = load(spark, sf, "events").withColumn("k", P.json_path("props", "$.k", "int")).drop("props")
    checked = SC.validate(e, EVENT_DECL, dynamic=True).where("valid").drop("valid", "reason")
    packed = SC.pack_dynamic(checked, EVENT_DECL)
    out = packed.select("event_id", SC.dynamic_value("meta", "user_id", "bigint").alias("user_id"),
                        SC.dynamic_value("meta", "k", "int").alias("k"))
    return out.where(F.col("k") > 90)


@register("create_or_replace_table", "SELECT o_orderstatus, count(*) AS num_rows FROM orders GROUP BY 1")
def create_or_replace_table(spark, sf):
    name = f"vexa_orders_{uuid.uuid4().hex[:8]}"
    path = scratch_path(spark, name)
    o = load(spark, sf, "orders")
    for _ in range(2):  # second round exercises the replace path
        if spark.catalog.tableExists(name):
            spark.sql(f"DROP TABLE {name}")
        o.write.option("path", path).mode("overwrite").saveAsTable(name)
    return spark.table(name).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("num_rows"))


# --- partitions -------------------------------------------------------------
def _customer_table(spark, sf):
    name = f"vexa_cust_{uuid.uuid4().hex[:8]}"
    c = load(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    (c.hint("rebalance", "c_mktsegment").write.partitionBy("c_mktsegment")
     .saveAsTable(name))
    return name  # a managed table: dropping a partition removes its files


@register("partition_insert", """
SELECT c_mktsegment, count(*) AS num_rows FROM customer GROUP BY 1
UNION ALL SELECT 'SUPPLIER', count(*) FROM supplier""")
def partition_insert(spark, sf):
    name = _customer_table(spark, sf)
    s = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"),
                                          F.lit("SUPPLIER").alias("c_mktsegment"))
    s.write.insertInto(name)
    return spark.table(name).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("num_rows"))


@register("partition_drop", """
SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'""")
def partition_drop(spark, sf):
    name = _customer_table(spark, sf)
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (c_mktsegment = 'BUILDING')")
    return spark.table(name).select("c_custkey", "c_mktsegment")


@register("partition_list", """
SELECT c_mktsegment, count(*) AS num_rows FROM customer WHERE c_mktsegment <> 'BUILDING' GROUP BY 1""")
def partition_list(spark, sf):
    name = _customer_table(spark, sf)
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (c_mktsegment = 'BUILDING')")
    shown = spark.sql(f"SHOW PARTITIONS {name}").select(
        F.regexp_extract("partition", r"^c_mktsegment=(.*)$", 1).alias("c_mktsegment"))
    counts = spark.table(name).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("num_rows"))
    return shown.join(counts, "c_mktsegment", "left").select(
        "c_mktsegment", F.coalesce("num_rows", F.lit(0)).alias("num_rows"))


# --- several vector fields in one row ----------------------------------------
@register("multi_vector_row", """
SELECT vec_id, len(embedding) AS dim_full, len(embedding[1:32]) AS dim_half,
  round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS norm_full,
  round(sqrt(list_sum(list_transform(embedding[1:32], lambda x: x::DOUBLE * x::DOUBLE))), 6) AS norm_half
FROM embeddings""")
def multi_vector_row(spark, sf):
    e = load(spark, sf, "embeddings").select("vec_id", "embedding", F.slice("embedding", 1, 32).alias("half"))
    return e.select("vec_id", F.size("embedding").alias("dim_full"), F.size("half").alias("dim_half"),
                    F.round(V.norm("embedding"), 6).alias("norm_full"), F.round(V.norm("half"), 6).alias("norm_half"))
