"""Registered projection and predicate queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vexa.functions import predicates as P
from vexa.functions.text import text_match
from vexa.plans import sql_snippets as S
from vexa.plans.registry import load, register


@register("project_fields", "SELECT p_partkey, p_name, p_retailprice FROM part")
def project_fields(spark, sf):
    return load(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")


@register("filter_compare", """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
WHERE l_quantity >= 10 AND l_quantity != 25 AND l_discount < 0.05e0 AND l_tax <= 0.04e0""")
def filter_compare(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.where((F.col("l_quantity") >= 10) & (F.col("l_quantity") != 25)
                    & (F.col("l_discount") < 0.05) & (F.col("l_tax") <= 0.04)).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@register("filter_logic", """
SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity FROM lineitem
WHERE (l_returnflag = 'R' OR l_quantity > 45) AND NOT (l_discount > 0.08e0)""")
def filter_logic(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.where(((F.col("l_returnflag") == "R") | (F.col("l_quantity") > 45))
                    & ~(F.col("l_discount") > 0.08)).select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")


@register("filter_in", """
SELECT p_partkey, p_size, p_type FROM part
WHERE p_size IN (1, 5, 10, 20) AND NOT (p_type IN ('PROMO', 'SMALL'))""")
def filter_in(spark, sf):
    p = load(spark, sf, "part")
    return p.where(F.col("p_size").isin(1, 5, 10, 20) & ~F.col("p_type").isin("PROMO", "SMALL")).select(
        "p_partkey", "p_size", "p_type")


@register("filter_range_chain", """
SELECT event_id, ts, value FROM events
WHERE 10 <= value AND value <= 50 AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-10'""")
def filter_range_chain(spark, sf):
    e = load(spark, sf, "events")
    return e.where(F.col("value").between(10, 50)
                   & P.half_open("ts", F.lit("2024-01-05").cast("timestamp"), F.lit("2024-01-10").cast("timestamp"))
                   ).select("event_id", "ts", "value")


@register("filter_like_prefix", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red%'")
def filter_like_prefix(spark, sf):
    return load(spark, sf, "part").where(F.col("p_name").like("red%")).select("p_partkey", "p_name")


@register("filter_bool_string", """
SELECT o_orderkey, o_orderstatus, o_totalprice > 100000 AS big FROM orders
WHERE o_orderstatus = 'F' AND (o_totalprice > 100000) = true""")
def filter_bool_string(spark, sf):
    o = load(spark, sf, "orders").withColumn("big", F.col("o_totalprice") > 100000)
    return o.where((F.col("o_orderstatus") == "F") & (F.col("big") == F.lit(True))).select(
        "o_orderkey", "o_orderstatus", "big")


@register("filter_json_path", """
SELECT event_id, json_extract(props, '$.k')::INTEGER AS k FROM events
WHERE json_extract(props, '$.k')::INTEGER > 50""")
def filter_json_path(spark, sf):
    e = load(spark, sf, "events").withColumn("k", P.json_path("props", "$.k", "int"))
    return e.where(F.col("k") > 50).select("event_id", "k")


@register("filter_json_nested", """
SELECT event_id, event_type AS title, json_extract(props, '$.k')::DOUBLE / 10 AS rating, user_id AS first_tag FROM events
WHERE event_type = 'click' AND json_extract(props, '$.k')::DOUBLE / 10 > 5""")
def filter_json_nested(spark, sf):
    """Paths of several levels and into lists, on documents {title, stats: {rating}, tags: [...]}."""
    e = load(spark, sf, "events")
    rating = P.json_path("props", "$.k", "double") / 10
    doc = F.to_json(F.struct(F.col("event_type").alias("title"), F.struct(rating.alias("rating")).alias("stats"), F.array("user_id").alias("tags")))
    docs = e.select("event_id", doc.alias("metadata"))
    title, stars = P.json_path("metadata", "$.title", "string"), P.json_path("metadata", "$.stats.rating", "double")
    return docs.where((title == "click") & (stars > 5)).select(
        "event_id", title.alias("title"), stars.alias("rating"), P.json_path("metadata", "$.tags[0]", "bigint").alias("first_tag"))


# Fixed lookup keys, including one that does not exist.
LOOKUP_KEYS = (0, 50, 99, -1)


@register("pk_lookup", """
SELECT k.key, o.o_orderkey IS NOT NULL AS found, o.o_custkey, o.o_totalprice, o.o_orderstatus
FROM (VALUES (0), (50), (99), (-1)) k(key) LEFT JOIN orders o ON o.o_orderkey = k.key""")
def pk_lookup(spark, sf):
    o = load(spark, sf, "orders")
    keys = spark.createDataFrame([(k,) for k in LOOKUP_KEYS], T.StructType([T.StructField("key", T.LongType())]))
    # IN-list pushed to the Parquet scan, then a join with the small key list.
    hit = o.where(F.col("o_orderkey").isin(*LOOKUP_KEYS)).select(
        F.col("o_orderkey").alias("key"), "o_custkey", "o_totalprice", "o_orderstatus")
    return keys.join(hit, "key", "left").select(
        "key", F.col("o_custkey").isNotNull().alias("found"), "o_custkey", "o_totalprice", "o_orderstatus")


@register("epoch_time_filter", """
SELECT event_id, floor(epoch(ts))::BIGINT AS epoch_s FROM events
WHERE floor(epoch(ts))::BIGINT >= 1704240000 AND floor(epoch(ts))::BIGINT < 1704326400""")
def epoch_time_filter(spark, sf):
    e = load(spark, sf, "events").withColumn("epoch_s", P.epoch_seconds("ts"))
    # one day, 2024-01-03 00:00 to 2024-01-04 00:00 UTC, in epoch seconds
    # as time stamps of the column's own type, so that the scan gets the bounds
    kind = dict(e.dtypes)["ts"]
    low, high = (F.timestamp_seconds(F.lit(s)).cast(kind) for s in (1704240000, 1704326400))
    return e.where((F.col("ts") >= low) & (F.col("ts") < high)).select("event_id", "epoch_s")


TEXT_QUERY = "thon thor"


@register("filter_text_match", f"""
SELECT doc_id, lang FROM documents
WHERE len(list_intersect({S.tokens('text')}, ['thon', 'thor'])) > 0""")
def filter_text_match(spark, sf):
    d = load(spark, sf, "documents")
    return d.where(text_match("text", TEXT_QUERY)).select("doc_id", "lang")
