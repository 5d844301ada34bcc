"""Registered aggregation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vexa.functions.text import tokenize
from vexa.operators.aggregates import exact_percentile, list_length_stats, throughput
from vexa.plans import sql_snippets as S
from vexa.plans.registry import load, register
from vexa.session import scratch_path


def _r(c, n=6):
    return F.round(F.col(c), n).alias(c)


@register("list_length_stats", f"""
SELECT 'embedding' AS column_name, round(avg(len(embedding)), 6) AS mean_len, max(len(embedding))::DOUBLE AS max_len,
       min(len(embedding))::DOUBLE AS min_len, round(stddev_pop(len(embedding)), 6) AS std_len
FROM embeddings WHERE embedding IS NOT NULL
UNION ALL
SELECT 'tokens', round(avg(len(t)), 6), max(len(t))::DOUBLE, min(len(t))::DOUBLE, round(stddev_pop(len(t)), 6)
FROM (SELECT {S.tokens('text')} AS t FROM documents)""")
def list_length_stats_q(spark, sf):
    e = list_length_stats(load(spark, sf, "embeddings"), "embedding")
    d = list_length_stats(load(spark, sf, "documents").select(tokenize("text").alias("tokens")), "tokens")
    return e.unionByName(d).select("column_name", _r("mean_len"), "max_len", "min_len", _r("std_len"))


@register("count_star", """
SELECT count(*) AS n FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 20""")
def count_star(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.where((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 20)).agg(F.count(F.lit(1)).alias("n"))


@register("row_count_check", """
SELECT count(*) AS expected, count(*) AS actual, true AS matches FROM lineitem""")
def row_count_check(spark, sf):
    src = load(spark, sf, "lineitem")
    path = scratch_path(spark, "row-count")
    src.write.parquet(path)
    both = src.select(F.lit(1).alias("e"), F.lit(0).alias("a")).unionByName(
        spark.read.parquet(path).select(F.lit(0).alias("e"), F.lit(1).alias("a")))
    return both.agg(F.sum("e").cast("long").alias("expected"), F.sum("a").cast("long").alias("actual")).withColumn(
        "matches", F.col("expected") == F.col("actual"))


@register("latency_summary", """
SELECT event_type, count(*) AS n, round(avg(value), 4) AS avg_value,
       round(quantile_cont(value, 0.99), 4) AS p99_value FROM events GROUP BY event_type""")
def latency_summary(spark, sf):
    e = load(spark, sf, "events")
    base = e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 4).alias("avg_value"))
    p99 = exact_percentile(e, ["event_type"], "value", 0.99, "p99_value")
    return base.join(p99, "event_type").select("event_type", "n", "avg_value", F.round("p99_value", 4).alias("p99_value"))


@register("throughput_summary", """
SELECT event_type, round(max(c / 3600.0e0), 6) AS max_qps, count(*) AS windows FROM (
  SELECT event_type, date_trunc('hour', ts) AS h, count(*) AS c FROM events GROUP BY 1, 2) GROUP BY 1""")
def throughput_summary(spark, sf):
    t = throughput(load(spark, sf, "events"), "event_type", "ts")
    return t.select("event_type", _r("max_qps"), "windows")
