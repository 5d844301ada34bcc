"""Registered write / update / delete queries (O37-O48) on orders, lineitem,
documents, embeddings and events.  Every query returns the resulting table
(or its per-batch summary) over the whole input."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vexa.operators import dml as D
from vexa.operators.common import broadcast_if_small
from vexa.operators.ordering import batch_number
from vexa.plans.registry import load, register
from vexa.session import scratch_path
from vexa.sources import schema as SC
from vexa.sources.versioned import SchemaViolation, VersionedTable


def _orders(spark, sf):
    return load(spark, sf, "orders")


# --- O37 appends of several batches ------------------------------------------
@register("insert_batch", """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders""")
def insert_batch(spark, sf):
    o = _orders(spark, sf).select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = scratch_path(spark, "insert-batch")
    p = F.coalesce(F.col("o_totalprice"), F.lit(0.0))
    for batch in (o.where(p < 50000), o.where((p >= 50000) & (p < 150000)), o.where(p >= 150000)):
        batch.write.mode("append").parquet(path)
    return spark.read.parquet(path)


# --- O38 disjoint key ranges written by one parallel job ----------------------
@register("insert_parallel_batches", """
SELECT (l_orderkey * 8 + l_linenumber) // 5000 AS batch, count(*) AS num_rows,
       min(l_orderkey * 8 + l_linenumber) AS min_pk, max(l_orderkey * 8 + l_linenumber) AS max_pk
FROM lineitem GROUP BY 1""")
def insert_parallel_batches(spark, sf):
    li = load(spark, sf, "lineitem")
    rows = li.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("pk"), "l_quantity")
    rows = rows.withColumn("batch", F.floor(F.col("pk") / 5000).cast("long"))
    path = scratch_path(spark, "parallel-insert")
    # one job; a task writes the batches of its key range, so files grow with the table, folders do not
    rows.repartitionByRange("pk").sortWithinPartitions("pk").write.parquet(path)
    back = spark.read.parquet(path)
    return back.groupBy("batch").agg(
        F.count(F.lit(1)).alias("num_rows"), F.min("pk").alias("min_pk"), F.max("pk").alias("max_pk"))


# --- O39 consecutive ids over files in path order ----------------------------
@register("insert_assign_ids", """
SELECT row_number() OVER (ORDER BY o_orderkey) AS pk, o_orderkey,
       (row_number() OVER (ORDER BY o_orderkey) - 1) // 500 AS batch FROM orders""")
def insert_assign_ids(spark, sf):
    path = scratch_path(spark, "assign-ids")
    o = _orders(spark, sf).select("o_orderkey")
    o.repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey").write.parquet(path)
    files = spark.read.parquet(path).select("o_orderkey", F.col("_metadata.file_path").alias("f"),
                                            F.col("_metadata.row_index").alias("ri"))
    counts = files.groupBy("f").agg(F.count(F.lit(1)).alias("c")).orderBy("f").collect()  # one row per file
    upto = [0, *itertools.accumulate(r.c for r in counts)]
    offs = spark.createDataFrame([(r.f, o) for r, o in zip(counts, upto)], "f string, off long")
    ids = files.join(broadcast_if_small(offs), "f").select((F.col("off") + F.col("ri") + 1).alias("pk"), "o_orderkey")
    return ids.withColumn("batch", batch_number(F.col("pk"), 500))


# --- O40 all-or-nothing batches ----------------------------------------------
@register("insert_atomic", """
SELECT 'clean' AS batch, true AS accepted, count(*) AS visible_rows FROM embeddings
UNION ALL SELECT 'corrupt', false, count(*) FROM embeddings""")
def insert_atomic(spark, sf):
    emb = load(spark, sf, "embeddings")
    dim = 64
    declared = T.StructType([SC.field("vec_id", T.LongType(), pk=True), SC.field("embedding", T.ArrayType(T.FloatType()), dim=dim),
                             SC.field("label", T.IntegerType())])
    table = VersionedTable(spark, scratch_path(spark, "atomic"), declared)
    # corrupt batch: the vectors of label 3 lose their last component
    corrupt = emb.withColumn("embedding", F.when(F.col("label") == 3, F.slice("embedding", 1, dim - 1))
                             .otherwise(F.col("embedding")))
    out = []
    for name, batch in (("clean", emb), ("corrupt", corrupt)):
        try:
            table.publish(batch)
            ok = True
        except SchemaViolation:
            ok = False
        visible = table.read().count()
        out.append((name, ok, visible))
    return spark.createDataFrame(out, "batch string, accepted boolean, visible_rows long")


# --- O41 latest-wins upsert -------------------------------------------------
UPSERT_SQL = """
WITH ch AS (
  SELECT o_orderkey, o_totalprice + 50 AS o_totalprice, o_orderstatus, 1 AS seq FROM orders WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT o_orderkey, o_totalprice + 100, o_orderstatus, 2 FROM orders WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT o_orderkey + 1000000, o_totalprice, o_orderstatus, 1 FROM orders WHERE o_orderpriority = '2-HIGH'),
latest AS (SELECT o_orderkey, o_totalprice, o_orderstatus FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) AS rk FROM ch) WHERE rk = 1)
SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice, o_orderstatus FROM (
  SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM latest)
  UNION ALL SELECT * FROM latest)"""


def upsert_changes(o):
    """Two versions of every urgent order (price + 50, then + 100; the later
    wins) and the high-priority orders again under new keys (inserts)."""
    k = F.col("o_orderkey")
    urgent, high = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority") == "2-HIGH"
    a = o.where(urgent).select("o_orderkey", (F.col("o_totalprice") + 50).alias("o_totalprice"),
                                    "o_orderstatus", F.lit(1).alias("seq"))
    b = o.where(urgent).select("o_orderkey", (F.col("o_totalprice") + 100).alias("o_totalprice"),
                                    "o_orderstatus", F.lit(2).alias("seq"))
    c = o.where(high).select((k + 1000000).alias("o_orderkey"), "o_totalprice", "o_orderstatus",
                                    F.lit(1).alias("seq"))
    return a.unionByName(b).unionByName(c)


@register("upsert", UPSERT_SQL)
def upsert_q(spark, sf):
    o = _orders(spark, sf).select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    out = D.upsert(o.drop("o_orderpriority"), upsert_changes(o), ["o_orderkey"], "seq")
    return out.select("o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice"), "o_orderstatus")


# --- O42 delete by predicate -------------------------------------------------
@register("delete_expr", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT coalesce(o_orderstatus = 'F' AND o_totalprice > 100000, false)""")
def delete_expr(spark, sf):
    o = _orders(spark, sf)
    return D.delete_where(o, (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000)).select(
        "o_orderkey", "o_orderstatus")


# --- O43 delete listed keys (key list from another table) ----------------------
@register("delete_pks", """
SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def delete_pks(spark, sf):
    return D.delete_keys(load(spark, sf, "documents"), load(spark, sf, "labels"), ["doc_id"]).select("doc_id", "lang")


# --- O44 delete a repeatable 20 % of every segment ---------------------------
@register("delete_sample_percent", """
WITH r AS (SELECT o_orderkey,
  row_number() OVER (PARTITION BY o_orderkey % 20 ORDER BY md5(o_orderkey::VARCHAR), o_orderkey) AS rn,
  count(*) OVER (PARTITION BY o_orderkey % 20) AS cnt FROM orders)
SELECT o_orderkey FROM r WHERE rn > floor(cnt * 20.0e0 / 100.0e0)""")
def delete_sample_percent(spark, sf):
    o = _orders(spark, sf).select("o_orderkey", (F.col("o_orderkey") % 20).alias("seg"))
    doomed = D.sample_keys_per_segment(o, "seg", "o_orderkey", 20.0)
    return D.delete_keys(o, doomed, ["o_orderkey"]).select("o_orderkey")


# --- O45 delete in batches, rows left after each ------------------------------
@register("delete_batched", """
WITH d AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders WHERE o_orderstatus = 'O')
SELECT (rn - 1) // 50 AS batch_no, count(*) AS deleted, (SELECT count(*) FROM orders) - max(rn) AS remaining
FROM d GROUP BY 1""")
def delete_batched(spark, sf):
    o = _orders(spark, sf)
    total = o.count()
    return D.delete_in_batches(o.where(F.col("o_orderstatus") == "O"), "o_orderkey", total, 50)


# --- O46 repeating a delete changes nothing more -------------------------------
@register("delete_idempotent", """
SELECT count(*) AS after_first, count(*) AS after_second, true AS unchanged FROM orders
WHERE NOT coalesce(o_orderstatus = 'P', false)""")
def delete_idempotent(spark, sf):
    pred = F.col("o_orderstatus") == "P"
    once = D.delete_where(_orders(spark, sf), pred)
    twice = D.delete_where(once, pred)
    both = once.select(F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        twice.select(F.lit(0).alias("a"), F.lit(1).alias("b")))
    r = both.agg(F.sum("a").cast("long").alias("after_first"), F.sum("b").cast("long").alias("after_second"))
    return r.withColumn("unchanged", F.col("after_first") == F.col("after_second"))


# --- O47 time to live --------------------------------------------------------
TTL_DAYS = 7


@register("ttl_expire", f"""
SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL {TTL_DAYS} DAY""")
def ttl_expire(spark, sf):
    e = load(spark, sf, "events")
    as_of = e.agg(F.max("ts")).first()[0]
    return D.ttl_filter(e, "ts", TTL_DAYS * 86400, as_of).select("event_id", "ts")


# --- O48 read at a consistency level ------------------------------------------
LAG_DAYS = 3


@register("snapshot_read", f"""
WITH log AS (
  SELECT o_orderkey AS k, o_totalprice AS price, o_orderdate AS commit_ts, -1 AS seq FROM orders
  UNION ALL SELECT user_id, value, ts, event_id FROM events),
lim AS (SELECT max(commit_ts) AS latest FROM log),
lv AS (SELECT 'strong' AS level, latest AS cut FROM lim
       UNION ALL SELECT 'bounded', latest - INTERVAL {LAG_DAYS} DAY FROM lim),
r AS (SELECT lv.level, log.*, row_number() OVER (PARTITION BY lv.level, k ORDER BY commit_ts DESC, seq DESC) AS rn
      FROM log, lv WHERE log.commit_ts <= lv.cut)
SELECT level, k AS o_orderkey, round(price, 2) AS price FROM r WHERE rn = 1""")
def snapshot_read(spark, sf):
    o = _orders(spark, sf).select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"),
                                 F.col("o_orderdate").alias("commit_ts"), F.lit(-1).cast("long").alias("seq"))
    ev = load(spark, sf, "events").select(F.col("user_id").alias("k"), F.col("value").alias("price"),
                                           F.col("ts").alias("commit_ts"), F.col("event_id").alias("seq"))
    log = o.unionByName(ev)
    latest = log.agg(F.max("commit_ts")).first()[0]
    out = None
    for level in ("strong", "bounded"):
        cut = D.consistency_cutoff(level, F.lit(latest).cast("timestamp"), LAG_DAYS * 86400)
        snap = D.snapshot(log.withColumn("commit_ts", F.col("commit_ts").cast("timestamp")), ["k"], "commit_ts",
                          cut, "seq")
        snap = snap.select(F.lit(level).alias("level"), F.col("k").alias("o_orderkey"),
                           F.round("price", 2).alias("price"))
        out = snap if out is None else out.unionByName(snap)
    return out


# --- O48 sessions: each reads at least its own last write -------------------------
def _writer(ts, event_id, latest):
    """Three writers: one still writes, one stopped a day before the end and one five days before."""
    return (F.when(ts > latest - F.expr("INTERVAL 1 DAY"), 2).when((ts > latest - F.expr("INTERVAL 5 DAY")) & (event_id % 3 == 0), 1)
            .otherwise((event_id % 3).cast("int")))


@register("snapshot_read_session", f"""
WITH lim AS (SELECT max(ts) AS latest FROM events),
log AS (SELECT user_id AS k, value, ts, event_id, CASE WHEN ts > latest - INTERVAL 1 DAY THEN 2
          WHEN ts > latest - INTERVAL 5 DAY AND event_id % 3 = 0 THEN 1 ELSE event_id % 3 END AS writer FROM events, lim),
cuts AS (SELECT 'session' AS level, writer AS session, greatest(max(ts), any_value(latest) - INTERVAL {LAG_DAYS} DAY) AS cut
         FROM log, lim GROUP BY writer
         UNION ALL SELECT 'eventually', NULL, latest - INTERVAL {LAG_DAYS} DAY FROM lim),
r AS (SELECT level, session, k, value, row_number() OVER (PARTITION BY level, session, k ORDER BY ts DESC, event_id DESC) AS rn
      FROM log JOIN cuts ON log.ts <= cuts.cut)
SELECT level, session::INTEGER AS session, k AS user_id, round(value, 2) AS value FROM r WHERE rn = 1""")
def snapshot_read_session(spark, sf):
    """What each of three writers reads, and a reader without a session."""
    e = load(spark, sf, "events").select(F.col("user_id").alias("k"), "value", F.col("ts").cast("timestamp").alias("commit_ts"), "event_id")
    latest = F.lit(e.agg(F.max("commit_ts")).first()[0])
    log = e.withColumn("writer", _writer(F.col("commit_ts"), F.col("event_id"), latest))
    own = D.last_commits(log, "writer", "commit_ts")
    session = D.session_snapshots(log, own, ["k"], "commit_ts", "writer", latest, LAG_DAYS * 86400, "event_id")
    eventually = D.snapshot(log, ["k"], "commit_ts", D.consistency_cutoff("eventually", latest, LAG_DAYS * 86400), "event_id")
    out = (session.withColumn("level", F.lit("session"))
           .unionByName(eventually.withColumn("level", F.lit("eventually")).withColumn("session", F.lit(None).cast("int")).drop("writer")))
    return out.select("level", "session", F.col("k").alias("user_id"), F.round("value", 2).alias("value"))
