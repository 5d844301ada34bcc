"""Registered streaming queries (O80-O84): the whole table arrives as
several files, is consumed by an availableNow stream, and the end state is
compared with the batch answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from vexa.operators import ann as A
from vexa.operators.knn import centroid_queries, local_queries, rounded
from vexa.plans import dml as PD
from vexa.plans import search as PS
from vexa.plans.registry import load, register
from vexa.session import scratch_path
from vexa.streaming import jobs as J
from vexa.streaming.hits import KeptHits


def _split_by_label(df):
    return [df.where(F.col("label") < 3), df.where((F.col("label") >= 3) & (F.col("label") < 6)),
            df.where((F.col("label") >= 6) | F.col("label").isNull())]


def _kept(spark, sf, name, **kw):
    q = local_queries(centroid_queries(load(spark, sf, "embeddings"), "label", "embedding"))
    return KeptHits(spark, q, scratch_path(spark, name), id_col="vec_id", vec_col="embedding", k=10, **kw)


@register("stream_append_search", PS._sql_knn(PS.S.l2("b.embedding", "q.qv"), "WHERE b.label >= 5"))
def stream_append_search(spark, sf):
    """Kept top-k: each batch is searched as it arrives; the last version is the answer over all rows."""
    kept = _kept(spark, sf, "append-search")
    J.run_arrivals(spark, _split_by_label(load(spark, sf, "embeddings")), lambda df, b: kept.add(df.where(F.col("label") >= 5), b), "append-search")
    return rounded(kept.at())


def _versions_sql(conditions):
    out = []
    for i, cond in enumerate(conditions):
        cand = f"SELECT q.qid, b.vec_id, {PS.S.l2('b.embedding', 'q.qv')} AS d FROM embeddings b, q WHERE {cond}"
        out.append(f"SELECT {i} AS version, * FROM ({PS.S.topk(cand, PS.K, 'ASC', 'vec_id')})")
    return f"WITH {PS.S.CENTROIDS}\n" + "\nUNION ALL\n".join(out)


def _as_of(kept, versions):
    out = None
    for i, v in enumerate(versions):
        r = rounded(kept.at(v)).withColumn("version", F.lit(i))
        out = r if out is None else out.unionByName(r)
    return out


@register("stream_search_prefixes", _versions_sql(["b.label < 3", "b.label < 6", "true"]))
def stream_search_prefixes(spark, sf):
    """The answer after each arrival, read when all have landed."""
    kept = _kept(spark, sf, "search-prefixes")
    last = J.run_arrivals(spark, _split_by_label(load(spark, sf, "embeddings")), kept.add, "search-prefixes")
    return _as_of(kept, last)


@register("stream_delete_versions", _versions_sql(["true", "b.label >= 2 OR b.label IS NULL", "b.label >= 5 OR b.label IS NULL"]))
def stream_delete_versions(spark, sf):
    """Deletions arrive while searches go on: the answer before them and after each arrival, withdrawn hits refilled."""
    emb = load(spark, sf, "embeddings")
    kept = _kept(spark, sf, "delete-versions", spare=5)
    kept.add(emb, 0)
    log = scratch_path(spark, "delete-versions-log")
    write = J.batch_sink(log)

    def gone(df, b):
        write(df, b)
        kept.remove(df, b + 1, J.delete_view(emb, spark.read.parquet(log), ["vec_id"], upto_batch=b))

    doomed = [emb.where(F.col("label") < 2), emb.where((F.col("label") >= 2) & (F.col("label") < 5))]
    last = J.run_arrivals(spark, [d.select("vec_id") for d in doomed], gone, "delete-versions")
    return _as_of(kept, [0, *[b + 1 for b in last]])


@register("stream_upsert", PD.UPSERT_SQL)
def stream_upsert(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    base = o.drop("o_orderpriority").withColumn("seq", F.lit(0))
    ch = PD.upsert_changes(o)
    parts = [base, ch.where(F.col("seq") == 1), ch.where(F.col("seq") == 2)]
    log = J.stream_into_table(spark, parts, "upsert")
    st = J.upsert_view(log, ["o_orderkey"], "seq")
    return st.select("o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice"), "o_orderstatus")


@register("stream_incremental_index", PS._sql_knn(PS.S.l2("b.embedding", "q.qv"), "WHERE b.label >= 5"))
def stream_incremental_index(spark, sf):
    emb = load(spark, sf, "embeddings")
    later = F.coalesce(F.col("label") >= 5, F.lit(True))  # rows without a label arrive later
    first = emb.where(~later)
    idx = A.ivf_build(spark, first, "vec_id", "embedding", 8, seed=42)
    # later vectors stream in and get the nearest existing cell; no rebuild
    arrived = J.stream_into_table(spark, _split_by_label(emb.where(later)), "incr-index",
                                  transform=lambda df: A.ivf_assign(idx, df))
    cols = [*emb.columns, "cell"]
    grown = idx.table(spark).select(*cols).unionByName(arrived.select(*cols))
    q = centroid_queries(emb, "label", "embedding")
    hits = A.ivf_search(spark, idx, q, k=10, nprobe=idx.nlist, where=F.col("label") >= 5, table=grown)
    return rounded(hits)


@register("stream_delete_log", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F' OR o_orderstatus IS NULL""")
def stream_delete_log(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    doomed = o.where(F.col("o_orderstatus") == "F").select("o_orderkey")
    parts = [doomed.where(F.col("o_orderkey") < 5000), doomed.where(F.col("o_orderkey") >= 5000)]
    log = J.stream_into_table(spark, parts, "delete-log")
    return J.delete_view(o, log, ["o_orderkey"])


@register("stream_ttl", f"""
SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL {PD.TTL_DAYS} DAY""")
def stream_ttl(spark, sf):
    e = load(spark, sf, "events").select("event_id", "ts", "event_type")
    parts = [e.where(F.pmod(F.xxhash64("event_type"), F.lit(4)) == i) for i in range(4)]
    parts.append(parts[0])  # a replayed file: its rows must not count twice
    # a row behind the watermark is older than the TTL, so it has expired anyway
    table = J.stream_into_table(spark, parts, "ttl", dedupe=(["event_id"], "ts", f"{PD.TTL_DAYS} days"))
    return J.ttl_view(table, "ts", PD.TTL_DAYS * 86400).select("event_id", "ts")
