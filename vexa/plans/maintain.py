"""Registered maintenance queries on lineitem.

Segment = l_orderkey % 64; row width 100 bytes; delete log = the keys
(l_orderkey, l_linenumber) of returned items (l_returnflag = 'R') -- a key
delete removes every row with that key; rows expire 1500 days before the
latest ship date.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from vexa.operators import maintain as M
from vexa.plans.registry import load, register
from vexa.session import scratch_path

SEGS, ROW_BYTES, TTL_DAYS = 64, 100, 1500
KEYS = ["l_orderkey", "l_linenumber"]

SQL_BASE = f"""
lim AS (SELECT max(l_shipdate) - INTERVAL {TTL_DAYS} DAY AS cut FROM lineitem),
dl AS (SELECT DISTINCT l_orderkey, l_linenumber, true AS del FROM lineitem WHERE l_returnflag = 'R'),
b AS (SELECT l.l_orderkey % {SEGS} AS seg, coalesce(dl.del, false) AS del, l.l_shipdate < (SELECT cut FROM lim) AS exp
      FROM lineitem l LEFT JOIN dl ON dl.l_orderkey = l.l_orderkey AND dl.l_linenumber = l.l_linenumber),
st AS (SELECT seg, count(*) AS num_rows, count(*) * {ROW_BYTES} AS bytes,
         sum(CASE WHEN del THEN 1 ELSE 0 END)::BIGINT AS deleted_rows,
         sum(CASE WHEN del THEN 1 ELSE 0 END)::BIGINT * {ROW_BYTES} AS deleted_bytes,
         sum(CASE WHEN exp AND NOT del THEN 1 ELSE 0 END)::BIGINT AS expired_rows,
         sum(CASE WHEN exp AND NOT del THEN 1 ELSE 0 END)::BIGINT * {ROW_BYTES} AS expired_bytes,
         sum(CASE WHEN del THEN 1 ELSE 0 END)::BIGINT AS delete_log_entries
       FROM b GROUP BY seg)"""


def _inputs(spark, sf):
    li = load(spark, sf, "lineitem")
    cut = li.agg(F.max("l_shipdate")).first()[0] - dt.timedelta(days=TTL_DAYS)
    expired = F.col("l_shipdate") < F.lit(cut)
    log = li.where(F.col("l_returnflag") == "R").select(*KEYS)
    return li, log, expired


def _stats(spark, sf):
    li, log, expired = _inputs(spark, sf)
    return M.segment_stats(li, F.col("l_orderkey") % SEGS, KEYS, log, expired, ROW_BYTES)


@register("segment_stats", f"WITH {SQL_BASE} SELECT * FROM st")
def segment_stats(spark, sf):
    return _stats(spark, sf)


@register("compact_rewrite", f"""
WITH lim AS (SELECT max(l_shipdate) - INTERVAL {TTL_DAYS} DAY AS cut FROM lineitem)
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE NOT (l_shipdate < (SELECT cut FROM lim))
  AND (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber) FROM lineitem WHERE l_returnflag = 'R')""")
def compact_rewrite(spark, sf):
    li, log, expired = _inputs(spark, sf)
    path = scratch_path(spark, "compacted")
    M.compact(li, KEYS, log, expired).hint("rebalance").write.parquet(path)
    return spark.read.parquet(path).select(*KEYS)


TRIGGERS = dict(max_log_entries=250, expired_ratio=0.05, max_expired_bytes=6000,
                deleted_ratio=0.26, max_deleted_bytes=26000, manual=[0])


@register("compaction_candidates", f"""
WITH {SQL_BASE}
SELECT seg, delete_log_entries > 250 AS too_many_log_entries,
  expired_rows / num_rows::DOUBLE >= 0.05e0 AS expired_ratio_hit, expired_bytes > 6000 AS expired_bytes_hit,
  deleted_rows / num_rows::DOUBLE >= 0.26e0 AS deleted_ratio_hit, deleted_bytes > 26000 AS deleted_bytes_hit,
  seg IN (0) AS manual
FROM st WHERE delete_log_entries > 250 OR expired_rows / num_rows::DOUBLE >= 0.05e0 OR expired_bytes > 6000
  OR deleted_rows / num_rows::DOUBLE >= 0.26e0 OR deleted_bytes > 26000 OR seg IN (0)""")
def compaction_candidates(spark, sf):
    return M.candidates(_stats(spark, sf), **TRIGGERS)


EXPECTED, PROPORTION, TARGET = 100_000, 1.0, 400_000


@register("small_file_grouping", f"""
WITH {SQL_BASE},
s AS (SELECT seg, bytes FROM st WHERE bytes <= {EXPECTED * PROPORTION})
SELECT seg, bytes, floor(coalesce(sum(bytes) OVER (ORDER BY seg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
  / {TARGET})::BIGINT AS group_no FROM s""")
def small_file_grouping(spark, sf):
    return M.small_file_groups(_stats(spark, sf), EXPECTED, PROPORTION, TARGET)
