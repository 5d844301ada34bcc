"""Writes, updates and deletes as DataFrame jobs over (base, changes).

Plain Parquet tables take no MERGE / DELETE, so every operation returns the
new table as a DataFrame; ``VersionedTable`` publishes it atomically as a
new version directory plus a one-file pointer swap.

Scale notes: upserts and key deletes never shuffle the base when the change
set is small -- the (size-checked) change keys are broadcast into an anti
join; only large change sets fall back to a sort-merge anti join.  Latest
wins inside the change set is a ``row_number() = 1`` per key, which Spark
pre-trims per task (WindowGroupLimit), so a hot key costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vexa.operators.aggregates import order_statistics
from vexa.operators.common import broadcast_if_small, kept, rank_within
from vexa.operators.ordering import global_row_number


def latest_per_key(df: DataFrame, keys: list[str], seq_col, *more_seq: str) -> DataFrame:
    order = [F.col(c).desc() for c in (seq_col, *more_seq)]
    r = rank_within(df, keys, order, 1, name="_rk")
    return r.drop("_rk")


def upsert(base: DataFrame, changes: DataFrame, keys: list[str], seq_col: str | None = None) -> DataFrame:
    """Insert or fully replace rows by key; within ``changes`` the highest
    ``seq_col`` wins (no seq: all change keys must be distinct)."""
    ch = latest_per_key(changes, keys, seq_col).drop(seq_col) if seq_col else changes
    ch = broadcast_if_small(ch.select(*base.columns))  # evaluated once, for the join and for the rows
    return base.join(ch.select(*keys), keys, "left_anti").unionByName(ch)


def upsert_log(log: DataFrame, keys: list[str], seq_col: str) -> DataFrame:
    """Latest-wins over a full change log (base rows included with low seq)."""
    return latest_per_key(log, keys, seq_col).drop(seq_col)


def delete_where(base: DataFrame, pred: Column) -> DataFrame:
    """Drop rows where ``pred`` is true; a null predicate keeps the row."""
    return base.where(~F.coalesce(pred, F.lit(False)))


def delete_keys(base: DataFrame, keys_df: DataFrame, keys: list[str]) -> DataFrame:
    return base.join(broadcast_if_small(keys_df.select(*keys).distinct()), keys, "left_anti")


def sample_keys_per_segment(base: DataFrame, seg_col: str, key_col: str, percent: float) -> DataFrame:
    """``floor(percent/100 * segment rows)`` keys per segment, chosen by md5 of the key.

    Repeatable (no random state) and skew-safe: the md5 at which a segment's share ends is found by counting
    (``aggregates.order_statistics`` on its first 52 bits); rows below it are taken, and only where more rows than needed share these bits
    are they put in order."""
    h = base.select(seg_col, key_col, F.md5(F.col(key_col).cast("string")).alias("_h"))
    h = h.withColumn("_x", F.coalesce(F.conv(F.substring("_h", 1, 13), 16, 10).cast("double"), F.lit(-1.0)))  # a null key comes first

    def take(n):
        return F.floor(n * F.lit(float(percent)) / F.lit(100.0)).cast("long")

    cuts = order_statistics(h, [seg_col], "_x", lambda n: [take(n) - 1]).select(
        F.col(seg_col).alias("_seg"), take(F.col("_n")).alias("_take"), F.col("_v0").alias("_cut"))
    j = h.join(broadcast_if_small(cuts), F.col(seg_col).eqNullSafe(F.col("_seg"))).filter(F.col("_x") <= F.col("_cut"))
    at_cut = F.col("_x") == F.col("_cut")
    n = j.groupBy("_seg").agg(F.max("_take").alias("_take"), F.count(F.when(~at_cut, 1)).alias("_below"), F.count(F.when(at_cut, 1)).alias("_same"))
    tied = kept(n.filter(F.col("_below") + F.col("_same") > F.col("_take")).select(F.col("_seg").alias("_tied"), (F.col("_take") - F.col("_below")).alias("_need")))
    if not tied.limit(1).count():
        return j.select(seg_col, key_col)
    marked = j.join(broadcast_if_small(tied), F.col("_seg").eqNullSafe(F.col("_tied")), "left")
    sure = marked.filter(F.col("_need").isNull() | ~at_cut)
    close = global_row_number(marked.filter(F.col("_need").isNotNull() & at_cut).select(seg_col, key_col, "_h", "_need"),
                              [F.col(seg_col).asc(), F.col("_h").asc(), F.col(key_col).asc()], "_rn")
    first = broadcast_if_small(close.groupBy(F.col(seg_col).alias("_first")).agg(F.min("_rn").alias("_start")))
    close = close.join(first, F.col(seg_col).eqNullSafe(F.col("_first"))).filter(F.col("_rn") - F.col("_start") < F.col("_need"))
    return sure.select(seg_col, key_col).unionByName(close.select(seg_col, key_col))


def delete_in_batches(doomed: DataFrame, key_col: str, total: int, batch_size: int) -> DataFrame:
    """Delete ``doomed`` keys in batches of ``batch_size`` (key order);
    rows left after each batch = total - rows deleted so far."""
    n = global_row_number(doomed.select(key_col), [F.col(key_col).asc()], "_rn")
    b = n.groupBy(F.floor((F.col("_rn") - 1) / batch_size).cast("long").alias("batch_no")).agg(
        F.count(F.lit(1)).alias("deleted"), F.max("_rn").alias("_upto"))
    return b.select("batch_no", "deleted", (F.lit(total) - F.col("_upto")).alias("remaining"))


def ttl_filter(df: DataFrame, ts_col: str, ttl_seconds: int, as_of) -> DataFrame:
    """Rows younger than the TTL at ``as_of`` (a timestamp literal or Column)."""
    as_of_c = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    cutoff = as_of_c - F.make_interval(secs=F.lit(ttl_seconds))
    return df.where(F.col(ts_col).cast("timestamp") > cutoff)


def snapshot(log: DataFrame, keys: list[str], commit_col: str, as_of: Column, *tie: str) -> DataFrame:
    """Table state as of a commit time: latest row per key with commit <= as_of."""
    return latest_per_key(log.where(F.col(commit_col) <= as_of), keys, commit_col, *tie)


def consistency_cutoff(level: str, latest: Column, lag_seconds: int = 0, own_write: Column | None = None) -> Column:
    """Read timestamp of a consistency level.

    Strong = latest commit; Bounded = latest - lag; Session = max(own last
    write, bounded); Eventually = the bounded cutoff as well (any older
    prefix is allowed, we pick the bounded one so reads are repeatable)."""
    bounded = latest - F.make_interval(secs=F.lit(lag_seconds))
    level = level.lower()
    if level == "strong":
        return latest
    if level in ("bounded", "eventually"):
        return bounded
    if level == "session":
        return F.greatest(own_write, bounded) if own_write is not None else bounded
    raise ValueError(level)


def last_commits(log: DataFrame, writer_col: str, commit_col: str) -> DataFrame:
    """(writer, last_commit): one row per writer of a change log."""
    return log.groupBy(F.col(writer_col).alias("writer")).agg(F.max(commit_col).alias("last_commit"))


#: Sessions that one call reads for.
MAX_SESSIONS = 4096


def session_snapshots(log: DataFrame, own: DataFrame, keys: list[str], commit_col: str, writer_col: str, latest: Column, lag_seconds: int,
                      *tie: str) -> DataFrame:
    """Table state that each session of ``own`` (see ``last_commits``; at most ``MAX_SESSIONS``) reads: commits up to its own last
    write, or to the bounded cutoff if that is later.  Adds ``session``; ``writer_col`` goes.

    Only the latest row of a key up to a cutoff counts, so the log is first cut to the latest row per key between two
    cutoffs; each of these is then handed to the sessions that may see it, however long the log is."""
    cut = consistency_cutoff("session", latest, lag_seconds, F.col("last_commit"))
    asked = own.select(F.col("writer").alias("session"), cut.alias("cut")).orderBy("cut", "session").limit(MAX_SESSIONS + 1).collect()
    if len(asked) > MAX_SESSIONS:
        raise ValueError(f"more than {MAX_SESSIONS} sessions in one call")
    edges = F.array(*[F.lit(r.cut) for r in asked]).cast("array<timestamp>")
    sessions = F.array(*[F.lit(r.session) for r in asked])
    before = F.size(F.filter(edges, lambda c: c < F.col(commit_col)))  # sessions that do not see the row
    last = latest_per_key(log.withColumn("_before", before).filter(F.col("_before") < len(asked)), ["_before", *keys], commit_col, *tie)
    seen = last.withColumn("session", F.explode(F.slice(sessions, F.col("_before") + 1, F.lit(len(asked)))))
    return latest_per_key(seen, ["session", *keys], commit_col, *tie).drop("_before", writer_col)


def validate_batch(batch: DataFrame, valid: Column) -> bool:
    """True when every row of the batch passes (one aggregate job)."""
    r = batch.agg(F.coalesce(F.bool_and(F.coalesce(valid, F.lit(False))), F.lit(True)).alias("ok")).first()
    return bool(r["ok"])
