"""Summaries: list-length statistics, exact percentiles, throughput.

``exact_percentile`` gives the linear-interpolation percentile (numpy's
default, DuckDB ``quantile_cont``) by counting in ever narrower ranges: no group is
sorted or gathered, so one that holds a third of all rows costs its tasks' partial counts.
``percentile_approx`` remains the cheaper choice when an
approximation is acceptable.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vexa.operators.common import kept


def list_length_stats(df: DataFrame, list_col: str, name: str | None = None) -> DataFrame:
    n = F.size(F.col(list_col)).cast("double")
    return df.where(F.col(list_col).isNotNull()).agg(
        F.avg(n).alias("mean_len"), F.max(n).alias("max_len"), F.min(n).alias("min_len"),
        F.stddev_pop(n).alias("std_len")).select(F.lit(name or list_col).alias("column_name"), "*")


#: Ranges that a round of the percentile search counts per group.
BUCKETS = 1 << 16


def order_statistics(df: DataFrame, group_cols: list[str], value_col: str, ranks: Callable[[Column], list[Column]]) -> DataFrame:
    """Values at given ranks (0-based, of the non-null values) per group, by distributed selection: (groups, _n, _v0, _v1, ...).

    ``ranks`` gives the wanted ranks for a number of values.  A rank below 0 gives negative infinity, a group without values nulls; NaN counts as
    the largest value.

    Nothing is sorted.  A round counts, for each group, the values in ``BUCKETS`` ranges between the bounds found so far, with the least
    and largest value of each range, and keeps the range that holds the wanted rank; the partial counts of a task are
    all that is shuffled.  The bounds are values of the table, and the two ends of a range never fall into one bucket, so
    every round narrows it, and a range with one distinct value is the answer, however often that value occurs."""
    v = df.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group_cols)], F.col(value_col).cast("double").alias("_v"))
    keys = [f"_g{i}" for i in range(len(group_cols))]
    finite = ~F.isnan("_v") & (F.abs("_v") != float("inf"))
    stats = v.groupBy(*keys).agg(
        F.count("_v").alias("_n"), F.min(F.when(finite, F.col("_v"))).alias("_lo"), F.max(F.when(finite, F.col("_v"))).alias("_hi"),
        F.count(F.when(F.col("_v") == float("-inf"), 1)).alias("_low"), F.count(F.when(finite, 1)).alias("_mid"),
        F.count(F.when(F.col("_v") == float("inf"), 1)).alias("_high"))
    wanted = [r.cast("long") for r in ranks(F.col("_n"))]
    ends = stats.select(*stats.columns, F.posexplode(F.array(*wanted)).alias("_end", "_rank"))
    inside = F.col("_rank") - F.col("_low")
    known = (F.when(F.col("_n") == 0, F.lit(None).cast("double")).when(inside < 0, F.lit(float("-inf")))
             .when(inside < F.col("_mid"), F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")))
             .when(inside < F.col("_mid") + F.col("_high"), F.lit(float("inf"))).otherwise(F.lit(float("nan"))))
    state = kept(ends.select(*keys, "_n", "_end", inside.alias("_rank"), "_lo", "_hi", known.alias("_value"),
                             (known.isNull() & (F.col("_n") > 0)).alias("_open")), "ranks")
    done = state.filter(~F.col("_open"))
    state = state.filter("_open")
    while state.limit(1).count():
        state = kept(_narrowed(v, state, keys), "ranks")
        done = done.unionByName(state.filter(~F.col("_open")))
        state = state.filter("_open")
    values = [F.max(F.when(F.col("_end") == i, F.col("_value"))).alias(f"_v{i}") for i in range(len(wanted))]
    out = done.groupBy(*keys).agg(F.max("_n").alias("_n"), *values)
    return out.select(*[F.col(k).alias(c) for k, c in zip(keys, group_cols)], "_n", *[f"_v{i}" for i in range(len(wanted))])


def exact_percentile(df: DataFrame, group_cols: list[str], value_col: str, p: float,
                     out: str = "p") -> DataFrame:
    """Linear-interpolation percentile per group (see ``order_statistics``); null for a group without values."""
    def pos(n):
        return F.lit(float(p)) * (n - 1)

    both = order_statistics(df, group_cols, value_col, lambda n: [F.floor(pos(n)), F.ceil(pos(n))])
    a, b, frac = F.col("_v0"), F.col("_v1"), pos(F.col("_n")) - F.floor(pos(F.col("_n")))
    return both.select(*group_cols, F.when((a == b) | (frac == 0), a).otherwise(a + (b - a) * frac).alias(out))


def _narrowed(v: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """One round: the range of each open end that holds its rank."""
    same = [F.col(f"v.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    within = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
    cond = within
    for c in same:
        cond = cond & c
    j = v.alias("v").join(state.alias("s"), cond).select(*[f"s.{k}" for k in keys], "_n", "_end", "_rank", "_lo", "_hi", "_v")
    share = F.try_divide(F.col("_v") * 0.5 - F.col("_lo") * 0.5, F.col("_hi") * 0.5 - F.col("_lo") * 0.5)
    bucket = (F.when(F.col("_v") == F.col("_lo"), 0).when(F.col("_v") == F.col("_hi"), BUCKETS - 1)
              .otherwise(F.least(F.floor(share * (BUCKETS - 2)), F.lit(BUCKETS - 2))).cast("int"))
    group = [*keys, "_n", "_end", "_rank"]
    counts = j.groupBy(*group, bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    upto = F.sum("_c").over(Window.partitionBy(*group).orderBy("_bucket"))  # at most BUCKETS rows
    hit = counts.withColumn("_upto", upto).filter((F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_c")))
    return hit.select(*keys, "_n", "_end", (F.col("_rank") - F.col("_upto") + F.col("_c")).alias("_rank"), "_lo", "_hi",
                      F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).alias("_value"), (F.col("_lo") < F.col("_hi")).alias("_open"))


def throughput(df: DataFrame, group_col: str, ts_col: str, window: str = "1 hour",
               seconds: int = 3600) -> DataFrame:
    """Completed count / window length per (group, window), then the maximum per group."""
    per = df.groupBy(group_col, F.window(ts_col, window).alias("w")).agg(
        (F.count(F.lit(1)) / F.lit(float(seconds))).alias("qps"))
    return per.groupBy(group_col).agg(F.max("qps").alias("max_qps"), F.count(F.lit(1)).alias("windows"))
