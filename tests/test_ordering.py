import numpy as np
from pyspark.sql import functions as F

from vexa.operators.aggregates import exact_percentile
from vexa.operators.ordering import global_row_number


def test_global_row_number_independent_of_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), F.col("id"))
    res = []
    for parts in (1, 7, 23):
        out = global_row_number(df.repartition(parts), [F.col("k").asc(), F.col("id").asc()], "rn", 5)
        res.append(sorted((r.rn, r.k) for r in out.collect()))
    assert res[0] == res[1] == res[2]
    assert [rn for rn, _ in res[0]] == list(range(1, 5001))
    assert [k for _, k in res[0]] == sorted(k for _, k in res[0])


def test_exact_percentile_matches_numpy_with_a_hot_group(spark):
    rng = np.random.default_rng(1)
    hot = [("hot", float(x)) for x in rng.normal(size=3000)]
    cold = [("cold", float(x)) for x in rng.uniform(size=101)]
    df = spark.createDataFrame(hot + cold, "g string, v double").repartition(6)
    got = {r.g: r.p for r in exact_percentile(df, ["g"], "v", 0.99).collect()}
    assert np.isclose(got["hot"], np.percentile([v for _, v in hot], 99))
    assert np.isclose(got["cold"], np.percentile([v for _, v in cold], 99))
