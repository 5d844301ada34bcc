import numpy as np
import pytest
from pyspark.sql import functions as F

from vexa.llm import common as C
from vexa.llm import mining

SCHEMA = "vec_id long, embedding array<double>, label int, anchor string, id string, dim int, rank string, x string"


def rows_of(n, dim, seed, spread=0.2, groups=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    out = []
    for i in range(n):
        g = int(rng.integers(groups))
        v = centres[g] + spread * rng.normal(size=dim)
        out.append((i, [float(x) for x in v * rng.choice([0.5, 1.0, 2.0])], int(rng.integers(4))))
    return out


def brute(rows, every=10, positives=5, negatives=3):
    """All scores, one by one, in Python integers."""
    ok = [(k, i, [int(np.floor(256 * np.float64(x))) for x in v], l) for k, (i, v, l) in enumerate(rows)
          if l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    big = float("inf")
    out = []
    for ka, a, va, la in ok:
        if a is None or a % every:
            continue
        scores = sorted((-sum(x * y for x, y in zip(va, v)), big if i is None else i, k, i, l)
                        for k, i, v, l in ok if k != ka and len(v) == len(va))
        for p, _, _, pid, _ in [s for s in scores if s[4] == la][:positives]:
            fits = [s for s in scores if s[4] != la and -50 * p <= -100 * s[0] <= -95 * p][:negatives]
            out += [(a, pid, r, s[3], -p, -s[0]) for r, s in enumerate(fits, 1)]
    return sorted(out, key=repr)


def mined(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "a", "i", 3, "r", "x") for r in rows], SCHEMA)
    found = mining.hard_negatives(C.identified(df, "vec_id", "embedding"), F.col("vec_id") % 10 == 0, **kw)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("kw", [{}, {"window_rows": 4, "sample_rows": 20}, {"directions": 1, "pass_bytes": 3000}])
def test_hard_negatives_equal_brute_force(spark, kw):
    rows = rows_of(300, 8, 1)
    assert mined(spark, rows, **kw) == brute(rows)


def test_hard_negatives_with_ties_and_a_hot_vector(spark):
    rows = rows_of(120, 3, 2, spread=0.0)  # whole groups of equal vectors
    rows += [(500 + i, rows[0][1], i % 2) for i in range(60)]
    assert mined(spark, rows, window_rows=8, sample_rows=16) == brute(rows)


def test_hard_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = rows_of(40, 4, 3) + [
        (100, None, 1), (110, [1.0, None, 0.0, 0.0], 1), (120, [1.0, nan, 0.0, 0.0], 1), (130, [inf, 0.0, 0.0, 0.0], 2),
        (140, [1.0, 1.0, 1.0, 1.0], None), (None, [1.0, 2.0, 0.5, 1.0], 0), (150, [1.0, 2.0], 1), (160, [1.0, 2.1], 1),
        (161, [0.8, 1.1], 2), (170, [], 1), (171, [], 1), (172, [], 2), (180, [0.0] * 4, 1), (181, [0.0] * 4, 1)]
    assert mined(spark, rows) == brute(rows)
    # the same id twice, rows that differ
    twice = rows_of(30, 4, 4) + [(10, [1.0, 1.0, 0.0, 0.0], 0), (10, [1.0, 0.9, 0.0, 0.0], 0)]
    assert len(mined(spark, twice)) == len(brute(twice))
    assert mined(spark, []) == []


def test_scores_are_exact_beyond_doubles_and_stay_long(spark):
    a, b = np.array([[2.0 ** 31 - 5] * 3]), np.array([[2.0 ** 31 - 7, 3.0, 1.0]])
    assert mining.products(a, b)[0, 0] == (2 ** 31 - 5) * (2 ** 31 - 7 + 4)
    rows = [(0, [1e300, 1e300], 0), (1, [1e300, 5e299], 0), (2, [3e5, 3e5], 1), (3, [-1e300, 1.0], 1)]
    found = mined(spark, rows)
    assert all(abs(r[4]) < 1 << 62 for r in found)


def test_bounds_hold_and_filter_clustered_rows(spark):
    rng = np.random.default_rng(5)
    x = np.floor(256 * rng.normal(size=(200, 6)) * rng.choice([0.0, 0.1, 1.0, 3.0], size=(200, 1)))
    refs = mining.reference_directions([(6, x)], 5)[6]
    a = mining.Anchors(np.arange(40), np.zeros(40), x[:40], None, None)
    for lo in range(0, 200, 20):
        w = x[lo:lo + 20]
        norm, t = mining.angles(w, refs)
        low, high = a.bounds(refs, t, norm)
        s = x[:40] @ w.T
        assert (low <= s.min(axis=1)).all() and (s.max(axis=1) <= high).all()
    # tight clusters: most windows cannot overlap what an anchor needs
    rows = rows_of(3000, 16, 6, spread=0.02, groups=12)
    df = C.identified(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), "vec_id", "embedding")
    seen = {}
    mining.hard_negatives(df, F.col("vec_id") % 50 == 0, window_rows=32, figures=seen)
    assert seen["scored_positives"] < 0.5 * seen["rows"] * seen["anchors"]
    assert seen["scored_negatives"] < 0.6 * seen["rows"] * seen["anchors"]
