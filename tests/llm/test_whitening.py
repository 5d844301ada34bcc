import numpy as np
import pytest
from pyspark.sql import functions as F

from vexa.llm import whitening
from vexa.llm.queries import QUERIES
from tests.conftest import SF

SCHEMA = "vec_id long, embedding array<double>, id string, dim string, z string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "i", "d", "z", "n") for i, v in rows], SCHEMA)


def brute(vectors, scale=64):
    """Covariance matrix of the distinct vectors and its eigenpairs, by numpy."""
    x = np.floor(scale * np.array(vectors)) + 1_000_000
    fit = np.unique(x, axis=0)
    d = fit - fit.mean(axis=0)
    e, u = np.linalg.eigh(d.T @ d / len(fit))
    return x, fit, e[::-1], u[:, ::-1]


def check(rows, vectors, k):
    x, fit, e, u = brute(vectors)
    n, s = len(fit), fit.sum(axis=0)
    by = {}
    for r in rows:
        by.setdefault(r.vec_id, {})[r.component] = r
    got = np.array([[by[i][c].whitened for c in range(1, k + 1)] for i in sorted(by)])
    want = (x - s / n) @ u[:, :k] / np.sqrt(e[:k])
    sign = np.sign((got * want).sum(axis=0))
    assert np.abs(got - want * sign).max() < 1e-9
    for r in rows:
        dev = sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[sorted(by).index(r.vec_id)], s))
        assert r.n == n and r.deviation == dev and r.identity_error < 1e-10
        assert abs(r.explained - e[r.component - 1] / e.sum()) < 1e-9


def test_registered_query_equals_numpy(spark):
    rows = QUERIES["op13_whitening"](spark, SF).collect()
    emb = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    assert len(rows) == 16 * len(emb)
    check(rows, [r.embedding for r in emb], 16)


def test_copies_count_once_and_all_come_back(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(50, 6)) * [5, 4, 3, 2, 1, 1]
    vectors = [list(map(float, v[i % 50 if i < 100 else 0])) for i in range(160)]
    got = whitening.whitened(frame(spark, list(enumerate(vectors)))).collect()
    assert len(got) == 160 * 6
    check(got, vectors, 6)


def test_odd_rows(spark):
    nan = float("nan")
    rows = [(1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [float("inf"), 0.0]), (5, []), (6, [0.5, 1.0]), (6, [0.5, 1.0]),
            (None, [2.0, -1.0]), (7, [-1.0, 3.5]), (8, [1.0, 2.0, 3.0]), (9, [1.0, 2.0, 3.0])]
    got = whitening.whitened(frame(spark, rows)).collect()
    # one distinct vector of three entries and an empty one have no components
    assert sorted((str(r.vec_id), r.component) for r in got) == sorted((i, c) for i in ("6", "6", "None", "7") for c in (1, 2))
    assert {r.n for r in got} == {3}
    assert whitening.whitened(frame(spark, [])).collect() == []
    # vectors on a line vary in one direction
    line = whitening.whitened(frame(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(20)])).collect()
    assert {r.component for r in line} == {1} and max(r.identity_error for r in line) < 1e-10


def test_huge_entries_stay_exact_or_null(spark):
    rows = [(i, [1e300 if i == 0 else float(i * 1e6), float(i)]) for i in range(6)]
    got = whitening.whitened(frame(spark, rows)).collect()
    z = [[min(np.floor(64 * x), 2 ** 31 - 1) for x in v] for _, v in rows]
    s = [int(sum(c)) for c in zip(*z)]
    for r in got:
        dev = sum((6 * int(a) - b) ** 2 for a, b in zip(z[r.vec_id], s))
        assert r.deviation == (dev if dev < 2 ** 63 else None)
    mom = whitening.Moments(10 ** 10, np.array([3, -7], object), 2 ** 31)
    z = np.array([[2 ** 31, -(2 ** 31)], [0, 0]])
    assert [int(x) for x in mom.deviations(z)[0]] == [10 ** 10 * 2 ** 31 - 3, -(10 ** 10) * 2 ** 31 + 7]
    assert whitening._exact_squares(mom, z).to_pylist() == [None, 58]


@pytest.mark.parametrize("spectrum", ["flat", "geometric", "outlier", "low rank", "double"])
@pytest.mark.parametrize("dim", [12, 40, 90])
def test_chebyshev_iteration_finds_the_leading_space(dim, spectrum):
    rng = np.random.default_rng(dim)
    e = {"flat": np.linspace(1.0, 0.8, dim), "geometric": 0.7 ** np.arange(dim), "outlier": np.r_[1e6, np.linspace(1.0, 0.8, dim - 1)],
         "low rank": np.r_[np.linspace(3, 1, 7), np.zeros(dim - 7)], "double": np.repeat(np.linspace(2, 1, dim // 2), 2)}[spectrum]
    u = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    v = (u * e) @ u.T
    k = 8
    log = []
    got, q = whitening.leading_eigenpairs(lambda m: v @ m, dim, e.sum(), k, 8, log=log)
    wanted = min(k, int((e > 1e-12 * e.sum()).sum()))
    assert len(got) == wanted
    assert np.abs(got - e[:wanted]).max() <= 1e-12 * e[0]
    assert np.abs(q.T @ q - np.eye(wanted)).max() < 1e-12
    assert np.linalg.norm(v @ q - q * got, axis=0).max() < 1e-11 * e[0]


def test_unreachable_certificate_is_an_error():
    rng = np.random.default_rng(1)
    v = np.diag(np.linspace(2, 1, 60))
    with pytest.raises(whitening.NotCertified):
        whitening.leading_eigenpairs(lambda m: v @ m + 1e-6 * rng.normal(size=m.shape), 60, 90.0, 8, 8, max_rounds=5)


def test_result_does_not_depend_on_partitions(spark):
    emb = spark.read.parquet(f"{SF}/embeddings.parquet").filter("vec_id < 200")
    a, b = (np.abs([r.whitened for r in whitening.whitened(emb.repartition(n)).orderBy("vec_id", "component").collect()]) for n in (1, 13))
    assert np.abs(a - b).max() < 1e-9
    assert whitening.whitened(emb).filter(F.col("identity_error") > 1e-4).count() == 0


def test_one_chunk_is_added_in_one_partition(spark, monkeypatch):
    frame, dealt = type(spark.range(0)), []
    plain = frame.repartition
    monkeypatch.setattr(frame, "repartition", lambda self, n, *by: dealt.append((n, by)) or plain(self, n, *by))
    rng = np.random.default_rng(3)
    x = rng.integers(-50, 50, (40, 600))
    for dim in (5, 600):
        fit = spark.createDataFrame([(bytearray(r[:dim].astype("<i4").tobytes()),) for r in x], "z binary").repartition(7)
        dealt.clear()
        mom = whitening.moments(fit, dim)
        got = whitening.covariance_times(fit, dim, mom, np.eye(dim)[:, :4])
        assert np.allclose(got, np.cov(x[:, :dim].T, bias=True)[:, :4])
        assert dealt == [(1, ()), (1, ()) if dim == 5 else (2, ("chunk",))]
