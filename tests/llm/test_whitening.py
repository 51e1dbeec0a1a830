from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermart.llm import whitening

KIND = "vec_id bigint, embedding array<float>"


def brute(rows, scale=256, k=4):
    """Plain covariance in fractions over the distinct integer vectors."""
    ints = [(i, tuple(int(np.floor(float(c) * scale)) for c in v)) for i, v in rows]
    fit = sorted({x for _, x in ints})
    n, d = len(fit), len(fit[0])
    mean = [Fraction(sum(x[j] for x in fit), n) for j in range(d)]
    cov = [[sum((x[a] - mean[a]) * (x[b] - mean[b]) for x in fit) / n for b in range(d)] for a in range(d)]
    values, vectors = np.linalg.eigh(np.array([[float(c) for c in row] for row in cov]))
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for i, x in ints:
        far = sum((n * x[j] - int(n * mean[j])) ** 2 for j in range(d))
        w = np.array([float(x[j] - mean[j]) for j in range(d)]) @ vectors[:, :k] / np.sqrt(values[:k])
        out[i] = (n, far, w, values[:k] / values.sum())
    return out, np.array([[float(c) for c in row] for row in cov])


def test_equals_the_plain_covariance(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(0, 1, (60, 6)) @ rng.normal(0, 1, (6, 6)) + 3
    rows = [(i, np.float32(v).tolist()) for i, v in enumerate(base)] + [(100, np.float32(base[0]).tolist())]
    expected, cov = brute(rows)
    df = spark.createDataFrame(rows, KIND).repartition(5)
    model = whitening.fitted(whitening.scaled(df).select("x").distinct())
    assert np.allclose(model.covariance, cov, rtol=1e-15, atol=0)
    got = whitening.whiten(df).collect()
    assert len(got) == 61 * 4
    sign = {}
    for r in got:
        n, far, w, share = expected[r.vec_id]
        c = r.component - 1
        assert r.n == n == 60 and r.deviation == far and r.identity_error < 1e-9
        assert r.explained == pytest.approx(share[c], rel=1e-12)
        s = sign.setdefault(c, np.sign(r.whitened * w[c]))
        assert r.whitened * s == pytest.approx(w[c], abs=1e-9)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (4, []), (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 1.0]),
            (None, [3.0, -1.0]), (8, [1.0]), (9, [-0.0, 0.001]), (10, [3.0e38, 1.0])]
    df = spark.createDataFrame(rows, KIND).withColumns({c: F.lit("x") for c in ("x", "n", "v", "a", "component", "d")})
    got = whitening.whiten(df).collect()
    assert sorted((r.vec_id is not None, r.vec_id, r.component) for r in got) == sorted(
        (i is not None, i, c) for i in (1, 2, 2, None, 9) for c in (1, 2))
    assert {r.n for r in got} == {3}
    assert whitening.whiten(df.limit(0)).collect() == []
    assert whitening.whiten(df.where("vec_id in (3, 4, 5)")).collect() == []
    one = whitening.whiten(df.where("vec_id = 1")).collect()
    assert [(r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, 0.0, 0.0)] * 2


@pytest.mark.parametrize("top", [10, 1 << 24, 1 << 40, 1 << 61])
def test_square_sums_are_exact(top):
    z = np.random.default_rng(1).integers(-top, top, (300, 4))
    assert whitening.square_sums(z) == [sum(int(v) ** 2 for v in col) for col in z.T]


def test_centred_beyond_longs():
    x = np.array([[1 << 60, -5], [7, 1 << 59]])
    sums = np.array([(1 << 60) + 7, (1 << 59) - 5], object)
    z = whitening.centred(x, 1 << 20, sums)
    assert z.tolist() == [[int(x[r, c]) * (1 << 20) - sums[c] for c in range(2)] for r in range(2)]


def test_large_values(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in rng.integers(-10**15, 10**15, 3)]) for i in range(20)]
    expected, _ = brute(rows)
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert all(r.deviation == expected[r.vec_id][1] for r in got) and len(got) == 60


def test_whole_table_equals_numpy(spark):
    from ordermart.llm.queries import QUERIES

    got = QUERIES["op12_whitening"](spark, "/root/testdata/sf0.01").toPandas()
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").toPandas()
    x = np.floor(np.stack(rows["embedding"]).astype(np.float64) * 256)
    fit = np.unique(x, axis=0)
    v = np.cov(fit.T, bias=True)
    values = np.linalg.eigvalsh(v)[::-1]
    assert len(got) == 4 * len(rows) and got["identity_error"].max() < 1e-9
    assert np.allclose(got.groupby("component")["explained"].first(), values[:4] / values.sum(), rtol=1e-9)
    z = len(fit) * x - fit.sum(axis=0)
    far = got[got["component"] == 1].set_index("vec_id")["deviation"]
    assert (far.loc[rows["vec_id"]].to_numpy() == (z ** 2).sum(axis=1).astype(np.int64)).all()
