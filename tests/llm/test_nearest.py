import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermart.llm import nearest as nn

KIND = "vec_id bigint, embedding array<float>"


def brute(rows, k=5, every=50):
    """All cosines, row by row: query_id -> [(vec_id, score)]."""
    used = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    out = {}
    for at, (q, a) in enumerate(used):
        if q % every == 0 and q not in out:
            near = [(-float(a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b))), i) for j, (i, b) in enumerate(used) if j != at and len(a) == len(b)]
            out[q] = [(i, -s) for s, i in sorted((round(s, 12), i) for s, i in near)[:k]]
    return out


def found(df, **options):
    out = {}
    for r in sorted(nn.nearest(df, **options).collect()):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def same(got, expected):
    assert got.keys() == {q for q, near in expected.items() if near}
    for q, near in got.items():
        assert [i for i, _ in near] == [i for i, _ in expected[q]]
        assert [s for _, s in near] == pytest.approx([s for _, s in expected[q]], abs=1e-12)


def test_small_table_with_copies_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, np.float32(v).tolist()) for i, v in enumerate(rng.normal(size=(160, 8)))]
    # copies of one vector, also of a query's, are a third of the table
    rows += [(200 + i, rows[50][1]) for i in range(80)]
    same(found(spark.createDataFrame(rows, KIND).repartition(4)), brute(rows))


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, []), (4, [0.0, -0.0]), (5, [nan, 1.0]), (6, [1.0, None]),
            (7, [-inf, 0.0]), (None, [1.0, 1.0]), (50, [0.0, 1.0]), (100, [-0.0, 2.0]), (8, [1.0, 2.0, 3.0]), (9, [3e38, 3e38]), (150, [1e-30, 0.0])]
    df = spark.createDataFrame(rows, KIND).withColumns({c: F.lit("x") for c in ("v", "h", "node", "u", "w", "q", "sim", "rank", "start")})
    got = found(df)
    expected = brute([r for r in rows if r[0] != 8])
    assert {q: [s for _, s in near] for q, near in got.items()} == {
        q: pytest.approx([s for _, s in near], abs=1e-6) for q, near in expected.items()}
    assert got[0][0] == (0, 1.0) and got[50][0][0] == 100
    assert found(df.limit(0)) == {} and found(df.where("vec_id = 50")) == {}
    assert found(df.where("vec_id in (2, 3, 4, 5, 6, 7)")) == {}


def test_the_descent_finds_what_blocks_do_not(spark):
    rng = np.random.default_rng(3)
    rows = [(i, np.float32(v).tolist()) for i, v in enumerate(rng.normal(size=(600, 6)))]
    df = spark.createDataFrame(rows, KIND)
    expected = brute(rows, every=5)
    options = {"every": 5, "degree": 8, "reverse": 8, "orders": 2, "block": 16}

    def recall(got):
        return np.mean([len({i for i, _ in got.get(q, [])} & {i for i, _ in near}) / 5 for q, near in expected.items()])

    nodes = df.select(F.col("vec_id").alias("node"), F.col("embedding").alias("v"))
    few = nn.build(nodes, degree=8, reverse=8, orders=2, block=16, rounds=0)
    more = nn.build(nodes, degree=8, reverse=8, orders=2, block=16, rounds=6)
    assert more.rounds > 1 and more.edges.agg(F.sum("sim")).first()[0] > few.edges.agg(F.sum("sim")).first()[0] * 1.05
    assert recall(found(df, beam=32, **options)) > 0.95
    with pytest.raises(ValueError):
        nn.build(nodes, orders=1)


def test_whole_table_recall(spark):
    from ordermart.llm.queries import QUERIES

    path = "/root/testdata/sf0.1"
    got = QUERIES["op13_nearest"](spark, path).toPandas()
    table = spark.read.parquet(f"{path}/embeddings.parquet").toPandas()
    ids, m = table["vec_id"].to_numpy(), np.stack(table["embedding"]).astype(np.float64)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    asked = np.flatnonzero(ids % 50 == 0)
    sim = m[asked] @ m.T
    sim[np.arange(len(asked)), asked] = -9
    assert len(got) == 5 * len(asked)
    truth = {int(ids[q]): set(ids[np.argsort(-s)[:5]].tolist()) for q, s in zip(asked, sim, strict=True)}
    hits = [r.vec_id in truth[r.query_id] for r in got.itertuples()]
    assert np.mean(hits) >= 0.95
    at = {int(i): k for k, i in enumerate(ids)}
    assert np.allclose(got["score"], [m[at[r.query_id]] @ m[at[r.vec_id]] for r in got.itertuples()], atol=1e-12)
