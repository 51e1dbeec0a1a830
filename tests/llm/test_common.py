import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ordermart.llm import common


def test_numbered_is_the_sort_position(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.lit(1).alias("same")).repartition(5)
    assert all(r.k == r.ordinal for r in common.numbered(df, ["k"], "t").collect())
    ties = common.numbered(df, ["same"], "t").collect()
    assert sorted(r.ordinal for r in ties) == list(range(1000))
    assert common.numbered(df.limit(0), ["k"], "t").count() == 0


def test_slices_cover_the_batch():
    texts = ["a" * n for n in (0, 5, 100, 3, 0, 7, 50)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    parts = list(common.pieces_of(batch, "text", 20))
    assert [x for p in parts for x in p.column("text").to_pylist()] == texts and len(parts) > 2
    assert list(common.pieces_of(batch.slice(0, 0), "text")) == []


def test_ragged():
    assert common.ragged(np.array([3, 0, 9]), np.array([2, 0, 3])).tolist() == [3, 4, 9, 10, 11]
    assert common.ragged(np.array([], np.int64), np.array([], np.int64)).tolist() == []


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda key, default: None)})

    with pytest.raises(RuntimeError):
        common.shared_dir(Session())


def test_the_halves_of_a_text_key_are_independent(spark):
    """Not the salt hashed from the first half as its seed, for any text."""
    import xxhash

    texts = ["", "a", "one line", "x" * 500]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", *[h.alias(f"h{i}") for i, h in enumerate(common.text_key(F.col("t")))]).collect()
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    for r in rows:
        assert r.h0 == signed(xxhash.xxh64_intdigest(r.t, 42))
        assert r.h1 != signed(xxhash.xxh64_intdigest(common.SALT, r.h0 % (1 << 64)))
        assert r.h1 == signed(xxhash.xxh64_intdigest(r.t, xxhash.xxh64_intdigest(common.SALT, 42)))


def test_a_task_gives_back_its_memory(monkeypatch):
    from ordermart.llm import common

    given, pool = [], pa.default_memory_pool()

    class Arrow:
        @staticmethod
        def default_memory_pool():
            return type("Pool", (), {"release_unused": lambda self: given.append("arrow")})()

        @staticmethod
        def system_memory_pool():
            return type("Pool", (), {"release_unused": lambda self: given.append("system")})()

    monkeypatch.setattr(common, "pa", Arrow)
    doubled = common.lean(lambda batches: (2 * x for x in batches))
    assert list(doubled([1, 2])) == [2, 4] and given == ["arrow", "system"] and pool.bytes_allocated() >= 0
    first = doubled([1, 2])
    assert next(first) == 2 and len(given) == 2
    first.close()  # a task that ends early
    assert len(given) == 4
