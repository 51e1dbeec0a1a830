import zlib

import numpy as np
from helpers import docs_of, odd_rows, with_extra
from pyspark.sql import functions as F

from ordermart.llm import sharding as sd


def test_curve_visits_every_cell_once_in_unit_steps():
    for dims, bits in ((2, 4), (3, 3)):
        side = 1 << bits
        points = np.array(np.meshgrid(*[np.arange(side)] * dims)).reshape(dims, -1)
        index = sd.hilbert_index(points, bits)
        assert sorted(index.tolist()) == list(range(side ** dims))
        steps = np.abs(np.diff(points[:, np.argsort(index)], axis=1)).sum(axis=0)
        assert (steps == 1).all()


def sharded(spark, rows, shards=4):
    docs = with_extra(docs_of(spark, rows)).drop("hilbert", "shard", "size").withColumn(
        "size", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint"))
    return sd.hilbert_shards(docs, shards, ["lang", "source"], "size", ["doc_id"]).collect()


def test_rows_law_slots_and_order(spark):
    rows = [(i, "x" * (i * 37 % 500), ["en", "de", None][i % 3], f"s{i % 7}") for i in range(101)] + odd_rows()
    out = sharded(spark, rows, 16)
    counts = [sum(r.shard == s for r in out) for s in range(16)]
    assert sum(counts) == len(rows) and max(counts) - min(counts) <= 1
    for s in range(16):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(counts[s]))
    ordered = sorted(out, key=lambda r: (r.shard, r.slot))
    assert [r.hilbert for r in ordered] == sorted(r.hilbert for r in out)


def test_few_and_no_rows(spark):
    assert sharded(spark, []) == []
    assert sorted((r.shard, r.slot) for r in sharded(spark, [(1, "a", "en", "s"), (2, None, None, None)], 16)) == [(0, 0), (8, 0)]


def test_query_digest_columns(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    out = sd.op8_sharding(spark, "/root/testdata/sf0.001").collect()
    assert len(out) == len(docs)
    for r in out:
        raw = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)


def test_files_prune_on_several_dimensions(spark, tmp_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("size", F.length("text").cast("bigint"))
    sd.write_shards(docs, f"{tmp_dir}/s", 16, ["lang", "source"], "size", ["doc_id"])
    stored = spark.read.parquet(f"{tmp_dir}/s")
    assert stored.count() == docs.count()
    boxes = stored.groupBy("shard").agg(F.count_distinct("lang").alias("l"), F.count_distinct("source").alias("s")).collect()
    assert sum(b.l for b in boxes) / 16 < 2.5 and sum(b.s for b in boxes) / 16 < 15


def cell_of(index, dims=3, bits=sd.BITS):
    """The curve the other way, a point at a time: index to coordinates."""
    x = [sum((index >> (b * dims + dims - 1 - i) & 1) << b for b in range(bits)) for i in range(dims)]
    top = x[-1] >> 1
    for i in range(dims - 1, 0, -1):
        x[i] ^= x[i - 1]
    x[0] ^= top
    for b in range(1, bits):
        low = (1 << b) - 1
        for i in reversed(range(dims)):
            if x[i] >> b & 1:
                x[0] ^= low
            else:
                swap = (x[0] ^ x[i]) & low
                x[0], x[i] = x[0] ^ swap, x[i] ^ swap
    return x


def test_whole_table_equals_brute_force(spark):
    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text", "lang", "source").toPandas()
    got = {r.doc_id: r for r in sd.op8_sharding(spark, path).collect()}
    assert len(got) == len(docs)

    def grid(column):
        values = sorted(docs[column].dropna().unique()) + ([None] if docs[column].isna().any() else [])
        return {v: (k << sd.BITS) // len(values) for k, v in enumerate(values)}

    langs, sources, order = grid("lang"), grid("source"), []
    for d in docs.itertuples():
        data = (d.text or "").encode()
        r, size = got[d.doc_id], len(data) + 1
        step = (size + 1) ** 8  # eight steps per doubling, in whole numbers
        assert (r["size"], r.text_crc32) == (size, zlib.crc32(data))
        assert cell_of(r.hilbert) == [langs[d.lang], sources[d.source], min(step.bit_length() - 1, (1 << sd.BITS) - 1)]
        order.append((r.hilbert, r.text_crc32, d.doc_id))
    for k, (_, _, doc_id) in enumerate(sorted(order)):
        shard = k * 16 // len(order)
        assert (got[doc_id].shard, got[doc_id].slot) == (shard, k - -(-shard * len(order) // 16))
