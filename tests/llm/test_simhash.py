import random
import re

import numpy as np
import xxhash
from helpers import docs_of, odd_rows, with_extra
from pyspark.sql import functions as F

from ordermart.llm import simhash as sh


def slow_print(text, n=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, radius=2):
    label = list(range(len(values)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(values):
        for j in range(i):
            if bin(a ^ values[j]).count("1") <= radius:
                label[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


def test_fingerprint_matches_definition(spark):
    for _, text, *_ in odd_rows():
        assert sh.simhash(text) == slow_print(text)
    # the hash is Spark's own
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] == np.uint64(
        xxhash.xxh64_intdigest(b"a b c", 42)).view(np.int64)


def clustered(r, n):
    """Fingerprints in chains and dense groups, and unrelated ones."""
    values = {r.getrandbits(64) for _ in range(n)} | {0, (1 << 64) - 1, 1 << 63}
    for base in list(values)[:6]:
        at = base
        for _ in range(12):
            at ^= 1 << r.randrange(64)
            if r.random() < 0.5:
                at ^= 1 << r.randrange(64)
            values.add(at)
        for _ in range(25):
            values.add(base ^ 1 << r.randrange(64) ^ 1 << r.randrange(64) ^ 1 << r.randrange(64))
    return sorted(values)


def test_bk_tree_finds_every_value_within_the_radius():
    values = np.array(clustered(random.Random(3), 300), np.uint64)
    tree = sh.BKTree(values)
    for radius in (0, 1, 2, 5):
        q, v = tree.within(values, radius)
        want = {(i, j) for i, a in enumerate(values.tolist()) for j, b in enumerate(values.tolist())
                if bin(a ^ b).count("1") <= radius}
        assert set(zip(q.tolist(), v.tolist(), strict=True)) == want and len(q) == len(want)


def test_links_and_components_equal_brute_force(spark, monkeypatch):
    values = clustered(random.Random(5), 200)
    want = components(values)
    signed = [int(np.uint64(v).view(np.int64)) for v in values]
    prints = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    for shard in (2048, 4):  # also with hot keys cut into many tree shards
        monkeypatch.setattr(sh, "SHARD", shard)
        roots = {r.node: r.root for r in sh.components(sh.links(prints)).collect()}
        got = [roots.get(v, v) for v in signed]
        assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_a_hot_key_is_many_groups_of_two_shards(spark, monkeypatch):
    monkeypatch.setattr(sh, "SHARD", 16)
    # the last 40 bits differ, the first 24 are one hot value of a block
    values = [(5 << 40) + random.Random(8).randrange(1 << 10) * 977 + i * (1 << 20) for i in range(320)]
    prints = spark.createDataFrame([(v,) for v in set(values)], "fp bigint")
    groups = sh.shard_pairs(prints).groupBy("which", "bits", "shard").agg(F.count("*").alias("n"), F.sum(F.col("home").cast("int")).alias("home"))
    hot = groups.where("n > 2").collect()
    assert hot and max(r.n for r in hot) < 5 * 16  # two shards, dealt by hash
    keys = sh.shard_pairs(prints).groupBy("which", "bits").agg(F.count_distinct("fp").alias("n"), F.count_distinct("shard").alias("groups"))
    big = keys.orderBy(F.desc("n")).first()
    assert big.n == 320 and big.groups == 20 * 21 // 2
    # any two fingerprints of that key meet, one of them at home
    for two in ([values[0], values[1]], [values[7], values[300]]):
        met = (sh.shard_pairs(prints).where(F.col("fp").isin(two)).groupBy("which", "bits", "shard")
               .agg(F.count("*").alias("n"), F.bool_or("home").alias("home")).where("n = 2 AND home"))
        assert met.count() >= 1


def test_near_dedup_on_odd_rows(spark):
    docs = with_extra(docs_of(spark, odd_rows()))
    rows = sh.near_dedup(docs).collect()
    assert len(rows) == len(odd_rows())
    prints = [slow_print(r[1]) for r in odd_rows()]
    label = components(prints)
    least = {}
    for (doc, *_), c in zip(odd_rows(), label, strict=True):
        if doc is not None:
            least[c] = min(doc, least.get(c, doc))
    want = sorted(((r[0], int(np.uint64(p).view(np.int64)), least.get(c))
                   for r, p, c in zip(odd_rows(), prints, label, strict=True)), key=str)
    assert sorted(((r.doc_id, r.fp, r.component_id) for r in rows), key=str) == want
    kept = sh.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {c for c in least.values()} | {None}


def test_empty_table(spark):
    docs = docs_of(spark, [])
    assert sh.near_dedup(docs).count() == 0 and sh.keep_one(docs).count() == 0


def test_long_chain_contracts(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "a bigint, b bigint")
    assert {(r.node, r.root) for r in sh.components(edges).collect()} == {(i, 0) for i in range(201)}
