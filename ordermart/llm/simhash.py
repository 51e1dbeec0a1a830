"""SimHash near-dedup with BK-trees.

Fingerprints are made in one map. Distinct fingerprints are blocked so that
no pair within the radius is missed: 64 bits in three blocks, of which a pair
at two or fewer differing bits shares one whole block; the other bits in three
blocks again, of which the pair shares one too. Each of the nine (block,
sub-block) keys fixes 35 or 36 bits, so that at 10^11 documents a key still
holds a handful of unrelated fingerprints.

The fingerprints of a key are dealt to tree shards of bounded size. Each shard
builds a BK-tree (children keyed by their Hamming distance to the parent) and
answers every fingerprint of its key, following only edges within the radius.
The trees go where the key's fingerprints are, by a shuffle: the forest grows
with the data, so it isn't broadcast whole. A shard gives one link from a
fingerprint to each cluster it touches, not all pairs; connected components
then come from alternating star contraction.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import guarded, lean, pieces_of, stored

#: (shift, width) of the blocks, and of the sub-blocks of what is left
BLOCKS = ((0, 21), (21, 21), (42, 22))
SHARD = 2048


def simhash(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of the word shingles of a whole text."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = min(shingle, len(words))
    h = xxhash.xxh64_intdigest
    a, b = starts[:len(words) - n + 1].tolist(), ends[n - 1:].tolist()
    bits, step = np.zeros(64, np.int64), 1 << 16
    for k in range(0, len(a), step):
        hashes = np.fromiter((h(line[i:j], 42) for i, j in zip(a[k:k + step], b[k:k + step], strict=True)), np.uint64)
        # uint8 sums of up to 255 rows stay exact and fast
        spread = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        whole = len(spread) // 255 * 255
        bits += spread[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        bits += spread[whole:].sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(a)).view(">u8")[0])


def _fingerprints(batches, shingle: int):
    for batch in batches:
        for part in pieces_of(batch, "text"):
            prints = np.array([simhash(t, shingle) for t in part.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(prints.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id and fp (the 64 bits as a signed long) of every document."""
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(lean(lambda it: _fingerprints(it, shingle)), "doc_id bigint, fp bigint")


def _bits(column, shift: int, width: int):
    return F.shiftrightunsigned(column, shift).bitwiseAND(F.lit((1 << width) - 1))


def block_keys(fp) -> list:
    """The nine keys as structs (which, bits)."""
    keys = []
    for i, (shift, width) in enumerate(BLOCKS):
        # what is left of the 64 bits, moved together
        low = fp.bitwiseAND(F.lit((1 << shift) - 1)) if shift else F.lit(0).cast("bigint")
        high = F.shiftrightunsigned(fp, shift + width) if shift + width < 64 else F.lit(0).cast("bigint")
        rest, left = low.bitwiseOR(F.shiftleft(high, shift)), 64 - width
        for j in range(3):
            a, b = left * j // 3, left * (j + 1) // 3
            keys.append(F.struct(F.lit(3 * i + j).alias("which"),
                                 F.shiftleft(_bits(fp, shift, width), b - a).bitwiseOR(_bits(rest, a, b - a)).alias("bits")))
    return keys


class BKTree:
    """BK-tree over distinct 64-bit values, searched for many values at once."""

    def __init__(self, values: np.ndarray):
        self.values, n = values, len(values)
        parent, edge = np.full(n, -1), np.zeros(n, np.int64)
        # all values descend together: those that share a parent and distance
        # go on below the first of them
        at, todo = np.zeros(n, np.int64), np.arange(1, n)
        while len(todo):
            d = np.bitwise_count(values[todo] ^ values[at[todo]]).astype(np.int64)
            _, first, group = np.unique(at[todo] * 65 + d, return_index=True, return_inverse=True)
            lead = todo[first]
            parent[lead], edge[lead] = at[lead], d[first]
            at[todo] = lead[group]
            todo = np.delete(todo, first)
        # children of a node lie together, by edge: an edge range is a slice
        self.key = np.where(parent >= 0, parent * 65 + edge, -1)
        self.order = np.argsort(self.key, kind="stable")
        self.sorted = self.key[self.order]

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (index of the query, index of the value) within the radius."""
        got = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        for start in range(0, len(queries), 4096):  # bounds the frontier
            q = np.arange(start, min(start + 4096, len(queries)))
            node = np.zeros(len(q), np.int64)
            while len(q):
                d = np.bitwise_count(queries[q] ^ self.values[node]).astype(np.int64)
                hit = d <= radius
                got.append((q[hit], node[hit]))
                low = np.searchsorted(self.sorted, node * 65 + np.maximum(d - radius, 0), "left")
                high = np.searchsorted(self.sorted, node * 65 + np.minimum(d + radius, 64), "right")
                n = high - low
                ends = np.cumsum(n)
                slots = np.arange(ends[-1]) + np.repeat(low - (ends - n), n)
                q, node = np.repeat(q, n), self.order[slots]
        return tuple(np.concatenate(x) for x in zip(*got, strict=True))


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable over the pairs, for each of n nodes."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def links_of(home: np.ndarray, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join each query to every cluster of ``home`` it touches, and
    the members of a cluster to its first one."""
    tree = BKTree(home)
    a, b = tree.within(home, radius)
    root = _roots(len(home), a, b)
    inner = root != np.arange(len(home))
    if queries is home:
        return home[inner], home[root[inner]]
    q, v = tree.within(queries, radius)
    touched = np.unique(np.stack([q, root[v]]), axis=1) if len(q) else np.empty((2, 0), np.int64)
    x, y = queries[touched[0]], home[touched[1]]
    far = x != y
    return np.concatenate([home[inner], x[far]]), np.concatenate([home[root[inner]], y[far]])


def _tree_links(batches, radius: int):
    """Rows come sorted by (which, bits, shard); a group may cross batches."""
    names = ["which", "bits", "shard", "fp", "home"]

    def solve(cols):
        which, bits, shard, fp, home = cols
        new = np.ones(len(fp), bool)
        new[1:] = (which[1:] != which[:-1]) | (bits[1:] != bits[:-1]) | (shard[1:] != shard[:-1])
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(fp))
        left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        pair = ends - starts == 2
        a, b = starts[pair], starts[pair] + 1
        near = (np.bitwise_count((fp[a] ^ fp[b]).view(np.uint64)) <= radius) & (home[a] | home[b])
        left.append(fp[a][near])
        right.append(fp[b][near])
        for s, e in zip(starts[~pair].tolist(), ends[~pair].tolist(), strict=True):
            values, own = fp[s:e].view(np.uint64), home[s:e]
            if own.any() and e - s > 1:
                inside = np.unique(values[own])
                x, y = links_of(inside, inside if own.all() else np.unique(values[~own]), radius)
                left.append(x.view(np.int64))
                right.append(y.view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], names=["a", "b"])

    held: list[np.ndarray] | None = None
    for batch in batches:
        cols = [np.asarray(batch.column(n)) if n != "home" else batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        if not len(cols[0]):
            continue
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
        last = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1]) & (cols[2] == cols[2][-1])
        cut = int(np.argmax(last))  # the last group may go on in the next batch
        if cut:
            yield solve([c[:cut] for c in cols])
        held = [c[cut:] for c in cols]
    if held is not None:
        yield solve(held)


def shard_pairs(prints: DataFrame) -> DataFrame:
    """which, bits, shard, fp and home: the fingerprints of a key are dealt to
    shards, and each two shards meet in a group of their own, the tree of one
    (home) to be asked for all of the other. A group holds two shards at most,
    whatever the key; a key of n fingerprints sends each to ceil(n / SHARD) groups."""
    keyed = prints.select("fp", F.explode(F.array(*block_keys(F.col("fp")))).alias("k")).select("fp", "k.which", "k.bits")
    full = keyed.groupBy("which", "bits").agg(F.count("*").alias("n")).where("n > 1")
    shards = F.ceil(F.col("n") / SHARD).cast("int")
    dealt = keyed.join(full, ["which", "bits"]).withColumn("shards", shards)
    asked = dealt.select("which", "bits", "fp", "shards", F.pmod(F.xxhash64("fp"), "shards").cast("int").alias("own"),
                         F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("other"))
    two = F.least("own", "other").cast("bigint") * F.col("shards") + F.greatest("own", "other")
    return asked.select("which", "bits", two.alias("shard"), "fp", (F.col("own") <= F.col("other")).alias("home"))


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` whose closure is that
    of all pairs at ``radius`` (at most 2) or fewer differing bits."""
    if radius > 2:
        raise ValueError("three blocks find pairs of at most two differing bits")
    return (shard_pairs(prints).repartition("which", "bits", "shard").sortWithinPartitions("which", "bits", "shard")
            .mapInArrow(lean(lambda it: _tree_links(it, radius)), "a bigint, b bigint").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the
    smallest node reachable. Alternating large and small stars, each round
    written to the shared folder, until a round changes nothing."""
    big, small = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now = stored(edges.where("a <> b").select(big, small).distinct(), "links")

    def mark(df):
        return df.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()

    seen = mark(now)
    while seen[0]:
        both = now.union(now.select("b", "a")).toDF("a", "b")
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large, "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        star = large.join(least, "a")
        now = stored(star.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                     .union(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        before, seen = seen, mark(now)
        if seen == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_dedup(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id reachable over fingerprints
    linked at ``radius`` or fewer differing bits, itself included).

    Null text: empty; a text without words has fingerprint 0 and links like
    any other. Null doc_ids are members, but name a component (as null) only
    if all its doc_ids are null. Repeated rows share fingerprint and
    component. An empty table gives no rows. Other columns are not read.
    """
    prints = stored(fingerprints(docs, shingle), "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = stored(components(links(distinct, radius)), "roots")
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    # written, so that the join below deals both sides anew and can split a hot fingerprint
    named = stored(rooted.join(least, "root").select("fp", "component_id"), "components")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


@guarded
def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one document of each group, columns unchanged: the one
    with the smallest doc_id. The doc_id names a row: rows that share one go
    or stay together, and rows without one always stay."""
    found = near_dedup(docs, shingle, radius)
    # the doc_ids that go are far fewer than those that stay, so the texts need
    # no shuffle while Spark finds their list small enough to broadcast
    gone = stored(found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.bool_or(F.col("doc_id") == F.col("component_id")).alias("head"))
                  .where("NOT head").select(F.col("doc_id").alias("__gone")), "near-copies")
    return docs.join(gone, F.col("doc_id").cast("bigint") == F.col("__gone"), "left_anti")


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    """Near copies over all documents: three-word shingles, two bits."""
    found = near_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
