"""Document fingerprints by winnowing.

Every k-gram of code points gets a rolling hash; of each window of ``window``
consecutive hashes the smallest is kept, the rightmost of equal ones, with its
position. Two texts that share ``window + k - 1`` code points share a window
and so a kept hash: matches of that length are guaranteed to show.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import pieces_of

K, WINDOW = 8, 8
#: bytes of text in a slice; its fingerprints are several times as large
SLICE = 2 << 20
#: base of the rolling hash and the multipliers of its finishing mix (odd 64-bit constants)
BASE, MIX1, MIX2 = 0x9E3779B97F4A7C15, np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """32-bit hashes of all k-grams (of the whole text if it is shorter)."""
    k = min(k, len(codes))
    one = codes.astype(np.uint64) + np.uint64(1)
    # hashes of 1, 2, 4, ... codes join into those of k: the binary digits of k from left to right
    h, done = one, 1
    for bit in bin(k)[3:]:
        h = h[:len(h) - done] * np.uint64(pow(BASE, done, 1 << 64)) + h[done:]
        done *= 2
        if bit == "1":
            h = h[:len(h) - 1] * np.uint64(BASE) + one[done:]
            done += 1
    h = (h ^ h >> np.uint64(33)) * MIX1
    h = (h ^ h >> np.uint64(33)) * MIX2
    return (h ^ h >> np.uint64(33)) >> np.uint64(32)


def winnow(text: str, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Kept hashes (32 bits) and their positions, in order of position."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(codes):
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    hashes = gram_hashes(codes, k)
    # hash above, mirrored position below: the least is the rightmost least hash
    keys = hashes << np.uint64(32) | np.uint64(0xFFFFFFFF) - np.arange(len(hashes), dtype=np.uint64)
    span, low = 1, keys
    window = min(window, len(keys))
    while span < window:  # least of each run of span, then of twice as many
        step = min(span, window - span)
        low = np.minimum(low[:len(low) - step], low[step:])
        span += step
    kept = low[np.append(True, low[1:] != low[:-1])]
    positions = (np.uint64(0xFFFFFFFF) - (kept & np.uint64(0xFFFFFFFF))).astype(np.int64)
    return (kept >> np.uint64(32)).astype(np.uint32), positions


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of two sets of kept hashes; two empty ones are alike."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return shared / (len(both) - shared)


def digest(hashes: np.ndarray) -> str:
    return hashes.astype(">u4").tobytes().hex()


def fingerprint(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """doc_id, n_chars, hashes and positions of every whole text.

    Null text: empty, no hashes. A text shorter than k is one gram. Null and
    repeated doc_ids pass through. An empty table gives no rows. Other columns
    are not read."""
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            for part in pieces_of(batch, "text"):
                texts = [t or "" for t in part.column("text").to_pylist()]
                found = [winnow(t, k, window) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
                     pa.array([h.astype(np.int64) for h, _ in found], pa.list_(pa.int64())),
                     pa.array([p for _, p in found], pa.list_(pa.int64()))], names=["doc_id", "n_chars", "hashes", "positions"])

    return narrow.mapInArrow(run, "doc_id bigint, n_chars bigint, hashes array<bigint>, positions array<bigint>")


def edited(text: str, following: str) -> str:
    """The last third of the text replaced by the start of the following one."""
    m = len(text) // 3
    return text[:len(text) - m] + following[:m]


COMPARED = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                      ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _compare(batches, k: int, window: int):
    """Rows come in blocks, by descending doc_id; each row's next document is
    the row after it, and a block's last row (``lead``) is only that. A slice
    of texts and one text before it are in memory at a time."""
    held = None  # doc_id, text and hashes of the row before, if it waits for its next document
    for batch in batches:
        for part in pieces_of(batch, "text", SLICE):
            columns: list[list] = [[] for _ in COMPARED]
            ids, leads, texts = part.column("doc_id"), part.column("lead"), part.column("text")
            for i in range(part.num_rows):
                text = texts[i].as_py() or ""
                own = winnow(text, k, window)[0]
                if held is not None:
                    doc, previous, kept = held
                    changed = edited(previous, text)
                    other = winnow(changed, k, window)[0]
                    row = (doc, len(previous), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                           digest(kept), digest(other), likeness(kept, other), likeness(kept, own))
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                held = None if leads[i].as_py() else (ids[i].as_py(), text, own)
            if columns[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, COMPARED, strict=True)], schema=COMPARED)


def compare_next(docs: DataFrame, blocks: int | None = None, k: int = K, window: int = WINDOW) -> DataFrame:
    """Fingerprints of each document and of its text edited with the next one
    by descending doc_id (after the last: the first), and their likeness.

    doc_ids are cut into ``blocks`` at quantiles; a block also gets the first row
    of the block below, so every pair meets in one task and the texts are
    shuffled once. A doc_id (or null) of more rows than a block has is cut on
    by the hash of the text. Null text: empty. Rows with equal doc_ids follow
    each other by the hash of their text; null doc_ids come last. Rows repeated
    with one doc_id and text are one block, read in a stream. Very long texts
    are read whole. The only row of a table is its own next; an empty table
    gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                         F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # several blocks a task, so that the hash of the block deals them evenly
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = blocks or 8 * partitions
    ids = narrow.groupBy("doc_id").agg(F.count("*").alias("n"))
    size = ids.agg(F.sum("n")).first()[0] or 0
    # at most ``blocks`` ids have more rows than a block: block of its own, in parts
    large = {r["doc_id"]: -(-r["n"] * blocks // size) for r in ids.where(F.col("n") * blocks > size).collect()} if size else {}
    known = narrow.select("doc_id").where("doc_id IS NOT NULL")
    cuts = known.agg(F.percentile_approx("doc_id", [i / blocks for i in range(1, blocks)], 10000)).first()[0] or []
    alone = [x for i in large if i is not None for x in (i, min(i + 1, (1 << 63) - 1))]
    cuts = np.unique(np.array([*cuts, *alone], np.int64))

    @pandas_udf("bigint")
    def block(ids: pd.Series, none: pd.Series, hashes: pd.Series) -> pd.Series:
        # descending: the largest doc_ids are block 0, null ones the last; the parts of a block by ascending hash
        at = len(cuts) - np.searchsorted(cuts, ids.to_numpy(np.int64), "right")
        at = np.where(none, len(cuts) + 1, at).astype(np.int64) << 32
        for doc_id, parts in large.items():
            own = (none if doc_id is None else (ids == doc_id) & ~none).to_numpy(bool)
            share = (hashes[own].to_numpy(np.int64).astype(np.float64) + 2.0 ** 63) / 2.0 ** 64
            at[own] += np.minimum((share * parts).astype(np.int64), parts - 1)
        return pd.Series(at)

    hashed = narrow.withColumn("hash", F.xxhash64("text"))
    placed = hashed.withColumn("block", block(F.coalesce("doc_id", F.lit(0)), F.isnull("doc_id"), "hash"))
    # the head of a block, the row that follows the block above: one row a block, at most three times ``blocks``
    first = F.min(F.struct(F.bitwise_not("doc_id").alias("down"), "hash"))
    heads = placed.groupBy("block").agg(first.alias("first"))
    around = Window.orderBy("block")
    heads = heads.select(F.col("block").alias("b"), F.bitwise_not("first.down").alias("d"), F.col("first.hash").alias("h"),
                         F.coalesce(F.lag("block").over(around), F.lit(-1)).alias("above"))
    last = heads.agg(F.max("b")).first()[0]
    above = F.when(F.col("above") >= 0, F.col("above")).otherwise(F.lit(-1 if last is None else last))
    texts = placed.join(F.broadcast(heads), (F.col("block") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("d"))
                        & (F.col("hash") == F.col("h")))
    lead = texts.groupBy(above.cast("bigint").alias("block"), "doc_id", "hash").agg(F.min("text").alias("text"))
    rows = placed.select("block", "doc_id", "hash", "text", F.lit(False).alias("lead")).unionByName(
        lead.select("block", "doc_id", "hash", "text", F.lit(True).alias("lead")))
    return (rows.repartition(partitions, "block")
            .sortWithinPartitions("block", "lead", F.col("doc_id").desc_nulls_last(), "hash", "text")
            .select("doc_id", "text", "lead")
            .mapInArrow(lambda it: _compare(it, k, window),
                        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
                        "edited_fingerprint string, near_edited double, near_next double"))


def op9_winnowing(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return compare_next(spark.read.parquet(f"{sf_dir}/documents.parquet"))
