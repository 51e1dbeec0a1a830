"""Sharding along a Hilbert curve.

Each metadata dimension is quantised to a grid coordinate, the coordinates are
mapped to their index on a Hilbert curve, the rows are sorted by that index by
a range-partitioned sort, and the order is cut into runs of equal row counts.
Neighbours on the curve are neighbours in every dimension, so each shard covers
a small box of the grid and its files are pruned by filters on any of them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import numbered, stored

BITS = 8


def hilbert_index(axes: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index on the Hilbert curve of points ``axes`` (dimensions x points)."""
    x = axes.astype(np.int64).copy()
    n = len(x)
    # undo the rotations of the sub-cubes, from the coarsest bit down
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            index = index << 1 | x[i] >> b & 1
    return index


def by_rank(docs: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """``docs`` with __q_<column>: the rank of the value among the distinct
    values, null last, scaled to the grid."""
    values = docs.select(F.col(column).alias("__v")).distinct()
    ranked = numbered(values, [F.col("__v").asc_nulls_last()], f"rank-{column}")
    count = values.count()
    table = stored(ranked.select("__v", F.floor(F.col("ordinal") * F.lit(1 << bits) / F.lit(max(count, 1))).cast("int")
                                 .alias(f"__q_{column}")), f"grid-{column}")
    return docs.join(table, F.col(column).eqNullSafe(F.col("__v"))).drop("__v")


def by_magnitude(column, bits: int = BITS):
    """Grid coordinate of a non-negative size: eight steps per doubling."""
    return F.least(F.floor(F.log2(column.cast("double") + 1) * 8), F.lit((1 << bits) - 1)).cast("int")


def hilbert_shards(docs: DataFrame, shards: int, ranked: list[str], size: str, ties: list[str]) -> DataFrame:
    """``docs`` with hilbert, shard and slot (gapless from 0 in the shard).

    Dimensions: the columns ``ranked`` by rank of their values (null: last),
    and ``size`` by magnitude. Rows of one cell are ordered by ``ties``, nulls
    first; rows equal in all of them take neighbouring slots in any order. The
    number of rows of any two shards differs by one at most, so with fewer rows
    than shards some shards stay empty; an empty table gives no rows.
    """
    for column in ranked:
        docs = by_rank(docs, column)
    grid = [F.col(f"__q_{c}") for c in ranked] + [by_magnitude(F.col(size))]

    @pandas_udf("bigint")
    def curve(axes: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert_index(axes.to_numpy().T))

    placed = docs.withColumn("hilbert", curve(F.struct(*[g.alias(f"x{i}") for i, g in enumerate(grid)])))
    placed = placed.drop(*[f"__q_{c}" for c in ranked])
    out = numbered(placed, ["hilbert", *ties], "hilbert")
    n = max(out.count(), 1)
    # a shard starts at the first ordinal with ordinal * shards >= shard * n
    start = F.expr(f"(shard * {n}L + {shards - 1}) div {shards}")
    return out.withColumn("shard", F.expr(f"int(ordinal * {shards} div {n}L)")).withColumn(
        "slot", F.col("ordinal") - start).drop("ordinal")


def write_shards(docs: DataFrame, path: str, shards: int, ranked: list[str], size: str, ties: list[str]) -> None:
    """The documents stored one folder per shard, in curve order inside."""
    out = hilbert_shards(docs, shards, ranked, size, ties)
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op8_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 16 shards along a curve over language, source and size."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", "lang", "source", (F.octet_length(text) + 1).cast("bigint").alias("size"),
                       F.crc32(F.encode(text, "utf-8")).alias("text_crc32"))
    out = hilbert_shards(rows, 16, ["lang", "source"], "size", ["text_crc32", "doc_id"])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "hilbert")
