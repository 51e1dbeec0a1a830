"""Helpers shared by the training-data operators."""

from __future__ import annotations

import functools
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermart.config import shared_dir

#: put before the text in the second half of the 128-bit hash pairs
SALT = "second-half"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage,
    so a lost executor costs at most the tasks since the last written table."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def guarded(rows_of):
    """For an operator (docs, ...) that gives rows of ``docs`` with its columns
    unchanged: input columns named like its helpers (``__``) go through under
    other names. Without such columns nothing is added to the plan."""
    @functools.wraps(rows_of)
    def run(docs: DataFrame, *args, **options) -> DataFrame:
        clashing = [c for c in docs.columns if c.startswith("__")]
        if not clashing:
            return rows_of(docs, *args, **options)
        prefix = "own"
        while any(c.lower().startswith(prefix) for c in docs.columns):
            prefix += "_"
        names = {c: f"{prefix}{i}" for i, c in enumerate(clashing)}
        out = rows_of(docs.withColumnsRenamed(names), *args, **options)
        return out.withColumnsRenamed({new: old for old, new in names.items()})
    return run


def numbered(df: DataFrame, order: list, name: str, column: str = "ordinal") -> DataFrame:
    """``df`` with its 0-based position in ``order``, for any number of rows.

    A range-partitioned sort is written once with (partition, index inside
    it); the counts of the earlier partitions, one row per partition, are
    added to the index. No task ever holds more than one range of rows.
    Rows that tie in ``order`` get distinct positions.
    """
    # monotonically_increasing_id is (partition << 33) + index inside the partition
    ranked = stored(df.orderBy(*order).withColumn("__at", F.monotonically_increasing_id()), name)
    part = F.shiftright("__at", 33)
    sizes = ranked.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    # a window without key over one row per partition of the sort
    before = sizes.select(
        "__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    return (ranked.join(before, part == F.col("__part"))
            .withColumn(column, F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("__at", "__part", "__before"))


def text_key(text) -> list:
    """Two 64-bit hashes of a text, as one 128-bit identity. Spark seeds the hash
    of a column with that of the column before it: the salt comes first, so the
    second half reads the text from a seed of its own. After the text it would
    be a function of the first half."""
    return [F.xxhash64(text), F.xxhash64(F.lit(SALT), text)]


def pieces_of(batch: pa.RecordBatch, column: str, max_bytes: int = 16 << 20):
    """The batch cut into slices of about ``max_bytes`` of ``column``, at
    least one row each, so that memory does not follow the rows of a batch."""
    if not batch.num_rows:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
    cuts = np.unique((np.cumsum(sizes) - 1).clip(0) // max_bytes, return_index=True)[1]
    for a, b in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def lean(rows_of):
    """An Arrow map whose tasks give the memory they freed back to the system:
    Python workers outlive their task, and stay idle beside the next stages."""
    def run(batches):
        try:
            yield from rows_of(batches)
        finally:
            pa.default_memory_pool().release_unused()
            pa.system_memory_pool().release_unused()  # and that of numpy: it trims the C heap
    return run


def coded_words(texts: pa.Array, split) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """``split`` (an Arrow kernel giving lists) applied to texts without nulls,
    and its items dictionary-coded: (code of each item, offsets of each text's
    items, distinct items)."""
    lists = split(texts)
    offsets = np.asarray(lists.offsets).astype(np.int64)
    flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    coded = flat.dictionary_encode()
    return np.asarray(coded.indices), offsets - offsets[0], coded.dictionary


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges [start, start + length)."""
    ends = np.cumsum(lengths)
    out = np.arange(ends[-1] if len(ends) else 0, dtype=np.int64)
    return out + np.repeat(starts - (ends - lengths), lengths)
