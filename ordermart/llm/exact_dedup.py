"""Exact dedup against a persistent digest index.

The index is a Parquet table bucketed and sorted by the SHA-256 of the text,
one row per distinct text ever seen. New documents are reduced to one row per
digest (partial aggregation first, so a text with a third of all rows is one
row per task), anti-joined to the index by a sort-merge join that reads the
index without an exchange, and the digests it lacks are appended.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import guarded, scratch_path, stored

INDEX_COLUMNS = "digest BINARY, keep_id BIGINT"


def digests(docs: DataFrame) -> DataFrame:
    """doc_id and the SHA-256 of each whole text; a null text counts as empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"))


class DigestIndex:
    """The index at ``path``; an existing one is attached, also by a later
    session. ``buckets`` is fixed when it is created: about one per 128 MB of
    digests expected in the end."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = f"digest_index_{hashlib.md5(path.encode()).hexdigest()}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({INDEX_COLUMNS}) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'")

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def unseen(self, batch: DataFrame) -> DataFrame:
        """One row per digest of ``batch`` that the index lacks: of equal
        texts the row with the largest doc_id (null only if all are null)."""
        groups = batch.groupBy("digest").agg(F.max("doc_id").alias("keep_id"))
        return groups.join(self.read().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, batch: DataFrame) -> None:
        """Adds what ``batch`` has and the index lacks, a file per bucket."""
        fresh = self.unseen(batch).select("digest", "keep_id")
        fresh.repartition(self.buckets, "digest").write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)


def dedup(docs: DataFrame, index: DigestIndex, batches: int = 2) -> DataFrame:
    """Adds ``docs`` to the index and tells for each row which row stays.

    The batches go in by descending doc_id, so of equal new texts the row with
    the largest doc_id is indexed, whichever batch holds the others. A text
    that the index had before is a copy whatever its doc_id. Rows: doc_id,
    digest, keep_id, group_size (rows of ``docs`` with that text), kept.

    Null text: empty. Null doc_id: stays only if all doc_ids of its text are
    null. Rows repeated with one doc_id and text share the decision. An empty
    table adds nothing and gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    found = stored(digests(docs), "digests")
    cuts = [float("inf"), *sorted(found.approxQuantile("doc_id", [k / batches for k in range(1, batches)], 0.01),
                                  reverse=True)] if batches > 1 else [float("inf")]
    for k, top in enumerate(cuts):
        low = cuts[k + 1] if k + 1 < len(cuts) else None
        part = found
        if top != float("inf"):
            part = part.where(F.col("doc_id").isNull() | (F.col("doc_id") <= F.lit(int(top))))
        if low is not None:
            part = part.where(F.col("doc_id") > F.lit(int(low)))
        index.append(part)
    sizes = found.groupBy("digest").agg(F.count("*").alias("group_size"))
    groups = stored(sizes.join(index.read(), "digest"), "digest-groups")
    # both sides come from files: the join deals them anew, and a hot text is split
    out = found.join(groups, "digest")
    return out.select("doc_id", "digest", "keep_id", "group_size",
                      F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"))


@guarded
def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without exact copies, columns unchanged: of equal texts the row
    with the largest doc_id; of rows that also share the doc_id, any one."""
    spark = docs.sparkSession
    index = DigestIndex(spark, scratch_path(spark, "digest-index"))
    index.append(digests(docs))
    names = docs.columns
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    marked = docs.withColumns({"__digest": F.unhex(F.sha2(text, 256)), "__id": F.col("doc_id").cast("bigint")})
    same = digests(docs).groupBy("digest", "doc_id").agg(F.count("*").alias("__ties"))
    keep = stored(index.read().alias("i").join(
        same.alias("s"), (F.col("i.digest") == F.col("s.digest")) & F.col("i.keep_id").eqNullSafe(F.col("s.doc_id")))
        .select(F.col("i.digest").alias("__d"), F.col("i.keep_id").alias("__k"), "__ties"), "digest-kept")
    left = marked.join(keep, (F.col("__digest") == F.col("__d")) & F.col("__id").eqNullSafe(F.col("__k")))
    # repeated rows are rare; only they are dealt by digest to keep one of each
    once = left.where("__ties = 1").select(*names)
    return once.unionByName(left.where("__ties > 1").dropDuplicates(["__digest"]).select(*names))


def op3_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Exact copies over all documents, through a fresh index."""
    index = DigestIndex(spark, scratch_path(spark, "digest-index"))
    found = dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), index)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP3_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
