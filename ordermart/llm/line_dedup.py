"""Line dedup by distinct-site spread.

For every distinct line a HyperLogLog sketch of the sites it is on is built
map-side and merged by aggregation. Lines whose estimate is clear of the
threshold by more than the sketch's error are decided by it; those near it get
exact distinct counts. Lines on ``min_sites`` or more sites are boilerplate
and removed from every document.

A line is known by 128 bits of hash, so only hashes and sites are shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, text_key

MIN_SITES, LG_K = 5, 12


def _lines(docs: DataFrame) -> DataFrame:
    """One row per non-blank line: its place, its hashes, its text's hashes."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    site = F.coalesce(F.col("source").cast("string"), F.lit("\0"))
    t1, t2 = text_key(text)
    cut = docs.select(site.alias("site"), t1.alias("t1"), t2.alias("t2"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    line = F.trim("line")
    h1, h2 = text_key(line)
    return cut.where(F.length(line) > 0).select("site", "t1", "t2", "pos", h1.alias("h1"), h2.alias("h2"))


def spread_lines(docs: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """(h1, h2) of the lines on at least ``min_sites`` distinct sites."""
    lines = _lines(docs).select("h1", "h2", "site")
    # five standard errors of the sketch, and never less than one site
    band = max(1, math.ceil(min_sites * 5 * 1.04 / math.sqrt(1 << lg_k)))
    sketched = stored(lines.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", lg_k).alias("sites"))
                      .select("h1", "h2", F.hll_sketch_estimate("sites").alias("estimate"))
                      .where(F.col("estimate") >= min_sites - band), "line-spread")
    sure = sketched.where(F.col("estimate") > min_sites + band).select("h1", "h2")
    near = sketched.where(F.col("estimate") <= min_sites + band).select("h1", "h2")
    exact = (lines.join(near, ["h1", "h2"], "left_semi").groupBy("h1", "h2")
             .agg(F.count_distinct("site").alias("n")).where(F.col("n") >= min_sites).select("h1", "h2"))
    return sure.union(exact)


def dedup_lines(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with text (boilerplate lines removed), n_lines (before) and
    n_removed; the site of a document is its source.

    Lines are compared without blanks at their ends; blank lines are never
    boilerplate. Null text: empty, one blank line. A null source is a site of
    its own. A text whose lines all go is left empty. Null or repeated doc_ids
    pass through. An empty table gives no rows. Columns named like the results
    are replaced, others kept.
    """
    spread = stored(spread_lines(docs, min_sites), "boilerplate")
    # the places to remove, once for all copies of a text
    gone = (_lines(docs).select("t1", "t2", "pos", "h1", "h2").join(spread, ["h1", "h2"])
            .groupBy("t1", "t2").agg(F.collect_set("pos").alias("__gone")))
    gone = stored(gone, "removed-lines").select(F.col("t1").alias("__t1"), F.col("t2").alias("__t2"), "__gone")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    k1, k2 = text_key(text)
    joined = docs.withColumns({"__k1": k1, "__k2": k2}).join(
        gone, (F.col("__k1") == F.col("__t1")) & (F.col("__k2") == F.col("__t2")), "left")
    lines = F.split(text, "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone"))
    joined = joined.withColumns({
        "n_lines": F.size(lines).cast("bigint"),
        "n_removed": F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("bigint"),
        "__text": F.when(F.col("__gone").isNull(), text).otherwise(
            F.array_join(F.transform(kept, lambda i: F.element_at(lines, i + 1)), "\n"))})
    return joined.withColumn("text", F.col("__text")).drop("__k1", "__k2", "__t1", "__t2", "__gone", "__text")


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents without the lines found on five or more sources."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return dedup_lines(docs).select("doc_id", "text", "n_lines", "n_removed")


OP1_SQL = """
WITH whole AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, chr(1)) AS site,
                      string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
     line AS (SELECT r, doc_id, site, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM whole),
     spread AS (SELECT trim(line, ' ') AS line FROM line WHERE trim(line, ' ') <> ''
                GROUP BY 1 HAVING count(DISTINCT site) >= 5)
SELECT doc_id, coalesce(string_agg(l.line, chr(10) ORDER BY i) FILTER (s.line IS NULL), '') AS text,
       count(*) AS n_lines, count(s.line) AS n_removed
FROM line l LEFT JOIN spread s ON trim(l.line, ' ') = s.line GROUP BY r, doc_id
"""
