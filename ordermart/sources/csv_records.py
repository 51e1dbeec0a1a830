"""Records of CSV files with quoted line breaks, read split-parallel.

A line break ends a record where the number of quotes before it is even (a
doubled quote counts two). That number is a running sum over the file, so it
is taken in two steps, as any distributed prefix sum:

1. quotes of each split of a file, one row per split, summed over the splits
   before it;
2. inside a split, the running sum of its lines, from the split's own start.

Lines are then grouped to records inside their split. The lines before a
split's first record belong to the last record that began in an earlier split
and are put behind it, one row per split. Texts are exchanged once; no task
holds more than the lines of a split, and one file is as many tasks as it has
splits. Cells are parsed by ``from_csv``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOM = "﻿"
# every file below a folder is data; a subfolder's name adds no column (were some
# named key=value, the files beside them would be left out)
ALL_FILES = {"recursiveFileLookup": "true"}
CSV = {"mode": "FAILFAST", "quote": '"', "escape": '"', "encoding": "UTF-8"}


def lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block (first byte of the split), at (order of the lines in the
    split), value (a line, its CR kept) and quotes."""
    return (spark.read.options(**ALL_FILES).option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("at"), "value")
            .withColumn("quotes", F.expr("length(value) - length(replace(value, '\"', ''))")))


def _splits(found: DataFrame) -> DataFrame:
    """A row per split: quotes of the file before it, and its lines. A file
    whose quotes do not pair up has no records: that is an error."""
    sums = found.groupBy("file", "block").agg(F.sum("quotes").alias("own"), F.count(F.lit(1)).alias("n"))
    of_file = Window.partitionBy("file")
    running = F.sum("own").over(of_file.orderBy("block"))
    odd = F.sum("own").over(of_file) % 2 == 1
    unpaired = F.raise_error(F.concat(F.lit("Unpaired quote in "), F.col("file"))).cast("bigint")
    return sums.select("file", "block", "n", F.when(odd, unpaired).otherwise(running - F.col("own")).alias("before"))


def _joined(rows) -> F.Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(rows)), lambda r: r["value"]), "\n")


def _marked(found: DataFrame) -> DataFrame:
    """The lines, numbered by the record of the split they belong to; 0 for
    those of a record that began in an earlier split."""
    split = Window.partitionBy("file", "block")
    so_far = split.orderBy("at")
    sums = _splits(found)
    both = found.join(sums, ["file", "block"], "left")
    even = (F.col("before") + F.sum("quotes").over(so_far) - F.col("quotes")) % 2 == 0
    marked = both.withColumn("starts", even.cast("int")).withColumn("lines", F.count(F.lit(1)).over(split))
    # both readings of the file must have met the same splits
    moved = F.raise_error(F.lit("The splits of a file changed while it was read; read it again")).cast("bigint")
    same = F.col("before").isNotNull() & (F.col("n") == F.col("lines"))
    return marked.withColumn("record", F.when(same, F.sum("starts").over(so_far)).otherwise(moved))


def records(spark: SparkSession, path: str) -> DataFrame:
    """file, block, record (from 1 inside the split where it begins) and text
    of every record, header and blank ones included, without its line end."""
    marked = _marked(lines(spark, path)).select("file", "block", "at", "value", "record")
    begun = marked.where("record > 0").groupBy("file", "block", "record").agg(_joined(F.struct("at", "value")).alias("text"))
    heads = marked.where("record = 0").groupBy("file", "block").agg(_joined(F.struct("at", "value")).alias("value"))
    # one row per split: its last record, and the split whose last record its head goes on
    last = marked.groupBy("file", "block").agg(F.max("record").alias("last"))
    owner = F.last(F.when(F.col("last") > 0, F.struct(F.col("block").alias("owner"), "last")), ignorenulls=True).over(
        Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    owned = heads.join(last.select("file", "block", owner.alias("to")), ["file", "block"])
    rest = (owned.groupBy(F.col("file").alias("of"), F.col("to.owner").alias("owner"), F.col("to.last").alias("last"))
            .agg(_joined(F.struct("block", "value")).alias("rest")))
    whole = begun.join(rest, (F.col("file") == F.col("of")) & (F.col("block") == F.col("owner")), "left")
    text = F.when(F.col("record") == F.col("last"), F.concat_ws("\n", "text", "rest")).otherwise(F.col("text"))
    return whole.select("file", "block", "record", F.regexp_replace(text, "\r$", "").alias("text"))


def data_records(spark: SparkSession, path: str, header: list[str] | None = None) -> DataFrame:
    """``records`` without each file's header and without blank lines. With
    ``header`` every file's first record must be just these names."""
    first = (F.col("block") == 0) & (F.col("record") == 1)
    dropped = F.lit(False)
    if header is not None:
        names = F.regexp_replace("text", f'["{BOM}]', "")
        wrong = F.raise_error(F.concat(F.lit("Unexpected columns in "), F.col("file"), F.lit(": "), names)).cast("boolean")
        dropped = F.when(names == ",".join(header), False).otherwise(wrong)
    return records(spark, path).where(F.when(first, dropped).otherwise(F.col("text") != ""))


def parsed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The cells of all data records of the file, or folder of files, as text,
    and file."""
    ddl = schema.simpleString()[len("struct<"):-1].replace(":", " ")
    found = data_records(spark, path, schema.fieldNames())
    return found.select(F.from_csv("text", ddl, CSV).alias("cells"), "file").select("cells.*", "file")


def record_counts(spark: SparkSession, path: str) -> DataFrame:
    """file and records (data records, counted before any cell is parsed)."""
    return data_records(spark, path).groupBy("file").agg(F.count(F.lit(1)).alias("records"))


def line_counts(spark: SparkSession, path: str) -> DataFrame:
    """The same of files that hold a record a line."""
    found = spark.read.options(**ALL_FILES).text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    return found.where(F.col("value").rlike(r"[^\x00-\x20]")).groupBy("file").agg((F.count(F.lit(1)) - 1).alias("records"))
