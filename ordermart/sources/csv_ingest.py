"""CSV source files -> raw text tables.

Contract of a source file: UTF-8 (a BOM is allowed), a header row that must
equal the declared column list exactly (names, order, case), RFC-4180 quoting
with doubled quotes, CR/LF or LF line ends. Every cell is read as text (ZIP
prefixes keep their leading zeros) and the CSV null tokens become NULL.

Files are read with an explicit all-string schema, FAILFAST (a short or
malformed row aborts the load instead of being padded), and split-parallel.
Tables whose cells may hold quoted line breaks (review text) are put together
from text lines first (``csv_records``), so that one large file is many tasks.
"""

from __future__ import annotations

import csv
import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.schemas import RAW_COLUMNS, RAW_FILE_OF, raw_text_schema
from ordermart.sources.csv_records import ALL_FILES, line_counts, parsed, record_counts
from ordermart.sources.raw import to_raw

MULTILINE_TABLES = frozenset({"order_reviews"})


class SourceError(ValueError):
    """A source file is missing or does not match its declared layout."""


def source_path(source_dir: str, table: str) -> str:
    return f"{source_dir.rstrip('/')}/{RAW_FILE_OF[table]}"


def read_header(spark: SparkSession, path: str) -> list[str]:
    """The header row of a CSV file (reads only the first line)."""
    try:
        first = spark.read.options(**ALL_FILES).text(path).limit(1).collect()
    except AnalysisException as e:
        raise FileNotFoundError(f"Source file not found: {path}") from e
    if not first:
        raise SourceError(f"Source file is empty: {path}")
    line = first[0][0].lstrip("﻿").rstrip("\r")
    return next(csv.reader([line]))


def validate_header(spark: SparkSession, path: str, table: str) -> None:
    expected = list(RAW_COLUMNS[table])
    actual = read_header(spark, path)
    if actual != expected:
        raise SourceError(f"Unexpected columns in {path}. Expected {expected}, got {actual}")


def source_file(table: str, file: Column) -> Column:
    """The lineage of a row: the declared file name and, where a folder of files
    lies under that name, the path of the row's file below it."""
    return F.substr(file, F.instr(file, f"/{RAW_FILE_OF[table]}") + 1)


def read_files(spark: SparkSession, source_dir: str, table: str,
               multiline_tables=MULTILINE_TABLES) -> DataFrame:
    """A source's text cells (header validated first) and source_file."""
    path = source_path(source_dir, table)
    validate_header(spark, path, table)
    if table in multiline_tables:
        found = parsed(spark, path, raw_text_schema(table))
    else:
        found = (spark.read.schema(raw_text_schema(table)).options(**ALL_FILES)
                 .option("header", True)
                 .option("enforceSchema", False)
                 .option("mode", "FAILFAST")
                 .option("quote", '"')
                 .option("escape", '"')
                 .option("encoding", "UTF-8")
                 .csv(path)
                 .withColumn("file", F.col("_metadata.file_path")))
    return found.select(*RAW_COLUMNS[table], source_file(table, F.col("file")).alias("source_file"))


def read_source(spark: SparkSession, source_dir: str, table: str,
                multiline_tables=MULTILINE_TABLES) -> DataFrame:
    """The cells alone."""
    return read_files(spark, source_dir, table, multiline_tables).select(*RAW_COLUMNS[table])


def file_records(spark: SparkSession, source_dir: str, table: str,
                 multiline_tables=MULTILINE_TABLES) -> DataFrame:
    """source_file and source_records (data records, counted from the text lines
    before any cell is parsed)."""
    counts = record_counts if table in multiline_tables else line_counts
    found = counts(spark, source_path(source_dir, table))
    return found.select(source_file(table, F.col("file")).alias("source_file"), F.col("records").alias("source_records"))


def reconcile_files(spark: SparkSession, source_dir: str, table: str, raw: DataFrame,
                    multiline_tables=MULTILINE_TABLES) -> DataFrame:
    """source_file, source_records, loaded_rows and status of every file that has
    records or from which rows were loaded."""
    loaded = raw.groupBy("source_file").agg(F.count(F.lit(1)).alias("loaded_rows"))
    both = file_records(spark, source_dir, table, multiline_tables).join(loaded, "source_file", "full")
    counts = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("source_records", "loaded_rows")]
    status = F.when(F.col("source_records") == F.col("loaded_rows"), "PASS").otherwise("FAIL")
    return both.select("source_file", *counts).where("source_records > 0 OR loaded_rows > 0").withColumn("status", status)


def csv_sources(spark: SparkSession, source_dir: str,
                multiline_tables=MULTILINE_TABLES) -> dict[str, DataFrame]:
    """All nine source files, validated up front (all-or-nothing load)."""
    return {t: read_files(spark, source_dir, t, multiline_tables) for t in RAW_COLUMNS}


def ingest(spark: SparkSession, source_dir: str, loaded_at: _dt.datetime,
           multiline_tables=MULTILINE_TABLES) -> dict[str, DataFrame]:
    """Raw tables (text + null tokens mapped + lineage) from CSV files.

    ``multiline_tables`` names the sources whose quoted cells may contain
    line breaks; the others are read a line a record."""
    return {t: to_raw(df, t, loaded_at)
            for t, df in csv_sources(spark, source_dir, multiline_tables).items()}


def write_source(df: DataFrame, source_dir: str, table: str, delivery: Column | None = None) -> None:
    """A source file's text cells as CSV files with the declared header, such
    as ``read_source`` reads; blanks around a cell are kept. With ``delivery``
    the files lie in a folder for each of its values."""
    cells = [F.col(c) for c in RAW_COLUMNS[table]]
    parts = [] if delivery is None else [delivery.alias("delivery")]
    (df.select(*cells, *parts).write.partitionBy(*["delivery" for _ in parts])
     .option("header", True).option("escape", '"').option("emptyValue", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(source_path(source_dir, table)))
