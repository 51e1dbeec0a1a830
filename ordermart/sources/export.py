"""JSON sink for the dashboard result sets.

Each export is an ordered result (months, states, top 15 / top 10 lists, one
summary row), written by Spark as one JSON array document per export (the
records layout the dashboard reads) with NULLs kept and ISO timestamps; money
is written as a JSON number. Nothing is collected to the driver or in a task.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermart.config import shared_dir

EXPORT_FILES = {
    "dashboard_summary": "dashboard_summary",
    "monthly_sales": "monthly_sales",
    "category_performance": "category_performance",
    "state_performance": "state_performance",
    "seller_performance": "seller_performance",
}

METADATA_SOURCE = "ordermart Spark analytics layer"


JSON_OPTIONS = {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSS",
                "dateFormat": "yyyy-MM-dd"}


def json_lines(df: DataFrame) -> DataFrame:
    """The ordered rows as the lines of ONE JSON array document
    (``orient=records``), no rows as ``[]``. The rows stream through in order;
    none is held back to collect the document."""
    # decimals stay exact (plain JSON numbers, never scientific notation);
    # calendar days become midnight timestamps, as in the ISO records layout
    out = df.select(*[
        F.col(f.name).cast(T.TimestampNTZType()).alias(f.name) if isinstance(f.dataType, T.DateType)
        else F.col(f.name) for f in df.schema.fields])
    rows = out.select(F.monotonically_increasing_id().alias("at"), F.to_json(F.struct(*out.columns), JSON_OPTIONS).alias("row"))
    # written once: places are then the same for the brackets and for the rows
    path = f"{shared_dir(df.sparkSession)}/export-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    rows = df.sparkSession.read.schema(rows.schema).parquet(path)
    # the brackets go by the first and last place, so no window sees all rows
    ends = rows.agg(F.min("at").alias("first"), F.max("at").alias("last"))
    lines = rows.crossJoin(F.broadcast(ends)).select("at", F.concat(
        F.when(F.col("at") == F.col("first"), "[").otherwise(","), "row",
        F.when(F.col("at") == F.col("last"), "]").otherwise("")).alias("value"))
    none = df.sparkSession.range(1).where(F.lit(0) == rows.agg(F.count(F.lit(1))).scalar())
    return lines.unionByName(none.select(F.lit(0).cast("bigint").alias("at"), F.lit("[]").alias("value"))).orderBy("at").select("value")


def write_json(df: DataFrame, path: str) -> None:
    """One JSON array file (inside ``path``, as Spark writes text): the
    document is one ordered file, so one task writes it, row by row."""
    json_lines(df).coalesce(1).write.mode("overwrite").text(path)


def export_all(spark: SparkSession, exports: dict[str, DataFrame], out_dir: str,
               generated_at: _dt.datetime | None = None) -> dict[str, str]:
    from ordermart.plans.pipeline import concurrently

    written = {name: f"{out_dir.rstrip('/')}/{EXPORT_FILES[name]}" for name in exports}
    concurrently({name: (lambda df=df, p=written[name]: write_json(df, p))
                  for name, df in exports.items()})
    ts = generated_at or _dt.datetime.now(_dt.timezone.utc)
    meta = spark.range(1).select(F.to_json(F.struct(
        F.lit(ts.isoformat()).alias("generated_at"),
        F.lit(METADATA_SOURCE).alias("source"),
    )).alias("value"))
    meta_path = f"{out_dir.rstrip('/')}/metadata"
    meta.coalesce(1).write.mode("overwrite").text(meta_path)
    written["metadata"] = meta_path
    return written
