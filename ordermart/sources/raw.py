"""Raw layer: text cells as read from a delimited file, plus lineage.

Both inputs - real CSV files (``csv_ingest``) and the driver-table binding
(``fixtures``) - pass through ``to_raw`` so that the raw tables carry the
same null semantics: every cell equal to one of the CSV reader's null tokens
is NULL, everything else is kept byte for byte (no trimming, no inference).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermart.schemas import NULL_TOKENS, RAW_COLUMNS, RAW_FILE_OF


_TOKENS_SQL = ", ".join("'" + t.replace("'", "''") + "'" for t in NULL_TOKENS)


def null_tokens_to_null(name: str) -> Column:
    """NULL when the cell is a null token (one SQL expression: one round trip
    to build, an InSet hash probe to evaluate)."""
    q = "`" + name.replace("`", "``") + "`"
    return F.expr(f"CASE WHEN {q} IN ({_TOKENS_SQL}) THEN CAST(NULL AS STRING) ELSE {q} END")


def run_timestamp() -> _dt.datetime:
    """One load timestamp per run (a transaction-start stamp, not per row)."""
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0)


def to_raw(df: DataFrame, table: str, loaded_at: _dt.datetime) -> DataFrame:
    """Declared columns in declared order, null tokens mapped, lineage added:
    the input's own source_file where it has one, else the declared name."""
    cols = [null_tokens_to_null(c).alias(c) for c in RAW_COLUMNS[table]]
    return df.select(
        *cols,
        (F.col("source_file") if "source_file" in df.columns else F.lit(RAW_FILE_OF[table])).alias("source_file"),
        F.lit(loaded_at).cast(T.TimestampType()).alias("loaded_at"),
    )


def raw_from_sources(sources, loaded_at: _dt.datetime):
    """Raw tables from source frames (a mapping; built per table on first use)."""
    from ordermart.plans.lazy import LazyMap

    return LazyMap({t: (lambda t=t: to_raw(sources[t], t, loaded_at)) for t in sources})
