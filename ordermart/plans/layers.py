"""Lazy layer graph: source files -> raw -> staging -> analytics -> views.

``Layers`` only wires DataFrames together; nothing runs until a result is
consumed. The same functions back the published pipeline (which writes each
layer and re-reads it) and the registered queries (which compose the whole
chain into one plan so that Catalyst prunes it to what the query needs).
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ordermart.operators import marts, quality, reports, staging
from ordermart.sources import fixtures
from ordermart.sources.raw import raw_from_sources, run_timestamp


class Layers:
    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame],
                 run_ts: _dt.datetime | None = None):
        self.spark = spark
        self.raw = raw
        self.run_ts = run_ts or run_timestamp()

    @classmethod
    def from_driver_tables(cls, spark: SparkSession, sf_dir: str,
                           run_ts: _dt.datetime | None = None, sources=fixtures) -> "Layers":
        """``sources``: the clean binding, or the one with planted defects."""
        ts = run_ts or run_timestamp()
        return cls(spark, raw_from_sources(sources.source_frames(spark, sf_dir), ts), ts)

    @cached_property
    def staging(self) -> dict[str, DataFrame]:
        return staging.build_staging(self.raw, self.run_ts)

    @cached_property
    def analytics(self) -> dict[str, DataFrame]:
        return marts.build_analytics(self.staging, self.run_ts)

    @cached_property
    def views(self) -> dict[str, DataFrame]:
        return reports.build_reports(self.analytics)

    def staging_quality(self) -> DataFrame:
        return quality.staging_quality(self.spark, self.raw, self.staging)

    def analytics_quality(self) -> DataFrame:
        return quality.analytics_quality(self.spark, self.staging, self.analytics, self.views)
