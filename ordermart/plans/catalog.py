"""Registered queries: key -> (spark, sf_dir) -> DataFrame.

Every query reads the driver tables of ``sf_dir`` through the source-file
binding, so its work grows with them; audit timestamps (load / stage /
create times) are dropped because they differ per run.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.config import shared_dir
from ordermart.functions import presentable
from ordermart.operators import constraints, marts, quality, reports
from ordermart.plans import pipeline
from ordermart.plans.layers import Layers
from ordermart.sources import csv_ingest, dirty, fixtures
from ordermart.sources.raw import run_timestamp, to_raw

AUDIT_COLUMNS = ("loaded_at", "source_loaded_at", "staged_at", "created_at")


def _out(df: DataFrame) -> DataFrame:
    keep = [c for c in df.columns if c not in AUDIT_COLUMNS]
    return presentable(df.select(*keep))


def _layers(spark: SparkSession, sf_dir: str, sources=fixtures) -> Layers:
    return Layers.from_driver_tables(spark, sf_dir, sources=sources)


def _raw(name):
    return lambda spark, d: _out(_layers(spark, d).raw[name])


def _stg(name):
    return lambda spark, d: _out(_layers(spark, d).staging[name])


# Integer columns that may hold NULLs are handed over as DOUBLE (NaN for NULL),
# the way a pandas-based reader presents a nullable integer column.
NULLABLE_INT_COLUMNS = {
    "products": ("product_name_length", "product_description_length", "product_photos_qty"),
}


def _stg_nullable_ints(name):
    def run(spark, d):
        df = _out(_layers(spark, d).staging[name])
        cols = NULLABLE_INT_COLUMNS[name]
        return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])
    return run


def _an(name):
    return lambda spark, d: _out(_layers(spark, d).analytics[name])


def _view(name):
    return lambda spark, d: _out(_layers(spark, d).views[name])


def _raw_null_tokens(spark, d):
    """NULL cells per raw column after the CSV null-token mapping: one
    aggregate per table (a count per column, one scan), unpivoted."""
    raw = _layers(spark, d).raw
    parts = []
    for t, df in sorted(raw.items()):
        cols = [c for c in df.columns if c not in ("source_file", "loaded_at")]
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        parts.append(counts.select(F.inline(F.array(*[
            F.struct(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"),
                     F.col(c).alias("null_cells")) for c in cols
        ]))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _load_reconciliation(spark, d):
    """Rows the loader saw against rows stored, per raw table: each is written
    to the shared folder and counted again from there."""
    base, raw = f"{shared_dir(spark)}/load-{uuid.uuid4().hex}", _layers(spark, d).raw
    counts = pipeline.concurrently({t: (lambda t=t: pipeline.written(raw[t], f"{base}/{t}")[1:]) for t in raw})
    return pipeline.reconciliation(spark, [(t, *counts[t]) for t in sorted(counts)])


def _from_csv(name):
    """A raw table as the loader reads it: its source file is written as CSV to
    the shared folder and ingested from there."""
    def run(spark, d):
        source_dir = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"
        csv_ingest.write_source(fixtures.source_frames(spark, d)[name], source_dir, name)
        raw = to_raw(csv_ingest.read_files(spark, source_dir, name), name, run_timestamp())
        # the writer's names of the part files are its own
        return _out(raw.withColumn("source_file", F.substring_index("source_file", "/", 1)))
    return run


def _file_reconciliation(spark, d):
    """Orders and reviews delivered as files of a year each, loaded, and counted
    per file on both sides; a row per delivery, FAIL if one of its files is."""
    base, parts = f"{shared_dir(spark)}/deliveries-{uuid.uuid4().hex}", []
    for t, day in (("orders", "order_purchase_timestamp"), ("order_reviews", "review_creation_date")):
        csv_ingest.write_source(fixtures.source_frames(spark, d)[t], base, t, F.substr(F.col(day), F.lit(1), F.lit(4)))
        raw = pipeline.write_table(to_raw(csv_ingest.read_files(spark, base, t), t, run_timestamp()), f"{base}/raw/{t}")
        parts.append(csv_ingest.reconcile_files(spark, base, t, raw)
                     .groupBy(F.lit(t).alias("table_name"), F.regexp_extract("source_file", "/delivery=([^/]*)/", 1).alias("delivery"))
                     .agg(F.sum("source_records").alias("source_records"), F.sum("loaded_rows").alias("loaded_rows"),
                          F.when(F.bool_and(F.col("status") == "PASS"), "PASS").otherwise("FAIL").alias("status")))
    return parts[0].unionByName(parts[1])


def _orders_of_customer(spark, d):
    """The orders of the customer with the most, looked up by key in the stored fact."""
    an, path = _layers(spark, d).analytics, f"{shared_dir(spark)}/fact-orders-{uuid.uuid4().hex}"
    stored = pipeline.write_table(an["fact_orders"], path, pipeline.SORT_KEYS["fact_orders"], pipeline.BLOOM_KEYS["fact_orders"])
    most = stored.groupBy("customer_unique_id").count().orderBy(F.desc("count"), "customer_unique_id").first()
    return _out(marts.orders_of(stored, most["customer_unique_id"] if most else ""))


def _with(fn, sources=fixtures):
    return lambda spark, d: _out(fn(_layers(spark, d, sources)))


def _insights(least):
    return _with(lambda ly: reports.insights(ly.views["dashboard_summary"], ly.views["monthly_sales"],
                                             ly.views["category_performance"], ly.views["state_performance"], least))


def _exports(name):
    return lambda spark, d: _out(reports.export_queries(_layers(spark, d).views)[name])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # raw
    "raw_customers": _raw("customers"),
    "csv_customers": _from_csv("customers"),
    "csv_order_reviews": _from_csv("order_reviews"),
    "raw_translation_scan": _raw("product_category_translation"),
    "raw_null_tokens": _raw_null_tokens,
    "load_reconciliation": _load_reconciliation,
    "file_reconciliation": _file_reconciliation,
    "raw_row_counts": _with(lambda ly: quality.raw_row_counts(ly.raw)),
    "raw_key_profile": _with(lambda ly: quality.raw_key_profile(ly.raw)),
    "raw_orphans": _with(lambda ly: quality.raw_orphans(ly.raw)),
    # the same over sources with planted defects
    "raw_key_profile_dirty": _with(lambda ly: quality.raw_key_profile(ly.raw), dirty),
    "raw_orphans_dirty": _with(lambda ly: quality.raw_orphans(ly.raw), dirty),
    "constraint_violations_dirty": _with(lambda ly: constraints.constraint_violations(
        ly.spark, staging=ly.staging, analytics=ly.analytics), dirty),
    "constraint_evidence_dirty": _with(lambda ly: constraints.constraint_evidence(
        quality.layered(staging=ly.staging, analytics=ly.analytics), ("staging", "analytics")), dirty),
    "staging_quality_dirty": _with(lambda ly: ly.staging_quality(), dirty),
    # staging
    "stg_customers": _stg("customers"),
    "stg_products": _stg_nullable_ints("products"),
    "stg_sellers": _stg("sellers"),
    "stg_geolocation": _stg("geolocation"),
    "stg_orders": _stg("orders"),
    "stg_order_items": _stg("order_items"),
    "stg_order_payments": _stg("order_payments"),
    "stg_order_reviews": _stg("order_reviews"),
    "duplicate_keys": _with(lambda ly: quality.duplicate_keys(ly.staging)),
    "constraint_violations": _with(lambda ly: constraints.constraint_violations(
        ly.spark, staging=ly.staging, analytics=ly.analytics)),
    "staging_quality": _with(lambda ly: ly.staging_quality()),
    # marts
    "customer_order_rank": _with(lambda ly: marts.customer_order_rank(ly.staging["customers"], ly.staging["orders"])),
    "customer_order_history": _with(lambda ly: marts.customer_order_history(ly.staging["customers"], ly.staging["orders"])),
    "orders_of_customer": _orders_of_customer,
    "order_item_totals": _with(lambda ly: marts.order_item_totals(ly.staging["order_items"])),
    "order_payment_totals": _with(lambda ly: marts.order_payment_totals(ly.staging["order_payments"])),
    "order_review_totals": _with(lambda ly: marts.order_review_totals(ly.staging["order_reviews"])),
    "dim_customers": _an("dim_customers"),
    "dim_products": _an("dim_products"),
    "dim_sellers": _an("dim_sellers"),
    "fact_orders": _an("fact_orders"),
    "fact_order_items": _an("fact_order_items"),
    "analytics_quality": _with(lambda ly: ly.analytics_quality()),
    # reports
    "monthly_sales": _view("monthly_sales"),
    "category_performance": _view("category_performance"),
    "state_performance": _view("state_performance"),
    "seller_performance": _view("seller_performance"),
    "dashboard_summary": _view("dashboard_summary"),
    "customer_repeat_summary": _with(lambda ly: reports.customer_repeat_summary(ly.analytics["dim_customers"])),
    "state_share": _with(lambda ly: reports.state_share(ly.views["state_performance"])),
    "state_top10": _with(lambda ly: reports.state_top10(ly.views["state_performance"])),
    "category_bars": _with(lambda ly: reports.category_bars(ly.views["category_performance"])),
    "kpi_long": _with(lambda ly: reports.kpi_long(ly.views["dashboard_summary"])),
    "insights": _insights(reports.MEANINGFUL_MONTH_ORDERS),
    # months of the driver data are small: with 10 orders as the least, all four cards appear
    "insights_small_months": _insights(10),
    # exports
    "export_dashboard_summary": _exports("dashboard_summary"),
    "export_monthly_sales": _exports("monthly_sales"),
    "export_category_top15": _exports("category_performance"),
    "export_state_performance": _exports("state_performance"),
    "export_seller_top10": _exports("seller_performance"),
}
