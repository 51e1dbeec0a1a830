"""Raw profiling, the staging suite (28 checks) and the reconciliation suite
(19 checks).

Each check is a measure of a ``Ledger``, which plans one aggregate per table
and one shuffle per key domain for all checks (and constraints) together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermart.operators.ledger import Ledger, Measure
from ordermart.schemas import ANALYTICS_CHECK_NAMES, RAW_KEYS, STAGING_CHECK_NAMES

FAIL, WARN = "FAIL", "WARN"
STAGING_FAILS = 21  # the first checks of the staging suite; the rest warn


@dataclass(frozen=True)
class Check:
    name: str
    actual: Measure
    severity: str = FAIL


def status(actual: Column, severity: Column) -> Column:
    """PASS when actual is 0; otherwise WARN or FAIL by severity. A NULL actual
    (e.g. SUM over an empty table) is a FAIL, never an error."""
    return (F.when(actual == 0, "PASS").when(actual.isNotNull() & (severity == WARN), WARN).otherwise(FAIL))


def run_checks(spark: SparkSession, ledger: Ledger, checks: list[Check], actual_type: T.DataType) -> DataFrame:
    """(check_order, name, severity, expected, actual, status), one row per check."""
    rows = [F.struct(F.lit(i).alias("check_order"), F.lit(c.name).alias("name"), F.lit(c.severity).alias("severity"),
                     c.actual().cast(actual_type).alias("actual")) for i, c in enumerate(checks, 1)]
    return ledger.frame(spark).select(F.inline(F.array(*rows))).select(
        "check_order", "name", "severity", F.lit(0).cast(actual_type).alias("expected"), "actual",
        status(F.col("actual"), F.col("severity")).alias("status"))


def difference(a: Measure, b: Measure) -> Measure:
    return lambda: F.abs(a() - b())


# --- suites ----------------------------------------------------------------

def layered(**layers) -> dict[str, DataFrame]:
    """Tables by "layer.table"; only the tables that are asked for are built."""
    from ordermart.plans.lazy import LazyMap

    return LazyMap({f"{layer}.{t}": (lambda tables=tables, t=t: tables[t]) for layer, tables in layers.items() for t in tables})


def staging_checks(ledger: Ledger) -> list[Check]:
    """Over tables named raw.* and staging.*."""
    col = F.col

    def kept(table):
        return difference(ledger.rows(f"raw.{table}"), ledger.rows(f"staging.{table}"))

    def where(table, predicate):
        return ledger.where(f"staging.{table}", predicate)

    def lost(domain, child, parent, child_key=None, parent_key=None):
        return ledger.orphans(domain, f"staging.{child}", child_key or domain, f"staging.{parent}", parent_key or domain)

    def located(table, key):
        return lost("zip", table, "geolocation", key, "geolocation_zip_code_prefix")

    measures = [
        *[kept(t) for t in ("customers", "orders", "order_items", "order_payments", "order_reviews", "products", "sellers")],
        where("customers", col("customer_id").isNull()),
        where("orders", col("order_id").isNull()),
        ledger.repeated("customer_id", "staging.customers", "customer_id"),
        ledger.repeated("order_id", "staging.orders", "order_id"),
        lost("customer_id", "orders", "customers"),
        lost("order_id", "order_items", "orders"),
        lost("product_id", "order_items", "products"),
        lost("seller_id", "order_items", "sellers"),
        lost("order_id", "order_payments", "orders"),
        lost("order_id", "order_reviews", "orders"),
        where("order_reviews", ~col("review_score").between(1, 5)),
        where("order_items", (col("price") < 0) | (col("freight_value") < 0)),
        where("order_payments", col("payment_value") < 0),
        where("products", (col("product_weight_g") < 0) | (col("product_length_cm") < 0)
              | (col("product_height_cm") < 0) | (col("product_width_cm") < 0)),
        # warnings
        where("products", col("product_category_name") == "unknown"),
        located("customers", "customer_zip_code_prefix"),
        located("sellers", "seller_zip_code_prefix"),
        lost("order_id", "orders", "order_payments"),
        where("orders", (col("order_status") == "delivered") & col("order_delivered_customer_date").isNull()),
        where("orders", col("order_approved_at") < col("order_purchase_timestamp")),
        where("orders", col("order_delivered_customer_date") < col("order_purchase_timestamp")),
    ]
    return [Check(name, m, FAIL if k < STAGING_FAILS else WARN)
            for k, (name, m) in enumerate(zip(STAGING_CHECK_NAMES, measures, strict=True))]


def analytics_checks(ledger: Ledger) -> list[Check]:
    """Over tables named staging.*, analytics.* and views.*."""
    col, rows = F.col, ledger.rows
    delivered = col("order_status") == "delivered"

    def total(table, column, only=None):
        return ledger.aggregate(table, F.sum(column if only is None else F.when(only, col(column))))

    orders, items = "analytics.fact_orders", "analytics.fact_order_items"
    done = ledger.where(orders, delivered)
    measures = [
        difference(rows("analytics.dim_customers"),
                   ledger.distinct("customer_unique_id", "staging.customers", "customer_unique_id")),
        difference(rows("analytics.dim_products"), rows("staging.products")),
        difference(rows("analytics.dim_sellers"), rows("staging.sellers")),
        difference(rows(orders), rows("staging.orders")),
        difference(rows(items), rows("staging.order_items")),
        difference(total(orders, "item_count"), rows(items)),
        difference(total(orders, "payment_value"), total("staging.order_payments", "payment_value")),
        difference(total(orders, "product_value"), total("staging.order_items", "price")),
        difference(total(orders, "freight_value"), total("staging.order_items", "freight_value")),
        ledger.where(items, col("item_total_value") != col("price") + col("freight_value")),
        ledger.where(orders, (col("product_value") < 0) | (col("freight_value") < 0) | (col("payment_value") < 0)),
        ledger.where(orders, delivered & col("order_delivered_customer_date").isNotNull() & col("is_late").isNull()),
        difference(total("views.monthly_sales", "order_count"), done),
        difference(total("views.monthly_sales", "revenue"), total(orders, "payment_value", delivered)),
        difference(total("views.state_performance", "order_count"), done),
        difference(total("views.category_performance", "items_sold"), rows(items)),
        difference(total("views.seller_performance", "items_sold"), rows(items)),
        ledger.where("views.dashboard_summary", ~col("late_delivery_rate").between(0, 1)),
        ledger.where("views.dashboard_summary", ~col("average_review_score").between(1, 5)),
    ]
    return [Check(name, m) for name, m in zip(ANALYTICS_CHECK_NAMES, measures, strict=True)]


def staging_quality(spark, raw, stg) -> DataFrame:
    ledger = Ledger(layered(raw=raw, staging=stg))
    return run_checks(spark, ledger, staging_checks(ledger), T.LongType())


def analytics_quality(spark, stg, an, views) -> DataFrame:
    ledger = Ledger(layered(staging=stg, analytics=an, views=views))
    return run_checks(spark, ledger, analytics_checks(ledger), T.DecimalType(38, 2))


# --- raw profile -----------------------------------------------------------

def raw_row_counts(raw: dict[str, DataFrame]) -> DataFrame:
    """Rows and missing lineage per raw table (9 rows)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count"),
               F.count_if(F.col("source_file").isNull()).alias("missing_source_file"),
               F.count_if(F.col("loaded_at").isNull()).alias("missing_loaded_at"))
        .select(F.lit(t).alias("table_name"), "row_count", "missing_source_file", "missing_loaded_at")
        for t, df in sorted(raw.items())
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("table_name")


def raw_key_profile(raw: dict[str, DataFrame]) -> DataFrame:
    """NULL keys and surplus rows (COUNT(*) - COUNT(DISTINCT key)) per key.

    A composite key is a struct, so a partly-NULL pair is still one distinct
    value (a single NULL key is not, and counts as surplus)."""
    parts = []
    for label, table, cols in RAW_KEYS:
        df = raw[table]
        any_null = F.lit(False)
        for c in cols:
            any_null = any_null | F.col(c).isNull()
        key = F.col(cols[0]) if len(cols) == 1 else F.struct(*[F.col(c) for c in cols])
        parts.append(df.agg(
            F.count_if(any_null).alias("null_key_rows"),
            (F.count(F.lit(1)) - F.countDistinct(key)).alias("duplicate_key_rows"),
        ).select(F.lit(label).alias("key_name"), "null_key_rows", "duplicate_key_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("key_name")


def raw_orphans(raw: dict[str, DataFrame]) -> DataFrame:
    """Referential observations on the raw text (7 relationships)."""
    def orphans(label, child, ck, parent, pk, child_filter=None):
        c = raw[child] if child_filter is None else raw[child].filter(child_filter)
        p = raw[parent].select(F.col(pk).alias("_pk"))
        return (c.join(p, F.col(ck) == F.col("_pk"), "left_anti")
                .agg(F.count(F.lit(1)).alias("orphan_rows"))
                .select(F.lit(label).alias("relationship"), "orphan_rows"))

    parts = [
        orphans("orders without customers", "orders", "customer_id", "customers", "customer_id"),
        orphans("items without orders", "order_items", "order_id", "orders", "order_id"),
        orphans("items without products", "order_items", "product_id", "products", "product_id"),
        orphans("items without sellers", "order_items", "seller_id", "sellers", "seller_id"),
        orphans("payments without orders", "order_payments", "order_id", "orders", "order_id"),
        orphans("reviews without orders", "order_reviews", "order_id", "orders", "order_id"),
        orphans("product categories without translation", "products", "product_category_name",
                "product_category_translation", "product_category_name",
                child_filter=F.col("product_category_name").isNotNull()),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("relationship")


def duplicate_keys(stg: dict[str, DataFrame]) -> DataFrame:
    """Keys that occur more than once (GROUP BY key HAVING COUNT(*) > 1),
    counted per staging key that the suite checks."""
    def dup(label, df, key):
        return (df.groupBy(key).count().agg(
            F.count_if(F.col("count") > 1).alias("duplicated_keys"),
            F.coalesce(F.sum(F.when(F.col("count") > 1, F.col("count"))), F.lit(0)).alias("rows_in_duplicates"))
            .select(F.lit(label).alias("key_name"), "duplicated_keys", "rows_in_duplicates"))

    return dup("customers.customer_id", stg["customers"], "customer_id").unionByName(
        dup("orders.order_id", stg["orders"], "order_id"))
