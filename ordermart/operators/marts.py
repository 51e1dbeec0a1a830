"""Dimensions and facts.

Plan shape (per fact build, at any scale):

* child tables are aggregated to order grain *before* joining (partial
  aggregation map side, one shuffle on ``order_id`` each), so an order with
  many items / payments / reviews is never multiplied and a hot order is
  combined before it is shuffled;
* the three order-grain aggregates come out hash-partitioned on ``order_id``
  and are joined to the orders without another exchange on their side;
* ``dim_customers`` is one group-by over customer x order: first / last order
  and the count are plain aggregates, and the latest location is the max of a
  (timestamp, order_id, location) struct - a deterministic argmax that also
  combines map side. No window over a customer's whole history is needed.

Nothing is broadcast by force: customers, products and sellers grow with the
data, so Spark's size-checked auto broadcast (and AQE at run time) decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermart.functions import decimal_avg, epoch_days
from ordermart.schemas import DAYS, MONEY, MONEY_TOTAL, REVIEW_AVG

TABLES = ("dim_customers", "dim_products", "dim_sellers", "fact_orders", "fact_order_items")


def customer_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """customer x order (inner), the common input of the customer dimension."""
    c = customers.select("customer_id", "customer_unique_id", "customer_zip_code_prefix",
                         "customer_city", "customer_state")
    o = orders.select("customer_id", "order_id", "order_purchase_timestamp")
    return c.join(o, "customer_id")


def dim_customers(customers: DataFrame, orders: DataFrame, created_at) -> DataFrame:
    co = customer_orders(customers, orders)
    latest = F.max(F.struct(
        F.col("order_purchase_timestamp").alias("ts"),
        F.col("order_id").alias("oid"),
        F.col("customer_zip_code_prefix").alias("zip"),
        F.col("customer_city").alias("city"),
        F.col("customer_state").alias("state"),
    ))
    g = co.groupBy("customer_unique_id").agg(
        latest.alias("latest"),
        F.min("order_purchase_timestamp").alias("first_order_at"),
        F.max("order_purchase_timestamp").alias("last_order_at"),
        F.count(F.lit(1)).cast(T.IntegerType()).alias("lifetime_order_count"),
    )
    return g.select(
        "customer_unique_id",
        F.col("latest.zip").alias("latest_zip_code_prefix"),
        F.col("latest.city").alias("latest_city"),
        F.col("latest.state").alias("latest_state"),
        "first_order_at", "last_order_at", "lifetime_order_count",
        F.lit(created_at).alias("created_at"),
    )


def customer_order_rank(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """The rank-1 row of ROW_NUMBER() OVER (PARTITION BY customer ORDER BY
    purchase time DESC, order id DESC): each customer's latest order with the
    location recorded on it.

    Only rank 1 is ever used, so it is computed as a grouped argmax (max of a
    struct led by the ordering keys) instead of sorting every customer's whole
    history inside one task: the max combines map side, so a customer holding
    a third of all orders costs no more than any other group.
    """
    co = customer_orders(customers, orders)
    latest = F.max(F.struct(
        F.col("order_purchase_timestamp"), F.col("order_id"),
        F.col("customer_zip_code_prefix"), F.col("customer_city"), F.col("customer_state"),
    )).alias("latest")
    return co.groupBy("customer_unique_id").agg(latest).select(
        "customer_unique_id",
        "latest.customer_zip_code_prefix", "latest.customer_city", "latest.customer_state",
        "latest.order_id", "latest.order_purchase_timestamp",
    )


def customer_order_history(customers: DataFrame, orders: DataFrame, ranks: int = 3) -> DataFrame:
    """The ``ranks`` latest orders of each customer, numbered from the latest,
    with the location recorded on each.

    Spark ranks inside the tasks of the join first (WindowGroupLimit), so a
    customer with a third of all orders sends ``ranks`` rows of each task over
    the exchange."""
    latest = Window.partitionBy("customer_unique_id").orderBy(F.desc("order_purchase_timestamp"), F.desc("order_id"))
    ranked = customer_orders(customers, orders).withColumn("order_rank", F.row_number().over(latest))
    return ranked.where(F.col("order_rank") <= ranks).select(
        "customer_unique_id", "order_rank", "order_id", "order_purchase_timestamp",
        "customer_zip_code_prefix", "customer_city", "customer_state")


def orders_of(fact_orders: DataFrame, customer_unique_id: str | Column) -> DataFrame:
    """Lookup of one customer's orders: the stored table's Bloom filters leave
    out row groups without the customer."""
    return fact_orders.where(F.col("customer_unique_id") == customer_unique_id)


def items_of(fact_order_items: DataFrame, seller_id: str | Column) -> DataFrame:
    """Lookup of one seller's items, as ``orders_of``."""
    return fact_order_items.where(F.col("seller_id") == seller_id)


def dim_products(products: DataFrame, created_at) -> DataFrame:
    return products.select(
        "product_id", "product_category_name", "product_category_name_original",
        "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
        F.lit(created_at).alias("created_at"),
    )


def dim_sellers(sellers: DataFrame, created_at) -> DataFrame:
    return sellers.select(
        "seller_id", "seller_zip_code_prefix", "seller_city", "seller_state",
        F.lit(created_at).alias("created_at"),
    )


def order_item_totals(order_items: DataFrame) -> DataFrame:
    return order_items.groupBy("order_id").agg(
        F.count(F.lit(1)).cast(T.IntegerType()).alias("item_count"),
        F.sum("price").cast(MONEY_TOTAL).alias("product_value"),
        F.sum("freight_value").cast(MONEY_TOTAL).alias("freight_value"),
    )


def order_payment_totals(order_payments: DataFrame) -> DataFrame:
    return order_payments.groupBy("order_id").agg(
        F.sum("payment_value").cast(MONEY_TOTAL).alias("payment_value"),
    )


def order_review_totals(order_reviews: DataFrame) -> DataFrame:
    return order_reviews.groupBy("order_id").agg(
        decimal_avg(F.col("review_score"), REVIEW_AVG).alias("average_review_score"),
    )


def fact_orders(orders: DataFrame, customers: DataFrame, order_items: DataFrame,
                order_payments: DataFrame, order_reviews: DataFrame, created_at) -> DataFrame:
    o = orders.select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp",
        "order_approved_at", "order_delivered_customer_date", "order_estimated_delivery_date")
    c = customers.select("customer_id", "customer_unique_id", "customer_state")
    base = o.join(c, "customer_id")
    f = (base
         .join(order_item_totals(order_items), "order_id", "left")
         .join(order_payment_totals(order_payments), "order_id", "left")
         .join(order_review_totals(order_reviews), "order_id", "left"))
    delivered = F.col("order_delivered_customer_date")
    zero = F.lit(0).cast(MONEY_TOTAL)
    return f.select(
        "order_id", "customer_unique_id", "customer_state", "order_status",
        "order_purchase_timestamp", "order_approved_at", "order_delivered_customer_date",
        "order_estimated_delivery_date",
        F.coalesce(F.col("item_count"), F.lit(0)).alias("item_count"),
        F.coalesce(F.col("product_value"), zero).alias("product_value"),
        F.coalesce(F.col("freight_value"), zero).alias("freight_value"),
        F.coalesce(F.col("payment_value"), zero).alias("payment_value"),
        "average_review_score",
        F.when(delivered.isNotNull(),
               epoch_days(delivered, F.col("order_purchase_timestamp"), DAYS)).alias("delivery_days"),
        F.when(delivered.isNotNull(),
               delivered > F.col("order_estimated_delivery_date")).alias("is_late"),
        F.lit(created_at).alias("created_at"),
    )


def fact_order_items(order_items: DataFrame, created_at) -> DataFrame:
    return order_items.select(
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
        "price", "freight_value",
        (F.col("price") + F.col("freight_value")).cast(MONEY).alias("item_total_value"),
        F.lit(created_at).alias("created_at"),
    )


def build_analytics(stg, created_at):
    """Dimensions and facts over a staging mapping, each built on first use."""
    from ordermart.plans.lazy import LazyMap

    return LazyMap({
        "dim_customers": lambda: dim_customers(stg["customers"], stg["orders"], created_at),
        "dim_products": lambda: dim_products(stg["products"], created_at),
        "dim_sellers": lambda: dim_sellers(stg["sellers"], created_at),
        "fact_orders": lambda: fact_orders(stg["orders"], stg["customers"], stg["order_items"],
                                           stg["order_payments"], stg["order_reviews"], created_at),
        "fact_order_items": lambda: fact_order_items(stg["order_items"], created_at),
    })
