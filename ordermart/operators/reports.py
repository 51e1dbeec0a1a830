"""Reporting views, the dashboard's derived figures and the export queries.

All views aggregate the facts; outputs are tiny (months, states, categories,
sellers) but inputs are fact-sized, so every view is one filtered scan plus a
partial (map-side) aggregate. Shares and ratios use a scalar aggregate joined
back as a scalar subquery, never a cross join or an unpartitioned window that
would pull the input into a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermart.functions import decimal_avg, month_start, rate_avg
from ordermart.schemas import DAYS, MONEY, MONEY_REPORT, RATE, REVIEW_AVG

DELIVERED = "delivered"
VIEWS = ("monthly_sales", "category_performance", "state_performance", "seller_performance", "dashboard_summary")
MEANINGFUL_MONTH_ORDERS = 100  # months below this volume are skipped by insights


def _delivered(fact_orders: DataFrame) -> DataFrame:
    return fact_orders.filter(F.col("order_status") == DELIVERED)


def monthly_sales(fact_orders: DataFrame) -> DataFrame:
    return (_delivered(fact_orders)
            .groupBy(month_start(F.col("order_purchase_timestamp")).alias("order_month"))
            .agg(
                F.count(F.lit(1)).alias("order_count"),
                F.sum("payment_value").cast(MONEY_REPORT).alias("revenue"),
                decimal_avg(F.col("payment_value"), MONEY).alias("average_order_value"),
                decimal_avg(F.col("average_review_score"), REVIEW_AVG).alias("average_review_score"),
                rate_avg(F.col("is_late"), RATE).alias("late_delivery_rate"),
            ))


def _sold(fact_order_items: DataFrame, fact_orders: DataFrame, dimension: DataFrame, key: str, by: list[str]) -> DataFrame:
    """Sales by columns of a dimension, no status filter.

    Aggregated before the star join: rows of an order and ``key`` become one
    where the items already are by order, then one row per order and group,
    whose number is the number of distinct orders. The score of an order counts
    once per item: points and rated items are summed, and divided at the end."""
    o = fact_orders.select("order_id", "average_review_score")
    per_key = (fact_order_items.select("order_id", key, "price").join(o, "order_id").groupBy("order_id", key)
               .agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("worth"), F.sum("average_review_score").alias("points"),
                    F.count("average_review_score").alias("rated")))
    per_order = per_key.join(dimension.select(*dict.fromkeys([key, *by])), key)
    if key not in by:
        per_order = per_order.groupBy(*by, "order_id").agg(*[F.sum(c).alias(c) for c in ("n", "worth", "points", "rated")])
    mean = F.try_divide(F.sum("points").cast("decimal(24,2)"), F.sum("rated").cast("decimal(20,0)"))
    return per_order.groupBy(*by).agg(
        F.sum("n").alias("items_sold"),
        F.count(F.lit(1)).alias("order_count"),
        F.sum("worth").cast(MONEY_REPORT).alias("product_revenue"),
        mean.cast(REVIEW_AVG).alias("average_review_score"),
    )


def category_performance(fact_order_items: DataFrame, dim_products: DataFrame,
                         fact_orders: DataFrame) -> DataFrame:
    return _sold(fact_order_items, fact_orders, dim_products, "product_id", ["product_category_name"])


def state_performance(fact_orders: DataFrame) -> DataFrame:
    """State on the order (not the customer's latest state); delivered only."""
    return _delivered(fact_orders).groupBy("customer_state").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("payment_value").cast(MONEY_REPORT).alias("revenue"),
        decimal_avg(F.col("payment_value"), MONEY).alias("average_order_value"),
        rate_avg(F.col("is_late"), RATE).alias("late_delivery_rate"),
    )


def seller_performance(fact_order_items: DataFrame, dim_sellers: DataFrame,
                       fact_orders: DataFrame) -> DataFrame:
    """Per (order, seller) rows are the distinct orders already; columns in the order the export has them."""
    out = _sold(fact_order_items, fact_orders, dim_sellers, "seller_id", ["seller_id", "seller_city", "seller_state"])
    return out.select("seller_id", "seller_city", "seller_state", "order_count", "items_sold", "product_revenue",
                      "average_review_score")


def dashboard_summary(fact_orders: DataFrame) -> DataFrame:
    """Global aggregate: one row even on empty input."""
    return _delivered(fact_orders).agg(
        F.count(F.lit(1)).alias("delivered_orders"),
        F.countDistinct("customer_unique_id").alias("customers"),
        F.sum("payment_value").cast(MONEY_REPORT).alias("revenue"),
        decimal_avg(F.col("payment_value"), MONEY).alias("average_order_value"),
        decimal_avg(F.col("average_review_score"), REVIEW_AVG).alias("average_review_score"),
        rate_avg(F.col("is_late"), RATE).alias("late_delivery_rate"),
        decimal_avg(F.col("delivery_days"), DAYS).alias("average_delivery_days"),
    )


def customer_repeat_summary(dim_customers: DataFrame) -> DataFrame:
    """Most orders by one customer and the number of repeat customers."""
    n = F.col("lifetime_order_count")
    return dim_customers.agg(
        F.count(F.lit(1)).alias("customers"),
        F.max(n).alias("max_orders_per_customer"),
        F.count_if(n > 1).alias("repeat_customers"),
    )


# --- derived dashboard figures --------------------------------------------

def state_share(state_perf: DataFrame) -> DataFrame:
    """Each state's share of delivered revenue (scalar total joined back)."""
    total = state_perf.agg(F.sum("revenue")).scalar()
    return state_perf.select(
        "customer_state", "order_count", "revenue",
        (F.col("revenue").cast("decimal(38,20)") / total)
        .cast(T.DecimalType(7, 4)).alias("revenue_share"),
    )


def state_top10(state_perf: DataFrame) -> DataFrame:
    return (state_perf.select("customer_state", "order_count", "revenue", "late_delivery_rate")
            .orderBy(F.col("revenue").desc(), F.col("customer_state").asc()).limit(10))


def category_top(category_perf: DataFrame, n: int) -> DataFrame:
    return category_perf.orderBy(F.col("product_revenue").desc(),
                                 F.col("product_category_name").asc()).limit(n)


def category_bars(category_perf: DataFrame) -> DataFrame:
    """Top 10 of the exported top 15, bar length relative to the largest."""
    top = category_top(category_perf, 10)
    # the largest of all leads the ten: a window over those, so the view is computed once
    peak = F.max("product_revenue").over(Window.partitionBy(F.lit(0)))
    return top.select(
        F.regexp_replace("product_category_name", "_", " ").alias("category_label"),
        "items_sold", "product_revenue",
        (F.col("product_revenue").cast("decimal(38,20)") / peak)
        .cast(T.DecimalType(7, 4)).alias("bar_ratio"),
    )


# Dashboard card labels and their display format, in display order (fixed values).
KPI_CARDS = (
    ("Delivered orders", "delivered_orders", "integer"),
    ("Customers", "customers", "integer"),
    ("Revenue", "revenue", "money"),
    ("Average order", "average_order_value", "money"),
    ("Review score", "average_review_score", "score"),
    ("Late deliveries", "late_delivery_rate", "percent"),
    ("Delivery time", "average_delivery_days", "days"),
)
CURRENCY_PREFIX = "R$"


def display(value: Column, kind: str) -> Column:
    """Card text: grouped integers, whole currency units, one-decimal
    percentages, two-decimal scores / days. Values are rounded half away from
    zero to the shown digits first, so the text never depends on a
    formatter's own rounding mode."""
    v = value.cast(T.DecimalType(20, 4))
    if kind == "integer":
        return F.format_number(F.round(v, 0), 0)
    if kind == "money":
        return F.concat(F.lit(CURRENCY_PREFIX), F.format_number(F.round(v, 0), 0))
    if kind == "percent":
        return F.concat(F.format_number(F.round(v * 100, 1), 1), F.lit("%"))
    if kind == "score":
        return F.concat(F.format_number(F.round(v, 2), 2), F.lit(" / 5"))
    if kind == "days":
        return F.concat(F.format_number(F.round(v, 2), 2), F.lit(" days"))
    raise ValueError(kind)


def kpi_long(summary: DataFrame) -> DataFrame:
    """The seven headline cards as (position, label, value, display) rows."""
    return summary.select(F.inline(F.array(
        *[F.struct(F.lit(i + 1).alias("position"), F.lit(label).alias("label"),
                   F.col(col).cast(T.DecimalType(20, 4)).alias("value"),
                   display(F.col(col), kind).alias("display"))
          for i, (label, col, kind) in enumerate(KPI_CARDS)]
    )))


def insights(summary: DataFrame, monthly: DataFrame, category_perf: DataFrame,
             state_perf: DataFrame, least_orders: int = MEANINGFUL_MONTH_ORDERS) -> DataFrame:
    """The four insight cards: peak revenue month and worst late-rate month
    among months with at least ``least_orders`` orders (first wins on ties,
    i.e. the earliest), leading state with its revenue share, leading category.

    Each card is an argmax over a small, already-aggregated view; the
    comparison the card text makes is returned as a flag."""
    months = monthly.filter(F.col("order_count") >= least_orders)
    overall_late = summary.select("late_delivery_rate").scalar()

    def pick(df, metric, key):
        return df.orderBy(F.col(metric).desc(), F.col(key).asc()).limit(1)

    peak = pick(months, "revenue", "order_month").select(
        F.lit("peak_revenue_month").alias("insight"),
        F.date_format("order_month", "MMMM yyyy").alias("subject"),
        F.col("revenue").cast(T.DecimalType(20, 4)).alias("value"),
        display(F.col("revenue"), "money").alias("display"),
        F.col("order_count").alias("order_count"),
        F.col("late_delivery_rate").cast(T.DecimalType(20, 4)).alias("rate"),
        (F.col("late_delivery_rate") > overall_late).alias("above_overall"),
    )
    worst = pick(months, "late_delivery_rate", "order_month").select(
        F.lit("worst_late_month").alias("insight"),
        F.date_format("order_month", "MMMM yyyy").alias("subject"),
        F.col("late_delivery_rate").cast(T.DecimalType(20, 4)).alias("value"),
        display(F.col("late_delivery_rate"), "percent").alias("display"),
        F.col("order_count").alias("order_count"),
        F.col("late_delivery_rate").cast(T.DecimalType(20, 4)).alias("rate"),
        (F.col("late_delivery_rate") > overall_late).alias("above_overall"),
    )
    shares = state_share(state_perf)
    lead_state = pick(shares.join(state_perf.select("customer_state", "late_delivery_rate"),
                                  "customer_state"),
                      "revenue", "customer_state").select(
        F.lit("leading_state").alias("insight"),
        F.col("customer_state").alias("subject"),
        F.col("revenue_share").cast(T.DecimalType(20, 4)).alias("value"),
        display(F.col("revenue_share"), "percent").alias("display"),
        F.col("order_count").alias("order_count"),
        F.col("late_delivery_rate").cast(T.DecimalType(20, 4)).alias("rate"),
        (F.col("late_delivery_rate") > overall_late).alias("above_overall"),
    )
    lead_cat = category_top(category_perf, 1).select(
        F.lit("leading_category").alias("insight"),
        F.regexp_replace("product_category_name", "_", " ").alias("subject"),
        F.col("product_revenue").cast(T.DecimalType(20, 4)).alias("value"),
        display(F.col("product_revenue"), "money").alias("display"),
        F.col("items_sold").alias("order_count"),
        F.col("average_review_score").cast(T.DecimalType(20, 4)).alias("rate"),
        F.lit(None).cast(T.BooleanType()).alias("above_overall"),
    )
    return peak.unionByName(worst).unionByName(lead_state).unionByName(lead_cat)


def build_reports(an):
    """The five reporting views over an analytics mapping, built on first use."""
    from ordermart.plans.lazy import LazyMap

    return LazyMap({
        "monthly_sales": lambda: monthly_sales(an["fact_orders"]),
        "category_performance": lambda: category_performance(
            an["fact_order_items"], an["dim_products"], an["fact_orders"]),
        "state_performance": lambda: state_performance(an["fact_orders"]),
        "seller_performance": lambda: seller_performance(
            an["fact_order_items"], an["dim_sellers"], an["fact_orders"]),
        "dashboard_summary": lambda: dashboard_summary(an["fact_orders"]),
    })


# --- exports (ordered result sets) ----------------------------------------

def export_queries(views: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "dashboard_summary": views["dashboard_summary"],
        "monthly_sales": views["monthly_sales"].orderBy("order_month"),
        "category_performance": category_top(views["category_performance"], 15),
        "state_performance": views["state_performance"].orderBy(
            F.col("revenue").desc(), F.col("customer_state").asc()),
        "seller_performance": views["seller_performance"].orderBy(
            F.col("product_revenue").desc(), F.col("seller_id").asc()).limit(10),
    }
