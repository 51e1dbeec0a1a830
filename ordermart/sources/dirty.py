"""The source files with planted defects.

Rules on the keys of whole driver tables break every kind of declared
constraint and the staging checks that clean data never trips: repeated and
missing keys, orphans, bad patterns, unknown statuses, negative and
out-of-range values. ``plans.oracle`` states the expected findings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.sources import fixtures


def _key(column: str) -> Column:
    return F.substring(column, 2, 20).cast("bigint")


def _edit(df: DataFrame, key: Column, rules: dict[str, list[tuple[int, Column | str]]]) -> DataFrame:
    """Cells replaced where the key is a multiple; the first rule wins."""
    keyed = df.withColumn("_k", key)
    cells = []
    for c in df.columns:
        out = F.col(c)
        for n, value in reversed(rules.get(c, [])):
            out = F.when(F.col("_k") % n == 0, F.lit(value) if isinstance(value, str) else value).otherwise(out)
        cells.append(out.alias(c))
    return keyed.select(*cells)


def _next(prefix: str) -> Column:
    return F.concat(F.lit(prefix), (F.col("_k") + 1).cast("string"))


def _negative(column: str) -> Column:
    return F.concat(F.lit("-"), F.col(column))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edit(fixtures.customers_csv(spark, sf_dir), _key("customer_id"), {
        "customer_id": [(701, "NA"), (601, _next("c"))], "customer_zip_code_prefix": [(101, "123")],
        "customer_city": [(107, "")], "customer_state": [(103, "x")]})


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edit(fixtures.orders_csv(spark, sf_dir), _key("order_id"), {
        "order_id": [(509, ""), (503, _next("o"))], "order_status": [(211, "lost")]})


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered by the driver's own line number, which repeats in an order."""
    lines = fixtures.read_driver(spark, sf_dir, "lineitem")
    cells = fixtures.item_cells(lines, F.col("l_linenumber"))
    by_part = _edit(cells, _key("product_id"), {
        "product_id": [(89, F.concat(F.lit("p"), (F.col("_k") + 1_000_000_000).cast("string")))],
        "price": [(97, _negative("price"))], "freight_value": [(113, _negative("freight_value"))]})
    return _edit(by_part, _key("order_id"), {"seller_id": [(83, "s0x")], "shipping_limit_date": [(79, "NULL")]})


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edit(fixtures.order_payments_csv(spark, sf_dir), _key("order_id"), {
        "order_id": [(67, "o0x")], "payment_type": [(61, "n/a")], "payment_installments": [(71, "-1")],
        "payment_value": [(73, _negative("payment_value"))]})


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores up to 9; some reviews repeat the next event's, some have no order."""
    cells = fixtures.order_reviews_csv(spark, sf_dir, scores=9)
    following = F.col("_k") + 1 + F.when((F.col("_k") + 1) % 7 == 0, 1).otherwise(0)
    return _edit(cells, _key("review_id"), {
        "order_id": [(47, "o0x"), (53, F.concat(F.lit("o"), following.cast("string")))], "review_id": [(53, _next("r"))]})


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edit(fixtures.products_csv(spark, sf_dir), _key("product_id"), {
        "product_id": [(41, _next("p"))], "product_weight_g": [(43, _negative("product_weight_g"))]})


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edit(fixtures.sellers_csv(spark, sf_dir), _key("seller_id"), {
        "seller_id": [(37, _next("s"))], "seller_zip_code_prefix": [(31, "9")]})


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.geolocation_csv(spark, sf_dir, bad_zip_every=29)


def source_frames(spark: SparkSession, sf_dir: str):
    """The nine source files' contents, each built on first use."""
    from ordermart.plans.lazy import LazyMap

    own = {"customers": customers, "orders": orders, "order_items": order_items, "order_payments": order_payments,
           "order_reviews": order_reviews, "products": products, "sellers": sellers, "geolocation": geolocation}
    return LazyMap({t: (lambda b=own.get(t, build): b(spark, sf_dir)) for t, build in fixtures.SOURCE_BUILDERS.items()})
