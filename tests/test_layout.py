"""Plans and layout: lookups by Bloom filter, ranks of a hot customer, one pass over the geolocation rows, sales per order."""

import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ordermart.operators import marts, reports, staging
from ordermart.plans import pipeline


def scanned(df):
    """Rows that the scan of ``df`` handed over."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return plan.collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("table,key,lookup", [("fact_orders", "customer_unique_id", marts.orders_of),
                                              ("fact_order_items", "seller_id", marts.items_of)])
def test_lookups_skip_row_groups(spark, tmp_dir, table, key, lookup):
    rows = spark.range(0, 200_000, 2, 4).select(F.sha2(F.col("id").cast("string"), 256).alias(key))
    indexed, seen, stored = pipeline.written(rows, f"{tmp_dir}/with", bloom=pipeline.BLOOM_KEYS[table])
    plain = pipeline.written(rows, f"{tmp_dir}/without")[0]
    here, absent = (spark.range(1).select(F.sha2(F.lit(x), 256)).first()[0] for x in ("2000", "2001"))
    assert (seen, stored, pipeline.BLOOM_KEYS[table]) == (100_000, 100_000, (key,))
    # an absent key inside the range of the stored ones: min and max alone can't tell
    assert scanned(lookup(plain, absent)) == 100_000 and scanned(lookup(indexed, absent)) == 0
    assert lookup(indexed, here).count() == 1 and scanned(lookup(indexed, here)) <= 25_000


def test_ranks_of_a_hot_customer(spark):
    n = 3000
    customers = spark.range(n).select(
        F.concat(F.lit("c"), "id").alias("customer_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 700)).alias("customer_unique_id"),
        F.lit("01000").alias("customer_zip_code_prefix"), F.lit("x").alias("customer_city"), F.lit("SP").alias("customer_state"))
    orders = spark.range(n).select(F.concat(F.lit("c"), "id").alias("customer_id"), F.concat(F.lit("o"), F.lpad("id", 5, "0")).alias("order_id"),
                                   F.timestamp_seconds(F.col("id") % 50).cast("timestamp_ntz").alias("order_purchase_timestamp"))
    got = marts.customer_order_history(customers, orders)
    assert re.search(r"WindowGroupLimit.*Partial", plan_of(got)) and re.search(r"WindowGroupLimit.*Final", plan_of(got))
    rows = {}
    for r in got.collect():
        rows.setdefault(r.customer_unique_id, {})[r.order_rank] = r.order_id
    wanted = {}
    for i in sorted(range(n), key=lambda i: (i % 50, i), reverse=True):
        wanted.setdefault("hot" if i % 3 == 0 else f"u{i % 700}", []).append(f"o{i:05d}")
    assert rows == {k: dict(enumerate(v[:3], 1)) for k, v in wanted.items()}
    # rank 1 is what the customer dimension takes
    first = {r.customer_unique_id: r.order_id for r in marts.customer_order_rank(customers, orders).collect()}
    assert first == {k: v[1] for k, v in rows.items()}


def test_geolocation_is_one_pass(spark):
    kind = ", ".join(f"geolocation_{c} string" for c in ("zip_code_prefix", "lat", "lng", "city", "state")) + ", loaded_at timestamp"
    rows = [("1", "1.0", "2.0", "B", "sp", None)] * 2 + [("1", "3.0", "2.0", "a", "sp", None)] * 2 + [("1", "1.0", None, None, "rj", None)] * 3
    rows += [(None, "5.0", "6.0", None, None, None), ("2", None, None, "z", None, None)]
    raw = spark.createDataFrame(rows, kind)
    out = staging.stg_geolocation(raw, None)
    assert plan_of(out).count("Scan ") == 1 and "Join" not in plan_of(out)
    got = {r[0]: tuple(r)[1:5] for r in out.collect()}
    assert got["1"][0] == pytest.approx(Decimal(11) / 7, abs=Decimal("1e-6")) and got["1"][1:] == (Decimal(2), "a", "SP")
    assert got[None][2:] == (None, None) and got["2"] == (None, None, "z", None)


def test_sales_count_an_order_once(spark):
    items = spark.createDataFrame([("o1", "p1", "s1", Decimal("1.50")), ("o1", "p1", "s1", Decimal("1.50")), ("o1", "p2", "s1", Decimal("2.00")),
                                   ("o2", "p1", "s1", Decimal("4.00")), ("o3", "p3", "s1", Decimal("9.00")), ("o9", "p1", "s1", Decimal("7.00"))],
                                  "order_id string, product_id string, seller_id string, price decimal(12,2)")
    orders = spark.createDataFrame([("o1", Decimal("5.00")), ("o2", Decimal("2.00")), ("o3", None)], "order_id string, average_review_score decimal(3,2)")
    products = spark.createDataFrame([("p1", "toys"), ("p2", "toys"), ("p3", None)], "product_id string, product_category_name string")
    sellers = spark.createDataFrame([("s1", "rio", "RJ")], "seller_id string, seller_city string, seller_state string")
    got = {r[0]: tuple(r)[1:] for r in reports.category_performance(items, products, orders).collect()}
    assert got == {"toys": (4, 2, Decimal("9.00"), Decimal("4.25")), None: (1, 1, Decimal("9.00"), None)}
    sold = reports.seller_performance(items, sellers, orders).collect()
    assert [tuple(r) for r in sold] == [("s1", "rio", "RJ", 3, 5, Decimal("18.00"), Decimal("4.25"))]
