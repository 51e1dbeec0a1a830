"""Business rules of the marts and views on hand-built facts."""

import datetime as dt
from decimal import Decimal as D

import pytest

from ordermart.operators import marts, reports

FO_SCHEMA = ("order_id string, customer_unique_id string, customer_state string, order_status string, "
             "order_purchase_timestamp timestamp_ntz, payment_value decimal(14,2), "
             "average_review_score decimal(3,2), is_late boolean, delivery_days decimal(10,2)")


def _ts(s):
    return dt.datetime.fromisoformat(s)


@pytest.fixture()
def facts(spark):
    fo = spark.createDataFrame([
        ("o1", "u1", "SP", "delivered", _ts("2017-01-05 10:00:00"), D("10.00"), D("5.00"), True, D("3.00")),
        ("o2", "u1", "RJ", "delivered", _ts("2017-01-20 10:00:00"), D("20.01"), None, None, None),
        ("o3", "u2", "SP", "shipped", _ts("2017-01-21 10:00:00"), D("99.00"), D("1.00"), None, None),
        ("o4", "u3", "SP", "delivered", _ts("2017-03-02 10:00:00"), D("0.00"), D("2.50"), False, D("1.50")),
    ], FO_SCHEMA)
    fi = spark.createDataFrame([
        ("o1", 1, "p1", "s1", D("4.00")), ("o1", 2, "p1", "s1", D("4.00")), ("o1", 3, "p2", "s2", D("2.00")),
        ("o3", 1, "p1", "s1", D("90.00")), ("o4", 1, "p2", "s1", D("0.00")),
    ], "order_id string, order_item_id int, product_id string, seller_id string, price decimal(12,2)")
    dp = spark.createDataFrame([("p1", "toys"), ("p2", "books")],
                               "product_id string, product_category_name string")
    ds = spark.createDataFrame([("s1", "sao paulo", "SP"), ("s2", "rio", "RJ")],
                               "seller_id string, seller_city string, seller_state string")
    return fo, fi, dp, ds


def test_monthly_filters_delivered_and_is_not_densified(facts):
    fo, *_ = facts
    rows = {str(r["order_month"]): r for r in reports.monthly_sales(fo).collect()}
    assert sorted(rows) == ["2017-01-01", "2017-03-01"]          # no February row
    jan = rows["2017-01-01"]
    assert jan["order_count"] == 2                                # shipped o3 excluded
    assert jan["revenue"] == D("30.01")
    assert jan["average_order_value"] == D("15.01")               # 15.005 -> half up
    assert jan["average_review_score"] == D("5.00")               # NULL review ignored
    assert jan["late_delivery_rate"] == D("1.0000")               # NULL late flag not in denominator


def test_state_is_the_order_state(facts):
    fo, *_ = facts
    got = {r["customer_state"]: r["order_count"] for r in reports.state_performance(fo).collect()}
    assert got == {"SP": 2, "RJ": 1}                              # u1 counted under both states


def test_category_has_no_status_filter_and_weights_review_by_item(facts):
    fo, fi, dp, _ = facts
    got = {r["product_category_name"]: r for r in reports.category_performance(fi, dp, fo).collect()}
    toys = got["toys"]
    assert toys["items_sold"] == 3 and toys["order_count"] == 2  # shipped o3 included
    assert toys["product_revenue"] == D("98.00")
    # items: two of o1 (5.00) and one of o3 (1.00) -> (5+5+1)/3 = 3.666.. -> 3.67
    assert toys["average_review_score"] == D("3.67")
    assert got["books"]["average_review_score"] == D("3.75")     # (5.00 + 2.50) / 2


def test_seller_view_counts_distinct_orders(facts):
    fo, fi, _, ds = facts
    got = {r["seller_id"]: r for r in reports.seller_performance(fi, ds, fo).collect()}
    assert (got["s1"]["order_count"], got["s1"]["items_sold"]) == (3, 4)
    assert got["s1"]["product_revenue"] == D("98.00")


def test_summary_counts_real_customers(facts):
    fo, *_ = facts
    s = reports.dashboard_summary(fo).first()
    assert s["delivered_orders"] == 3 and s["customers"] == 2
    assert s["average_delivery_days"] == D("2.25")
    assert s["late_delivery_rate"] == D("0.5000")


def test_top_k_ties_break_on_the_name(spark):
    cp = spark.createDataFrame([(c, 1, 1, D("10.00"), None) for c in ("b", "a", "c")],
                               "product_category_name string, items_sold long, order_count long, "
                               "product_revenue decimal(16,2), average_review_score decimal(3,2)")
    assert [r[0] for r in reports.category_top(cp, 2).collect()] == ["a", "b"]


def test_children_are_aggregated_before_the_join(spark):
    orders = spark.createDataFrame(
        [("o1", "c1", "delivered", _ts("2017-01-01 00:00:00"), None, _ts("2017-01-03 12:00:00"),
          _ts("2017-01-02 00:00:00"))],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
        "order_approved_at timestamp_ntz, order_delivered_customer_date timestamp_ntz, "
        "order_estimated_delivery_date timestamp_ntz")
    cust = spark.createDataFrame([("c1", "u1", "SP")], "customer_id string, customer_unique_id string, "
                                 "customer_state string")
    items = spark.createDataFrame([("o1", D("1.00"), D("0.50")), ("o1", D("2.00"), D("0.50"))],
                                  "order_id string, price decimal(12,2), freight_value decimal(12,2)")
    pays = spark.createDataFrame([("o1", D("2.00")), ("o1", D("2.00"))], "order_id string, payment_value decimal(12,2)")
    revs = spark.createDataFrame([("o1", 4), ("o1", 5)], "order_id string, review_score int")
    f = marts.fact_orders(orders, cust, items, pays, revs, None).collect()
    assert len(f) == 1
    r = f[0]
    assert (r["item_count"], r["product_value"], r["freight_value"], r["payment_value"]) == \
        (2, D("3.00"), D("1.00"), D("4.00"))
    assert r["average_review_score"] == D("4.50")
    assert r["delivery_days"] == D("2.50") and r["is_late"] is True
