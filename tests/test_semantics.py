"""Small-frame checks of the traps listed for the models."""

from decimal import Decimal
from decimal import Decimal as D

from pyspark.sql import functions as F

from ordermart.operators import constraints, marts, quality, reports, staging
from ordermart.operators.ledger import Ledger


def test_mode_tie_takes_smallest_and_ignores_null(spark):
    raw = spark.createDataFrame(
        [("01037", "1.0", "2.0", c, "SP") for c in ("b", "a", "a", "b", None)],
        "geolocation_zip_code_prefix string, geolocation_lat string, geolocation_lng string, "
        "geolocation_city string, geolocation_state string").withColumn("loaded_at", F.current_timestamp())
    r = staging.stg_geolocation(raw, None).first()
    assert r["geolocation_city"] == "a"


def test_same_timestamp_orders_larger_order_id_wins(spark):
    cust = spark.createDataFrame([("c1", "u1", "11111", "x", "AA"), ("c2", "u1", "22222", "y", "BB")],
                                 "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
                                 "customer_city string, customer_state string")
    orders = spark.createDataFrame([("o1", "c1"), ("o2", "c2")], "order_id string, customer_id string") \
        .withColumn("order_purchase_timestamp", F.lit("2020-01-01 00:00:00").cast("timestamp_ntz"))
    d = marts.dim_customers(cust, orders, None).first()
    assert d["latest_zip_code_prefix"] == "22222" and d["lifetime_order_count"] == 2
    r = marts.customer_order_rank(cust, orders).first()
    assert r["order_id"] == "o2"


def test_check_passes_on_null_and_zip_needs_exact_match(spark):
    stg = spark.createDataFrame(
        [("c1", "u", "01037\n", "x", "SP"), ("c2", "u", "01037", "x", None)],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
        "customer_city string, customer_state string") \
        .withColumn("source_loaded_at", F.current_timestamp()).withColumn("staged_at", F.current_timestamp())
    ledger = Ledger({"staging.customers": stg})
    items = [m for m in constraints.measures(ledger, ["staging"]) if m[0] == "staging.customers"]
    for other in [t for t in ledger.plain if t != "staging.customers"]:
        del ledger.plain[other]
    ledger.facts = {"customer_id": [("surplus", "staging.customers")]}
    ledger.carriers = {"customer_id": {"staging.customers": ("customer_id",)}}
    row = ledger.frame(spark).select(*[m().alias(n) for _, n, m in items]).first().asDict()
    got = {n: v for n, v in row.items()}
    assert got["CHECK (customer_zip_code_prefix ~ zip)"] == 1   # trailing newline rejected
    assert got["CHECK (customer_state ~ state)"] == 0           # NULL passes a CHECK
    assert got["NOT NULL (customer_state)"] == 1


def test_distinct_pair_with_null(spark):
    df = spark.createDataFrame([("1", None), ("1", None), ("1", "2")], "order_id string, order_item_id string")
    raw = {t: None for t, _, _ in quality.RAW_KEYS}
    raw["order_items"] = df
    parts = [(label, t, cols) for label, t, cols in quality.RAW_KEYS if t == "order_items"]
    saved = quality.RAW_KEYS
    try:
        quality.RAW_KEYS = tuple(parts)
        r = quality.raw_key_profile(raw).first()
    finally:
        quality.RAW_KEYS = saved
    assert r["null_key_rows"] == 2 and r["duplicate_key_rows"] == 1


def test_empty_input_summary_and_null_reconciliation_fails(spark):
    fo = spark.createDataFrame([], "order_id string, customer_unique_id string, order_status string, "
                                   "order_purchase_timestamp timestamp_ntz, payment_value decimal(14,2), "
                                   "average_review_score decimal(3,2), is_late boolean, delivery_days decimal(10,2)")
    s = reports.dashboard_summary(fo).collect()
    assert len(s) == 1 and s[0]["delivered_orders"] == 0 and s[0]["revenue"] is None
    ledger = Ledger({"facts": fo})
    checks = [quality.Check("sum over empty", ledger.aggregate("facts", F.sum("payment_value")))]
    r = quality.run_checks(spark, ledger, checks, __import__("pyspark.sql.types", fromlist=["x"]).DecimalType(38, 2)).first()
    assert r["actual"] is None and r["status"] == "FAIL"


def test_warn_vs_fail(spark):
    from pyspark.sql import types as T

    ledger = Ledger({"one": spark.range(1).select(F.lit(3).alias("x"))})
    checks = [quality.Check("w", ledger.aggregate("one", F.max("x")), quality.WARN),
              quality.Check("f", ledger.aggregate("one", F.max("x"))),
              quality.Check("p", ledger.aggregate("one", F.max("x") - 3))]
    got = {r["name"]: r["status"] for r in quality.run_checks(spark, ledger, checks, T.LongType()).collect()}
    assert got == {"w": "WARN", "f": "FAIL", "p": "PASS"}


def test_state_share_and_bars_sum(spark):
    sp = spark.createDataFrame([("SP", 3, Decimal("75.00")), ("RJ", 1, Decimal("25.00"))],
                               "customer_state string, order_count long, revenue decimal(16,2)")
    got = {r["customer_state"]: r["revenue_share"] for r in reports.state_share(sp).collect()}
    assert got == {"SP": Decimal("0.7500"), "RJ": Decimal("0.2500")}


def test_key_domain_counts(spark):
    """Repeats, surplus rows and orphans of one shuffle, NULL keys included."""
    ledger = Ledger({"p": spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "k string"),
                     "c": spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "f string"),
                     "none": spark.createDataFrame([], "k string")})
    m = {"repeated": ledger.repeated("k", "p", "k"), "surplus": ledger.surplus("k", "p", "k"),
         "distinct": ledger.distinct("k", "p", "k"), "orphans": ledger.orphans("k", "c", "f", "p", "k"),
         "foreign": ledger.orphans("k", "c", "f", "p", "k", nulls=False),
         "back": ledger.orphans("k", "p", "k", "c", "f"), "rows": ledger.rows("c"),
         "empty": ledger.surplus("empty", "none", "k")}
    row = ledger.frame(spark).select(*[v().alias(k) for k, v in m.items()]).first().asDict()
    assert row == {"repeated": 2, "surplus": 4, "distinct": 2, "orphans": 3, "foreign": 2, "back": 3, "rows": 4, "empty": 0}


def test_insights_take_the_earliest_of_tied_months(spark):
    import datetime as dt

    monthly = spark.createDataFrame(
        [(dt.date(2020, m, 1), n, D(r), D("24.00"), D("4.00"), D(late)) for m, n, r, late in
         ((1, 100, "10", "0.1"), (2, 100, "50", "0.5"), (3, 120, "50", "0.5"), (4, 99, "900", "0.9"))],
        "order_month date, order_count long, revenue decimal(16,2), average_order_value decimal(12,2), "
        "average_review_score decimal(3,2), late_delivery_rate decimal(7,4)")
    states = spark.createDataFrame([("SP", 3, D("75"), D("0.2")), ("RJ", 1, D("75"), D("0.1"))],
                                   "customer_state string, order_count long, revenue decimal(16,2), late_delivery_rate decimal(7,4)")
    cats = spark.createDataFrame([("b_c", 5, D("9"), D("4")), ("a_b", 4, D("9"), D("3"))],
                                 "product_category_name string, items_sold long, product_revenue decimal(16,2), "
                                 "average_review_score decimal(3,2)")
    summary = spark.createDataFrame([(D("0.3000"),)], "late_delivery_rate decimal(7,4)")
    got = [(r.insight, r.subject, r.above_overall) for r in reports.insights(summary, monthly, cats, states).collect()]
    assert got == [("peak_revenue_month", "February 2020", True), ("worst_late_month", "February 2020", True),
                   ("leading_state", "RJ", False), ("leading_category", "a b", None)]
    low = {r.insight: r.subject for r in reports.insights(summary, monthly, cats, states, least_orders=10).collect()}
    assert low["peak_revenue_month"] == low["worst_late_month"] == "April 2020"


def test_limits_bite(spark):
    cats = spark.createDataFrame([(f"c{i:02}", 1, 1, D(i % 12), D("4")) for i in range(20)],
                                 "product_category_name string, items_sold long, order_count long, product_revenue decimal(16,2), "
                                 "average_review_score decimal(3,2)")
    assert [r.category_label for r in reports.category_bars(cats).collect()] == [
        "c11", "c10", "c09", "c08", "c07", "c19", "c06", "c18", "c05", "c17"]
    assert len(reports.category_top(cats, 15).collect()) == 15
    states = spark.createDataFrame([(f"S{i:02}", 1, D(i // 2), D("0.1")) for i in range(14)],
                                   "customer_state string, order_count long, revenue decimal(16,2), late_delivery_rate decimal(7,4)")
    assert [r.customer_state for r in reports.state_top10(states).collect()] == [
        "S12", "S13", "S10", "S11", "S08", "S09", "S06", "S07", "S04", "S05"]


def test_planted_defects_reach_every_constraint_family(spark):
    from ordermart.plans.catalog import QUERIES

    sf = "/root/testdata/sf0.01"
    rows = QUERIES["constraint_violations_dirty"](spark, sf).collect()
    for family in ("PRIMARY KEY", "FOREIGN KEY", "NOT NULL", "CHECK"):
        assert sum(r.violations for r in rows if r.constraint_name.startswith(family)) > 0
    checks = {r["check_order"]: r["actual"] for r in QUERIES["staging_quality_dirty"](spark, sf).collect()}
    assert all(checks[i] > 0 for i in range(8, 22))
    assert {r.key_name for r in QUERIES["raw_key_profile_dirty"](spark, sf).collect() if r.duplicate_key_rows} >= {
        "customers.customer_id", "orders.order_id", "order_items.(order_id, order_item_id)", "products.product_id"}
    assert len(QUERIES["insights_small_months"](spark, sf).collect()) == 4
