import __spark_entry__ as entry


def test_category_bars_compute_the_view_once(spark):
    bars = entry.queries()["category_bars"](spark, "/root/testdata/sf0.001")
    plan = bars._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_extendedprice") and "scalar-subquery" not in plan
    assert sum("Relation" in line and "l_orderkey" in line for line in plan.splitlines()) == 1
