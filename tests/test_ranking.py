from pyspark.sql import Window
from pyspark.sql import functions as F

from ordermart.operators.ranking import row_number_by

SLICES = ["l_linenumber", "part_slice"]
KEYS = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate", "l_discount", "l_tax"]


def _lineitem(spark):
    return spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", *KEYS, (F.col("l_partkey") % 1000).alias("part_slice"))


def _same_as_window(df, group):
    w = Window.partitionBy(group).orderBy(*SLICES, *KEYS, "rn")
    return row_number_by(df, group, SLICES, KEYS, "rn").withColumn("want", F.row_number().over(w)).where("rn <> want").count() == 0


def test_equals_the_plain_window(spark):
    li = _lineitem(spark)
    assert _same_as_window(li, "l_orderkey")
    assert row_number_by(li, "l_orderkey", SLICES, KEYS, "rn").count() == li.count()


def test_hot_group_and_null_keys(spark):
    li = _lineitem(spark).withColumns({
        "g": F.when(F.col("l_orderkey") % 3 == 0, 1), "l_linenumber": F.when(F.col("l_linenumber") != 4, F.col("l_linenumber"))})
    assert _same_as_window(li, "g")


def test_no_window_sees_a_whole_group(spark):
    out = row_number_by(_lineitem(spark), "l_orderkey", SLICES, KEYS, "rn")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 3
    assert sum("row_number()" in w for w in windows) == 1  # inside the innermost pieces
    assert all("sum(" in w for w in windows if "row_number()" not in w)  # the others see counts


def test_small_and_cut_groups_side_by_side(spark):
    li = _lineitem(spark).withColumn("g", F.when(F.col("l_orderkey") % 3 == 0, 1).otherwise(F.col("l_orderkey") % 500))
    w = Window.partitionBy("g").orderBy(*SLICES, *KEYS, "rn")
    for most in (1, 60, 10**9):
        got = row_number_by(li, "g", SLICES, KEYS, "rn", most=most).withColumn("want", F.row_number().over(w))
        assert got.where("rn <> want").count() == 0 and got.count() == li.count()


def test_unread_numbers_cost_nothing(spark):
    out = row_number_by(_lineitem(spark), "l_orderkey", SLICES, KEYS, "rn").groupBy("l_orderkey").agg(F.sum("l_tax"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan
