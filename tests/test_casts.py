from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermart.functions import (
    decimal_avg,
    epoch_days,
    month_start,
    text_to_decimal,
    text_to_int_rounded,
    text_to_int_strict,
    text_to_timestamp,
)


def _one(spark, col, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("y")).first()["y"]


def test_int_through_numeric_rounds_half_away(spark):
    assert _one(spark, text_to_int_rounded(F.col("x")), "40.0") == 40
    assert _one(spark, text_to_int_rounded(F.col("x")), "2.5") == 3
    assert _one(spark, text_to_int_rounded(F.col("x")), "-2.5") == -3


def test_int_direct_rejects_fraction(spark):
    with pytest.raises(Exception):
        _one(spark, text_to_int_strict(F.col("x")), "1.0")
    assert _one(spark, text_to_int_strict(F.col("x")), "7") == 7


def test_decimal_rounding_and_overflow(spark):
    m = T.DecimalType(12, 2)
    assert _one(spark, text_to_decimal(F.col("x"), m), "1.005") == Decimal("1.01")
    assert _one(spark, text_to_decimal(F.col("x"), m), "-1.005") == Decimal("-1.01")
    assert _one(spark, text_to_decimal(F.col("x"), m), "10.005") == Decimal("10.01")
    with pytest.raises(Exception):
        _one(spark, text_to_decimal(F.col("x"), m), "12345678901")


def test_decimal_avg_does_not_round_twice(spark):
    # 0.01 once and 0.00 many times: the mean is just below 0.005 for n > 2
    rows = [(Decimal("0.01"),)] + [(Decimal("0.00"),)] * 2000
    df = spark.createDataFrame(rows, "v decimal(12,2)")
    got = df.agg(decimal_avg(F.col("v"), T.DecimalType(12, 2)).alias("a")).first()["a"]
    assert got == Decimal("0.00")
    # exactly half a cent rounds away from zero
    df2 = spark.createDataFrame([(Decimal("0.01"),), (Decimal("0.00"),)], "v decimal(12,2)")
    assert df2.agg(decimal_avg(F.col("v"), T.DecimalType(12, 3)).alias("a")).first()["a"] == Decimal("0.005")
    assert df2.agg(decimal_avg(F.col("v"), T.DecimalType(12, 2)).alias("a")).first()["a"] == Decimal("0.01")


def test_avg_ignores_nulls(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "v int")
    got = df.agg(decimal_avg(F.col("v"), T.DecimalType(3, 2)).alias("a")).first()["a"]
    assert got == Decimal("1.50")


def test_epoch_days(spark):
    df = spark.createDataFrame([("2020-01-01 00:00:00", "2020-01-13 13:30:00")], "a string, b string")
    got = df.select(epoch_days(F.col("b").cast("timestamp_ntz"), F.col("a").cast("timestamp_ntz"),
                               T.DecimalType(10, 2)).alias("d")).first()["d"]
    assert got == Decimal("12.56")


def test_month_start_is_a_date(spark):
    df = spark.createDataFrame([("2017-11-30 23:59:59",)], "a string")
    r = df.select(month_start(F.col("a").cast("timestamp_ntz")).alias("m"))
    assert isinstance(r.schema["m"].dataType, T.DateType)
    assert str(r.first()["m"]) == "2017-11-01"


def test_int_through_numeric_rounds_once(spark):
    assert _one(spark, text_to_int_rounded(F.col("x")), "2.49999999999") == 2
    assert _one(spark, text_to_int_rounded(F.col("x")), "-2.4999999999999999999999999999") == -2
    assert _one(spark, text_to_int_rounded(F.col("x")), "2147483647.4") == 2147483647
    for text in ("2." + "4" * 29, "2147483648", "abc"):
        with pytest.raises(Exception):
            _one(spark, text_to_int_rounded(F.col("x")), text)
    assert spark.createDataFrame([(None,)], "x string").select(text_to_int_rounded(F.col("x"))).first()[0] is None


def test_timestamps_need_a_whole_date(spark):
    import datetime as dt

    for text, want in (("2017-01-31 10:00:00", dt.datetime(2017, 1, 31, 10)), ("2017-01-31", dt.datetime(2017, 1, 31)),
                       ("2017-1-3T04:05:06.5", dt.datetime(2017, 1, 3, 4, 5, 6, 500000))):
        assert _one(spark, text_to_timestamp(F.col("x")), text) == want
    for text in ("2017", "2017-01", "", "10:00:00", "2017-13-01"):
        with pytest.raises(Exception):
            _one(spark, text_to_timestamp(F.col("x")), text)
    assert spark.createDataFrame([(None,)], "x string").select(text_to_timestamp(F.col("x"))).first()[0] is None
