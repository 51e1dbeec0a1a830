"""Property checks of the exact rounding helpers against Python Decimal."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermart.functions import decimal_avg, epoch_days, text_to_decimal, text_to_int_rounded

SETTINGS = settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
cents = st.integers(min_value=-10**9, max_value=10**9)


def _half_up(x: Decimal, places: str) -> Decimal:
    return x.quantize(Decimal(places), rounding=ROUND_HALF_UP)  # half away from zero


@SETTINGS
@given(st.lists(st.one_of(st.none(), cents), min_size=1, max_size=40))
def test_decimal_avg_is_exact_half_up(spark, values):
    df = spark.createDataFrame([(None if v is None else Decimal(v) / 100,) for v in values], "v decimal(14,2)")
    got = df.agg(decimal_avg(F.col("v"), T.DecimalType(16, 2)).alias("a")).first()["a"]
    present = [Decimal(v) / 100 for v in values if v is not None]
    want = _half_up(sum(present) / len(present), "0.01") if present else None
    assert got == want


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.booleans()), min_size=1, max_size=40))
def test_rate_is_exact_half_up(spark, flags):
    from ordermart.functions import rate_avg

    df = spark.createDataFrame([(f,) for f in flags], "f boolean")
    got = df.agg(rate_avg(F.col("f"), T.DecimalType(7, 4)).alias("r")).first()["r"]
    known = [f for f in flags if f is not None]
    want = _half_up(Decimal(sum(known)) / len(known), "0.0001") if known else None
    assert got == want


@SETTINGS
@given(st.integers(min_value=-40 * 86_400_000_000, max_value=400 * 86_400_000_000))
def test_epoch_days_is_exact_half_up(spark, micros):
    start = dt.datetime(2017, 1, 1)
    end = start + dt.timedelta(microseconds=micros)
    df = spark.createDataFrame([(start, end)], "a timestamp_ntz, b timestamp_ntz")
    got = df.select(epoch_days(F.col("b"), F.col("a"), T.DecimalType(10, 2)).alias("d")).first()["d"]
    assert got == _half_up(Decimal(micros) / Decimal(86_400_000_000), "0.01")


@SETTINGS
@given(st.integers(min_value=-10**7, max_value=10**7), st.integers(min_value=0, max_value=999))
def test_text_casts_round_half_away(spark, whole, frac):
    text = f"{whole}.{frac:03d}"
    df = spark.createDataFrame([(text,)], "x string")
    r = df.select(text_to_decimal(F.col("x"), T.DecimalType(12, 2)).alias("d"),
                  text_to_int_rounded(F.col("x")).alias("i")).first()
    exact = Decimal(text)
    assert r["d"] == _half_up(exact, "0.01")
    assert r["i"] == int(_half_up(exact, "1"))
