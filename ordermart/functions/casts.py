"""Typed casts and exact aggregates.

The source system keeps money in fixed-point and rounds half away from zero.
Spark's DECIMAL casts already round HALF_UP (away from zero) and abort on
overflow under ANSI mode, so most rules are one cast; the traps are:

* text -> INTEGER through NUMERIC rounds ('2.5' -> 3); a direct cast of
  '1.0' must abort, so the two paths are separate helpers.
* ``avg`` of a narrow decimal is computed at scale s+4 and would round twice
  when cast to the published scale; widening the input to 14 fractional
  digits first keeps the result exact for any realistic row count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WIDE = T.DecimalType(28, 14)
MICROS_PER_DAY = 86_400_000_000


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def text_to_int_strict(c: Column) -> Column:
    """'40' -> 40, '1.0' -> error (ANSI)."""
    return c.cast(T.IntegerType())


def text_to_int_rounded(c: Column) -> Column:
    """Text through unbounded NUMERIC to INTEGER: rounds half away from zero,
    once. The widest decimal that holds an INTEGER keeps 28 fractional digits;
    text with more aborts, as it might round twice."""
    value = F.round(c.cast(T.DecimalType(38, 28)), 0).cast(T.IntegerType())
    return F.when(c.rlike(r"\.[0-9]{29}"), F.raise_error(F.concat(F.lit("more than 28 fractional digits: "), c))).otherwise(value)


def text_to_decimal(c: Column, dtype: T.DecimalType) -> Column:
    return c.cast(dtype)


# a whole date, and a time if any: Spark's own cast would also take a year or a month
TIMESTAMP_TEXT = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T][0-9]{1,2}:[0-9]{1,2}(:[0-9]{1,2}(\.[0-9]*)?)?)?\s*$"


def text_to_timestamp(c: Column) -> Column:
    """'2017-01-31 10:00:00' -> TIMESTAMP_NTZ; '2017' and '2017-01' abort."""
    return (F.when(c.isNull() | c.rlike(TIMESTAMP_TEXT), c.cast(T.TimestampNTZType()))
            .otherwise(F.raise_error(F.concat(F.lit("not a timestamp: "), c))))


def decimal_avg(c: Column, dtype: T.DecimalType) -> Column:
    """AVG(x)::NUMERIC(p,s) without double rounding; NULLs ignored."""
    return F.avg(c.cast(WIDE)).cast(dtype)


def rate_avg(flag: Column, dtype: T.DecimalType) -> Column:
    """AVG(bool::int)::NUMERIC(p,s): share of TRUE among non-NULL flags."""
    return decimal_avg(flag.cast(T.IntegerType()), dtype)


def epoch_days(end: Column, start: Column, dtype: T.DecimalType) -> Column:
    """EXTRACT(EPOCH FROM end - start) / 86400 as NUMERIC(p,s)."""
    micros = F.timestamp_diff("MICROSECOND", start, end).cast(T.DecimalType(20, 0))
    return (micros / F.lit(MICROS_PER_DAY).cast(T.DecimalType(11, 0))).cast(dtype)


def month_start(ts: Column) -> Column:
    """DATE_TRUNC('month', ts)::DATE (a DATE, independent of the session zone)."""
    return F.trunc(ts.cast(T.DateType()), "MM")


def presentable(df: DataFrame) -> DataFrame:
    """Published representation of a result: money and ratios as DOUBLE,
    calendar days as midnight timestamps (the way the JSON export renders
    them), and three-valued flags as DOUBLE 1 / 0 / NULL (the way a pandas
    reader hands over a nullable column). Stored tables keep DECIMAL, DATE
    and BOOLEAN; this is only the hand-off."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DecimalType, T.BooleanType)):
            cols.append(F.col(f.name).cast(T.DoubleType()).alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            cols.append(F.col(f.name).cast(T.TimestampNTZType()).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
