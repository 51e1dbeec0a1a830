"""Column expressions shared by the layers (all built-in, JVM side)."""

from ordermart.functions.casts import (  # noqa: F401
    blank_to_null,
    decimal_avg,
    epoch_days,
    month_start,
    presentable,
    rate_avg,
    text_to_decimal,
    text_to_int_rounded,
    text_to_int_strict,
    text_to_timestamp,
)
