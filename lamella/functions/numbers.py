"""Exact rounding on decimals; doubles would round halves differently on every engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def ratio(num: Column, den: Column, places: int) -> Column:
    """``num / den`` rounded half up; null where ``den`` is null or zero.

    Both sides become decimals first, so the quotient has 14 digits and exact halves stay exact.
    """
    quotient = F.try_divide(num.cast("decimal(24,2)"), den.cast("decimal(20,2)"))
    return F.round(quotient, places).cast("double")


def percent(num: Column, den: Column, places: int = 2) -> Column:
    return ratio(num.cast("decimal(22,2)") * 100, den, places)


def safe_decimal(c: Column, kind: str = MONEY) -> Column:
    """Text to decimal; null instead of an error when it is no number."""
    return F.trim(c).try_cast(kind)


def amount(c: Column, zero_is_null: Column | bool = False) -> Column:
    """Money text such as ``$1,234.50`` to decimal(18,2), keeping a minus sign."""
    digits = F.nullif(F.regexp_replace(c.cast("string"), "[^0-9.-]", ""), F.lit(""))
    value = digits.try_cast(MONEY)
    zero_is_null = F.lit(zero_is_null) if isinstance(zero_is_null, bool) else zero_is_null
    return F.when(~(zero_is_null & (value == 0)), value)
