"""Exact money arithmetic on integer cents.

Amounts carry two decimals. Summing them as doubles makes the result depend on
the order of the partial sums, so facts carry ``bigint`` cents and only the
finished value becomes a double again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_cents(amount: Column) -> Column:
    return F.rint(amount.cast("double") * F.lit(100.0)).cast("long")


def from_cents(cents: Column) -> Column:
    return cents.cast("double") / F.lit(100.0)


def half_up_div(numerator: Column, denominator: Column) -> Column:
    """Integer division rounded half away from zero; null unless denominator > 0."""
    size = F.call_function(
        "div", F.abs(numerator) * F.lit(2) + denominator, denominator * F.lit(2)
    )
    return F.when(
        denominator > 0, F.when(numerator < 0, -size).otherwise(size)
    )


def mean_amount(total_cents: Column, rows: Column) -> Column:
    """Average of two-decimal amounts, rounded to two decimals."""
    return from_cents(half_up_div(total_cents, rows))
