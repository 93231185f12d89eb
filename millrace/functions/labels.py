"""Labels and widths derived from fact columns."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "UNKNOWN"
NO_CATEGORY = -1


def month_of(day: Column) -> Column:
    """First day of the month: a cheap four-byte grouping key. Formatting a date costs
    far more, so it is left for the finished rows."""
    return F.trunc(day, "month")


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def or_unknown(text: Column) -> Column:
    return F.coalesce(text, F.lit(UNKNOWN))


def or_no_category(category: Column) -> Column:
    return F.coalesce(category.cast("long"), F.lit(NO_CATEGORY).cast("long"))


def category_label(category: Column) -> Column:
    """``category_07``; numbers of more digits keep them all."""
    return F.concat(F.lit("category_"), padded(or_no_category(category), 2))


def numbered(prefix: str, number: Column, digits: int) -> Column:
    return F.concat(F.lit(prefix), padded(number, digits))


def padded(number: Column, digits: int) -> Column:
    """Zeros in front up to so many characters; lpad alone would cut longer numbers."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(digits)), F.lit("0"))


def payload_columns(df: DataFrame) -> list[str]:
    return [name for name in df.columns if name.startswith("payload_")]


def payload_width(df: DataFrame) -> Column:
    """Characters over all payload columns; nulls count as nothing."""
    names = payload_columns(df)
    if not names:
        return F.lit(0).cast("long")
    return F.length(F.concat_ws("", *[F.col(name) for name in names])).cast("long")


def any_of(conditions: list[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


def joined_names(*pairs: tuple[str, Column]) -> Column:
    """Comma-separated names whose condition holds, in the given order."""
    return F.concat_ws(",", *[F.when(condition, F.lit(name)) for name, condition in pairs])
