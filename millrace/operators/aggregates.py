"""Sales aggregates over facts that carry ``amount_cents``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.functions.hashing import hash_mod
from millrace.functions.money import from_cents, half_up_div, mean_amount


def sale_partials(*extra_sums: str) -> list[Column]:
    """Mergeable measures: row count, non-null amounts, cents and further sums."""
    return [
        F.count(F.lit(1)).alias("sale_count"),
        F.count("amount_cents").alias("amount_count"),
        F.sum("amount_cents").alias("amount_cents"),
        *[F.sum(name).alias(name) for name in extra_sums],
    ]


def merge_partials(*extra_sums: str) -> list[Column]:
    names = ("sale_count", "amount_count", "amount_cents", *extra_sums)
    return [F.sum(name).alias(name) for name in names]


def gross_amount() -> Column:
    return from_cents(F.col("amount_cents")).alias("gross_sales_amount")


def average_amount() -> Column:
    return mean_amount(F.col("amount_cents"), F.col("amount_count")).alias("average_sale_amount")


def salted_aggregate(
    df: DataFrame,
    keys: list[str],
    partials: list[Column],
    merges: list[Column],
    spread_by: Column,
    salts: int,
) -> DataFrame:
    """Two-step aggregate: by key and salt, then by key. Rows of a hot key meet in
    ``salts`` groups before they meet in one."""
    salt = hash_mod(spread_by, modulo=salts, seed=salts)
    first = df.withColumn("_salt", salt).groupBy(*keys, "_salt").agg(*partials)
    return first.groupBy(*keys).agg(*merges)


def exact_median(df: DataFrame, keys: list[str], value: str, block: int = 4096) -> DataFrame:
    """Exact median of an integer column per key, without one task holding a key.

    Values are counted first, then the counts are rolled up into blocks of
    neighbouring values. Ranking the blocks finds the one or two that hold the
    middle ranks, and only those blocks are opened.
    """
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("block", F.floor(F.col(value) / F.lit(block)))
    )
    per_key = Window.partitionBy(*keys)
    upto = per_key.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blocks = (
        counted.groupBy(*keys, "block")
        .agg(F.sum("n").alias("block_rows"))
        .withColumn("before", F.sum("block_rows").over(upto) - F.col("block_rows"))
        .withColumn("total", F.sum("block_rows").over(per_key))
    )
    low = F.call_function("div", F.col("total") - 1, F.lit(2))
    high = F.call_function("div", F.col("total"), F.lit(2))
    end = F.col("before") + F.col("block_rows")
    middle = blocks.where(
        ((low >= F.col("before")) & (low < end)) | ((high >= F.col("before")) & (high < end))
    ).select(*keys, "block", "before", "total")
    inside = (
        Window.partitionBy(*keys, "block")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    last = F.col("before") + F.sum("n").over(inside)
    ranked = counted.join(middle, on=[*keys, "block"]).select(
        *keys, value, "total", (last - F.col("n")).alias("first_rank"), last.alias("end_rank")
    )
    holds_low = (low >= F.col("first_rank")) & (low < F.col("end_rank"))
    holds_high = (high >= F.col("first_rank")) & (high < F.col("end_rank"))
    return ranked.groupBy(*keys).agg(
        (
            (
                F.max(F.when(holds_low, F.col(value)))
                + F.max(F.when(holds_high, F.col(value)))
            ).cast("double")
            / F.lit(2.0)
        ).alias("median")
    )


def key_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))


def top_key(df: DataFrame, key: str) -> DataFrame:
    """One row: the most frequent key (smallest on a tie, null last), its rows and its share.
    A null key stays null. For an empty input the key is null, rows and share are zero."""
    counted = key_counts(df, key)
    order = F.struct(
        (-F.col("row_count")).alias("few"),
        F.col(key).isNull().alias("unknown"),
        F.col(key).alias("key"),
        "row_count",
    )
    best = F.min(order)
    return counted.agg(best.alias("best"), F.sum("row_count").alias("total")).select(
        F.col("best.key").alias(f"top_{key}"),
        F.coalesce(F.col("best.row_count"), F.lit(0).cast("long")).alias("top_rows"),
        F.coalesce(
            F.col("best.row_count").cast("double") / F.col("total").cast("double"), F.lit(0.0)
        ).alias("top_share"),
    )


def key_rows_share(df: DataFrame, key: str, value: int) -> DataFrame:
    """One row: rows and share of one key value; zeros when it does not occur."""
    return df.agg(
        F.count_if(F.col(key) == value).alias("hot_rows"), F.count(F.lit(1)).alias("total_rows")
    ).select(
        F.lit(value).cast("long").alias(key),
        "hot_rows",
        "total_rows",
        F.coalesce(
            F.when(
                F.col("total_rows") > 0,
                F.col("hot_rows").cast("double") / F.col("total_rows").cast("double"),
            ),
            F.lit(0.0),
        ).alias("hot_share"),
    )


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values held by more than one row; null keys group together."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)
    )


def average_ticket(revenue_cents: Column, rows: Column) -> Column:
    """Revenue, already rounded to cents, per row with four decimals."""
    return half_up_div(revenue_cents * F.lit(100), rows).cast("double") / F.lit(10000.0)
