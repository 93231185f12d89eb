"""Ranks, global order and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.sources.artifacts import Artifact, read_artifact, write_artifact


def revenue_rank(df: DataFrame) -> DataFrame:
    """Dense rank of categories by revenue inside vendor region, customer region
    and month. It runs after the aggregate: a partition has one row per category."""
    inside = Window.partitionBy("vendor_region", "customer_region", "sale_year_month").orderBy(
        F.desc("gross_sales_amount"), F.asc("category_id")
    )
    return df.withColumn("revenue_rank_in_region", F.dense_rank().over(inside))


def top_n(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    """First n rows per group with their rank. The bound on row_number lets Spark
    cut each task's groups to n rows before the shuffle."""
    ranked = df.withColumn(
        "outlier_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    )
    return ranked.where(F.col("outlier_rank") <= n)


def sales_by_amount(sales: DataFrame, *tie_breaks: str, limit: int | None = None) -> DataFrame:
    """Largest sales first. With a limit Spark keeps only the top rows of each
    task; without one it range-partitions the whole table."""
    ordered = sales.orderBy(F.desc("sale_amount"), F.asc("sale_id"), *map(F.asc, tie_breaks))
    return ordered if limit is None else ordered.limit(limit)


def global_rank(df: DataFrame, order: Sequence[Column], target: Artifact) -> DataFrame:
    """All rows with their place in one global order, from 1, as ``global_rank``.

    Rows are dealt by ranges of the order, sorted in each task and written to ``target``, so
    no task holds more than its range. The written rows carry their task and place in it; the
    rows of all earlier tasks are added from one count a task. Ranks come from the stored
    table and stay the same if a task is run again. Without ties in ``order`` the ranks are
    unique to the rows; rows alike in it share consecutive ranks in any order.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({"_place": F.monotonically_increasing_id(), "_part": F.spark_partition_id()})
    )
    write_artifact(placed, target)
    stored = read_artifact(df.sparkSession, target, placed.schema)
    parts = stored.groupBy("_part").agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    # One row a task of the sort, and so never more than its partitions.
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = parts.select(
        "_part", (F.sum("_rows").over(upto) - F.col("_rows") - F.col("_first") + 1).alias("_shift")
    )
    ranked = stored.join(F.broadcast(offsets), "_part")
    return ranked.withColumn("global_rank", F.col("_place") + F.col("_shift")).drop(
        "_part", "_place", "_shift"
    )
