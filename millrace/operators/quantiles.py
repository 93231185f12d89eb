"""Exact quantiles of many groups at once, of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

#: A value's 64 bits are opened 16 at a time, highest first.
STEP_BITS = 16


def _held(ranks: Column, before: Column, rows: Column) -> Column:
    """The wanted ranks counted from a block's first row, null for those outside of it."""
    return F.transform(ranks, lambda r: F.when((r > before) & (r <= before + rows), r - before))


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, per_mille: dict[str, int]
) -> DataFrame:
    """Values at ranks of an integer column, one row per key with a column for each name.

    ``per_mille`` maps a column name to its quantile in thousandths. The quantile is the
    smallest value that at least that share of the rows doesn't exceed, so a value of the
    data. Nulls are left out; a key without any other value has no row. A null in a key is a
    key like others.

    Values are counted first. Their counts are rolled up into blocks of values with the same
    high bits, each level from the one below it, and the blocks of a key are ranked. Only those
    with a wanted rank are opened, by the next 16 bits. So a window never holds more than 65,536
    rows, however many rows or values a key has, and no raw rows are shuffled but as counts.
    The counted values are read twice, for their blocks and once these are opened, and no row
    carries more than a number for each rank.
    """
    # Known to be without nulls, the counts need no filter in any join, so that all readers
    # share one shuffle.
    known = F.coalesce(F.col(value).cast("long"), F.lit(0).cast("long"))
    counted = (
        df.where(F.col(value).isNotNull())
        .select(F.struct(*keys).alias("_key"), known.alias("_value"))
        .groupBy("_key", "_value")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    levels = [counted.withColumnRenamed("_value", "_block")]
    for _ in range(STEP_BITS, 64, STEP_BITS):
        block = F.shiftright("_block", STEP_BITS).alias("_block")
        levels.append(levels[-1].groupBy("_key", block).agg(F.sum("_rows").alias("_rows")))
    total = F.sum("_rows").over(Window.partitionBy("_key"))
    wanted = [
        F.greatest(F.lit(1), F.call_function("div", total * share + 999, F.lit(1000)))
        for share in per_mille.values()
    ]
    blocks = levels.pop().withColumns({"_parent": F.lit(0), "_ranks": F.array(*wanted)})
    upto = (
        Window.partitionBy("_key", "_parent")
        .orderBy("_block")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    while True:
        ranked = blocks.withColumn("_before", F.sum("_rows").over(upto) - F.col("_rows"))
        held = _held(F.col("_ranks"), F.col("_before"), F.col("_rows"))
        opened = ranked.select("_key", F.col("_block").alias("_parent"), held.alias("_ranks"))
        opened = opened.where(F.exists("_ranks", F.isnotnull))
        if not levels:
            break
        parent = F.shiftright("_block", STEP_BITS)
        blocks = levels.pop().withColumn("_parent", parent).join(opened, ["_key", "_parent"])
    return (
        opened.groupBy("_key")
        .agg(
            *[
                F.max(F.when(F.col("_ranks")[i].isNotNull(), F.col("_parent"))).alias(name)
                for i, name in enumerate(per_mille)
            ]
        )
        .select("_key.*", *per_mille)
    )
