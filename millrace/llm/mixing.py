"""Mixing of sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.store import cut

WORDS = r"[^\x20\x09-\x0D]+"
#: Copies are counted in whole parts of this size, so that no prefix sum is rounded.
UNIT_BITS = 20
#: Hexadecimal digits of the key that split rows of one source and size; 3 make 4096 groups.
GROUP_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def source_targets(
    totals: DataFrame, weights: Sequence[int], share_percent: int, most_copies: int
) -> DataFrame:
    """Target of each source, from rows (source, source_size); one row per source.

    Sources in code point order, null last, take the weights in turn. A source takes
    min(most_copies * size, level * weight), where the level makes the targets add up to the
    share: what resharing the excess again and again comes to. In the order of size by weight
    the full sources come first, and the level follows from the first that isn't full.
    """
    everything = W.partitionBy()
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    order = F.row_number().over(by_name)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (order - 1) % len(weights) + 1)
    rows = totals.withColumns(
        {
            "weight": weight.cast("double"),
            "full": (F.col("source_size") * most_copies).cast("double"),
            "wanted": F.sum("source_size").over(everything) * (share_percent / 100),
        }
    )
    by_need = W.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(
        F.sum("full").over(by_need.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)
    )
    rest = F.sum("weight").over(by_need.rowsBetween(0, W.unboundedFollowing))
    rows = rows.withColumn("level", (F.col("wanted") - before) / rest)
    open_level = F.when(F.col("full") > F.col("level") * F.col("weight"), F.col("level"))
    rows = rows.withColumn("water", F.max(open_level).over(everything))
    return rows.select(
        "source",
        "source_size",
        F.coalesce(F.least("full", F.col("water") * F.col("weight")), "full").alias("target"),
    )


def copies(
    docs: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    weights: Sequence[int] = (5, 2, 1),
    share_percent: int = 150,
    most_copies: int = 2,
    seed: int = 8,
) -> DataFrame:
    """The kept columns of docs (doc_id, text, source) and how often the mix takes each row.

    Every row of a source is expected target / source_size times. Rows stand in the order of
    their size, to two digits, and then of a seeded hash; expected copies are summed up in that
    order from a random start, and a row is taken once for each whole number its part of the
    sum passes. So neighbours of like size share the copies and the words taken stay close to
    the target.

    The order is global within a source without any task holding a source: rows are counted by
    (source, size class, hash group), a running sum over those counts gives where each group
    begins, and only inside a group are rows ordered.

    Null text has size 0. A null source is a source of its own. A null doc_id is ordered by its
    text. Rows alike in doc_id and text are interchangeable. An empty table gives no rows.
    Result: the kept columns, then size, source_size, target, copies. Kept columns of those
    names are replaced.
    """
    own = ("size", "source_size", "target", "copies")
    keep = [c for c in keep if c not in own]
    digits = F.col("size").cast("string")
    name = F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit("")))
    rows = docs.select(
        F.struct(*[F.col(c) for c in keep]).alias("row"),
        F.col("source"),
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("skey"),
        word_count(F.col("text")).alias("size"),
        F.md5(name).alias("hash"),
        F.xxhash64("text").alias("tie"),
    ).withColumns(
        {
            "class": F.length(digits) * 100 + F.substring(digits, 1, 2).cast("int"),
            "group": F.substring("hash", 1, GROUP_DIGITS),
        }
    )
    group = ["skey", "class", "group"]
    counts = cut(
        rows.groupBy(*group, "source").agg(F.count("*").alias("n"), F.sum("size").alias("words")),
        "mixing-counts",
    )
    totals = counts.groupBy("source", "skey").agg(F.sum("words").alias("source_size"))
    targets = source_targets(totals, weights, share_percent, most_copies)
    unit = 1 << UNIT_BITS
    start = F.concat(F.lit(f"{seed}|"), F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))
    targets = targets.select(
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("skey"),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * unit))
        .otherwise(0)
        .cast("long")
        .alias("rate"),
        F.conv(F.substring(F.md5(start), 1, UNIT_BITS // 4), 16, 10).cast("long").alias("start"),
    )
    classes = counts.groupBy("skey", "class").agg(F.sum("n").alias("n"))
    before = W.partitionBy("skey").orderBy("class").rowsBetween(W.unboundedPreceding, -1)
    classes = classes.select(
        "skey", "class", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("class_first")
    )
    within = W.partitionBy("skey", "class").orderBy("group").rowsBetween(W.unboundedPreceding, -1)
    groups = (
        counts.withColumn("group_first", F.coalesce(F.sum("n").over(within), F.lit(0)))
        .join(classes, ["skey", "class"])
        .join(targets, "skey")
        .select(
            *group,
            (F.col("class_first") + F.col("group_first")).alias("first"),
            "source_size",
            "target",
            "rate",
            "start",
        )
    )
    place = F.col("first") + F.row_number().over(
        W.partitionBy(*group).orderBy("hash", "size", "tie")
    )
    upto = lambda k: F.shiftright(k * F.col("rate") + F.col("start"), UNIT_BITS)
    return (
        rows.join(groups, group)
        .withColumn("place", place)
        .select(
            "row.*",
            "size",
            "source_size",
            "target",
            (upto(F.col("place")) - upto(F.col("place") - 1)).alias("copies"),
        )
    )


def mix(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of docs as often as the mix takes them, with the columns of docs only."""
    # Counted under names of its own, so that no column of docs is replaced.
    packed = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("document"), "doc_id", "text", "source"
    )
    taken = copies(packed, keep=("document",), **parameters)
    repeated = F.array_repeat("document", F.col("copies").cast("int"))
    return (
        taken.where("copies > 0")
        .select(F.explode(repeated).alias("document"))
        .select("document.*")
    )
