"""Exact distinct counts that merge like sums: bitmaps per range of ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH_BITS = 14


def id_bitmaps(df: DataFrame, keys: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """(keys, entity, id_bucket, bitmap, sketch): for each group and id column one row per
    range of 32,768 ids, with a bit for each id met and a sketch of the same ids.

    All id columns are whole numbers and are read in one pass; null ids count for nothing.
    Tasks set the bits of their own rows first, so what is shuffled is one row of 4 KiB per
    group, range and task, whatever the number of rows. That pays where a group holds hundreds
    of ids of a range; for finer groups an exact count per value is smaller. The range in the
    key spreads a group that holds most of the rows.
    """
    entities = [
        F.struct(F.lit(name).alias("entity"), F.col(name).cast("long").alias("id")) for name in ids
    ]
    met = df.select(*keys, F.inline(F.array(*entities))).where(F.col("id").isNotNull())
    return met.groupBy(*keys, "entity", F.bitmap_bucket_number("id").alias("id_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bitmap"),
        F.hll_sketch_agg("id", SKETCH_BITS).alias("sketch"),
    )


def merged_counts(bitmaps: DataFrame, keys: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """Exact and estimated distinct ids per group of ``keys``, some or all of the bitmaps' own
    keys. Groups that never met an id have no row."""
    merged = bitmaps.groupBy(*keys, "entity", "id_bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("n"), F.hll_union_agg("sketch").alias("sketch")
    )

    def of(name: str, value: Column) -> Column:
        return F.when(F.col("entity") == name, value)

    columns = []
    for name in ids:
        exact = F.coalesce(F.sum(of(name, F.col("n"))), F.lit(0).cast("long"))
        guess = F.hll_sketch_estimate(F.hll_union_agg(of(name, F.col("sketch"))))
        columns += [exact.alias(f"{name}_count"), F.coalesce(guess, F.lit(0)).alias(f"{name}_estimate")]
    return merged.groupBy(*keys).agg(*columns)


def distinct_rollup(
    df: DataFrame, grains: Mapping[str, Sequence[str]], ids: Sequence[str]
) -> DataFrame:
    """Distinct ids at several grains from one scan: ``grain``, all keys (null where a grain
    does not have one), and per id column its exact count and its estimate. Each bitmap of
    the finest groups is handed to all grains, where tasks merge their own before the shuffle;
    coarser grains never see a row again."""
    keys = list(dict.fromkeys(key for grain in grains.values() for key in grain))
    kinds = {key: df.schema[key].dataType for key in keys}
    levels = [
        F.struct(
            F.lit(name).alias("grain"),
            *[(F.col(k) if k in grain else F.lit(None).cast(kinds[k])).alias(k) for k in keys],
        )
        for name, grain in grains.items()
    ]
    bitmaps = id_bitmaps(df, keys, ids)
    spread = bitmaps.select("entity", "id_bucket", "bitmap", "sketch", F.inline(F.array(*levels)))
    return merged_counts(spread, ["grain", *keys], ids)


def within(estimate: Column, exact: Column, share: float) -> Column:
    """Whether an estimate is off by no more than a share of the exact number."""
    return F.abs(estimate - exact) <= exact * F.lit(share)
