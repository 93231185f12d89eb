"""Explicit partition layouts.

Each function returns a ``DataFrame -> DataFrame`` step for ``.transform``. The
analytic plans take one as ``exchange`` and default to ``as_planned``: Catalyst
then aggregates before it shuffles and AQE sizes the partitions. The other
layouts exist to study or to fix a layout on purpose.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.hashing import hash_mod

Exchange = Callable[[DataFrame], DataFrame]


def as_planned(df: DataFrame) -> DataFrame:
    return df


def session_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def round_robin(partitions: int | None = None) -> Exchange:
    """Even spread of whole rows. Costs a full shuffle and helps no later grouping."""
    return lambda df: df.repartition(partitions or session_partitions(df))


def keyed(*columns: str, partitions: int | None = None) -> Exchange:
    """Rows of one key in one partition. A hot key stays in one task."""
    if partitions is None:
        return lambda df: df.repartition(*columns)
    return lambda df: df.repartition(partitions, *columns)


def salted(
    *columns: str,
    hot: Column,
    spread_by: Column,
    salts: int,
    partitions: int | None = None,
) -> Exchange:
    """Keyed layout that cuts the rows matching ``hot`` into ``salts`` parts.

    The salt hash is seeded, so it is independent of an unseeded bucket hash of
    the same column; otherwise one bucket would meet one salt only.
    """

    def spread(df: DataFrame) -> DataFrame:
        salt = F.when(hot, hash_mod(spread_by, modulo=salts, seed=salts)).otherwise(F.lit(0))
        with_salt = df.withColumn("_salt", salt)
        target = [F.col(name) for name in columns] + [F.col("_salt")]
        spread_out = (
            with_salt.repartition(*target)
            if partitions is None
            else with_salt.repartition(partitions, *target)
        )
        return spread_out.drop("_salt")

    return spread
