"""Volume plans: how many events each date gets."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class VolumePlan:
    """Date range, base volume and spikes; the defaults are fixed values."""

    start: date = date(2026, 1, 1)
    end: date = date(2026, 1, 14)
    base_rows_per_day: int = 10_000
    spikes: Mapping[date, int] = field(
        default_factory=lambda: {date(2026, 1, 4): 100, date(2026, 1, 7): 10, date(2026, 1, 11): 100}
    )
    source_name: str = "source_events_temporal"
    seed: int = 77
    target_rows_per_partition: int = 250_000
    max_partitions_per_day: int = 16

    def __post_init__(self) -> None:
        if self.start > self.end:
            raise ValueError("the plan ends before it starts")
        outside = [day for day in self.spikes if not self.start <= day <= self.end]
        if outside:
            raise ValueError(f"spike dates outside the plan: {outside}")
        if any(multiplier < 1 for multiplier in self.spikes.values()):
            raise ValueError("spike multipliers must be positive")

    @property
    def partitions(self) -> int:
        """Partitions all days need together."""
        days = (self.end - self.start).days + 1
        volumes = [self.base_rows_per_day * m for m in self.spikes.values()]
        volumes += [self.base_rows_per_day] * (days - len(self.spikes))
        target, most = self.target_rows_per_partition, self.max_partitions_per_day
        return sum(min(most, max(1, -(-rows // target))) for rows in volumes)


def spike_label(multiplier: Column) -> Column:
    return (
        F.when(multiplier >= 100, F.lit("VOLUME_SPIKE"))
        .when(multiplier >= 10, F.lit("MEDIUM_SPIKE"))
        .otherwise(F.lit("NORMAL"))
    )


def partitions_for(rows: Column, target: int, most: int) -> Column:
    """Partitions a day needs: at least one, at most ``most``."""
    needed = F.ceil(rows / F.lit(target)).cast("long")
    return F.least(F.lit(most).cast("long"), F.greatest(F.lit(1).cast("long"), needed))


def planned_volumes(
    bounds: DataFrame, spikes: DataFrame, target: int = 250_000, most: int = 16
) -> DataFrame:
    """One row per date of the bounds.

    ``bounds`` has one row with ``first_date``, ``last_date`` and ``base_rows``;
    ``spikes`` has ``event_date`` and ``volume_multiplier``.
    """
    days = bounds.select(
        F.explode(F.sequence("first_date", "last_date")).alias("event_date"), "base_rows"
    )
    multiplier = F.coalesce(F.col("volume_multiplier").cast("long"), F.lit(1).cast("long"))
    return (
        days.join(spikes, "event_date", "left")
        .withColumn("volume_multiplier", multiplier)
        .withColumn("expected_rows", F.col("base_rows").cast("long") * F.col("volume_multiplier"))
        .select(
            "event_date",
            "volume_multiplier",
            "expected_rows",
            spike_label(F.col("volume_multiplier")).alias("spike_label"),
            partitions_for(F.col("expected_rows"), target, most).alias("partitions"),
        )
    )


def plan_volumes(spark: SparkSession, plan: VolumePlan) -> DataFrame:
    bounds = spark.createDataFrame(
        [(plan.start, plan.end, plan.base_rows_per_day)],
        "first_date date, last_date date, base_rows long",
    )
    spikes = spark.createDataFrame(
        list(plan.spikes.items()), "event_date date, volume_multiplier long"
    )
    return planned_volumes(bounds, spikes, plan.target_rows_per_partition, plan.max_partitions_per_day)


def one_day(spark: SparkSession, plan: VolumePlan, day: date, multiplier: int) -> DataFrame:
    """A single extra date with the plan's base volume."""
    extra = VolumePlan(
        start=day, end=day, base_rows_per_day=plan.base_rows_per_day, spikes={day: multiplier}
    )
    return plan_volumes(spark, extra)


def existing_dates(events: DataFrame) -> DataFrame:
    return events.select("event_date").distinct()


def missing_dates(planned: DataFrame, existing: DataFrame) -> DataFrame:
    return planned.join(existing.select("event_date"), "event_date", "left_anti")


def plan_audit(planned: DataFrame, generated: DataFrame) -> DataFrame:
    """The plan with what happened to each date."""
    done = generated.select("event_date", F.lit(True).alias("_done"))
    return (
        planned.join(done, "event_date", "left")
        .withColumn(
            "write_status",
            F.when(F.col("_done"), F.lit("generated")).otherwise(F.lit("already_exists")),
        )
        .drop("_done", "partitions")
    )


def volume_check(planned: DataFrame, events: DataFrame) -> DataFrame:
    """Actual against planned rows per planned date; other dates are ignored.

    The planned dates, one row a day, go to the events before these are counted. Where the
    events are stored by date and the plan is filtered, Spark prunes the other dates' files.
    """
    days = F.broadcast(planned.select("event_date"))
    actual = (
        events.join(days, "event_date", "left_semi")
        .groupBy("event_date")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return planned.join(actual, "event_date", "left").select(
        "event_date",
        "expected_rows",
        F.coalesce("rows", F.lit(0).cast("long")).alias("actual_rows"),
        (F.coalesce("rows", F.lit(0).cast("long")) == F.col("expected_rows")).alias("matches"),
    )
