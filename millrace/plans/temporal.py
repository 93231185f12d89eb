"""Event jobs by business date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.money import from_cents, to_cents
from millrace.generate.events import EventDimensions, generate_events
from millrace.generate.volume import (
    VolumePlan,
    existing_dates,
    missing_dates,
    one_day,
    plan_audit,
    plan_volumes,
    volume_check,
)
from millrace.operators.aggregates import average_ticket
from millrace.sources.artifacts import (
    Artifact,
    drop_partitions,
    read_artifact,
    read_or_empty,
    write_artifact,
)
from millrace.sources.eventlog import job_step, stage_aggregate

EVENT_SCHEMA = """
    event_id string, event_date date, event_ts timestamp, account_id long, customer_id long,
    vendor_id long, product_id long, region string, channel string, event_type string,
    quantity int, gross_amount double, payload_size_bucket string, created_at timestamp
"""
FULL = "full"
APPEND_DAY = "append_day"
BACKFILL_STEP = "backfill "


def daily_activity(events: DataFrame, processing_date: Column | date | None = None) -> DataFrame:
    """Events, customers, revenue and average ticket per date, region, channel and type.

    All dates at once, or one date: the filter is on the bare partition column, so
    only that date's files are read.
    """
    if processing_date is not None:
        events = events.where(F.col("event_date") == F.lit(processing_date))
    revenue = F.sum(to_cents(F.col("gross_amount")))
    return (
        events.groupBy("event_date", "region", "channel", "event_type")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.count_distinct("customer_id").alias("customer_count"),
            revenue.alias("cents"),
        )
        .select(
            "event_date",
            "region",
            "channel",
            "event_type",
            "event_count",
            "customer_count",
            from_cents(F.col("cents")).alias("gross_revenue"),
            average_ticket(F.col("cents"), F.col("event_count")).alias("avg_ticket"),
        )
    )


def days_of(dates: DataFrame) -> list[date]:
    return [row["event_date"] for row in dates.select("event_date").distinct().collect()]


def of_days(events: DataFrame, days: list[date]) -> DataFrame:
    """Events of the given days, by a filter on the source's partitions."""
    return events.where(F.col("event_date").isin(days) if days else F.lit(False))


def backfill(events: DataFrame, dates: DataFrame, output: Artifact) -> None:
    """Daily activity of the given dates, written by date in one job. A rerun replaces
    its dates, also one that has no events any more, and leaves the others alone. The dates,
    one a day at most, are read first and become a filter on the source's partitions; raw
    events are neither joined nor shuffled."""
    days = days_of(dates)
    _write_days(events, days, output)
    _drop_empty(events, days, output)


def _write_days(events: DataFrame, days: list[date], output: Artifact) -> None:
    stamped = daily_activity(of_days(events, days)).withColumn("created_at", F.current_timestamp())
    by_date = Artifact(output.path, output.format, "overwrite", output.options, ("event_date",))
    write_artifact(stamped.repartition("event_date"), by_date, replace_partitions=True)


def _drop_empty(events: DataFrame, days: list[date], output: Artifact) -> None:
    """Removes earlier output of days that have no events. Of the source only the partition
    column is read."""
    empty = sorted(set(days) - set(days_of(of_days(events, days))))
    drop_partitions(events.sparkSession, output, "event_date", [str(day) for day in empty])


def backfill_day(spark: SparkSession, events: DataFrame, day: date, output: Artifact) -> None:
    """One date as a step of its own, so that its cost can be read from the event log."""
    with job_step(spark, f"{BACKFILL_STEP}{day.isoformat()}"):
        _write_days(events, [day], output)
    _drop_empty(events, [day], output)


def logged_backfills(logged: DataFrame) -> DataFrame:
    """Raw counters of every backfilled date found in event logs, one row per log and
    date, ready for ``history.backfill_rates``."""
    steps = stage_aggregate(logged).where(F.col("step").startswith(BACKFILL_STEP))
    return steps.withColumns(
        {
            "run_id": F.col("log"),
            "date_run_id": F.concat_ws("/", "log", "step"),
            "filter_strategy": F.lit("early_partition_filter"),
            "processing_date": F.to_date(F.substring("step", len(BACKFILL_STEP) + 1, 10)),
        }
    ).drop("log", "step")


def generate_source(
    spark: SparkSession,
    plan: VolumePlan,
    source: Artifact,
    mode: str = FULL,
    append_date: date | None = None,
    append_multiplier: int = 1,
    replace: bool = False,
    dimensions: EventDimensions = EventDimensions(),
    max_records_per_file: int | None = None,
) -> dict[str, DataFrame]:
    """Writes the planned dates the source does not have yet, then checks them.

    ``full`` fills the whole plan; ``append_day`` adds one date and refuses one that
    exists. ``replace`` regenerates every planned date. Dates are written as
    partitions that replace themselves, so a failed run can simply be repeated.
    Returns the plan audit and the volume check.
    """
    if mode not in (FULL, APPEND_DAY):
        raise ValueError(f"unknown mode {mode!r}")
    if replace and mode != FULL:
        raise ValueError("replace works only with the full mode")
    if mode == APPEND_DAY and append_date is None:
        raise ValueError("append_day needs a date")
    planned = (
        plan_volumes(spark, plan)
        if mode == FULL
        else one_day(spark, plan, append_date, append_multiplier)
    )
    # The existing dates are fixed before anything is written: the plan has one row
    # per date, so this list is short.
    present = [
        row.event_date
        for row in existing_dates(read_or_empty(spark, source, EVENT_SCHEMA))
        .join(planned, "event_date", "left_semi")
        .collect()
    ]
    if mode == APPEND_DAY and present:
        raise ValueError(f"{append_date} exists already")
    kept = [] if replace else present
    existing = spark.createDataFrame([(day,) for day in kept], "event_date date")
    todo = missing_dates(planned, existing)
    # Tasks for the rows that are missing, not for the whole plan.
    partitions = todo.agg(F.sum("partitions")).first()[0]
    if partitions:
        events = generate_events(todo, plan.seed, dimensions, partitions=partitions)
        target = Artifact(source.path, source.format, "overwrite", source.options, ("event_date",))
        write_artifact(events, target, max_records_per_file, replace_partitions=True)
    written = read_artifact(spark, source, EVENT_SCHEMA)
    return {"audit": plan_audit(planned, todo), "check": volume_check(planned, written)}
