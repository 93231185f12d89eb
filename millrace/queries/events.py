"""Event queries by business date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.generate import volume
from millrace.plans import temporal
from millrace.queries.sql import bigint
from millrace.sources.tables import temporal_events, volume_bounds, volume_spikes

LARGE_VALUE = 250


def daily_activity(spark: SparkSession, folder: str) -> DataFrame:
    return temporal.daily_activity(temporal_events(spark, folder))


def daily_activity_first_day(spark: SparkSession, folder: str) -> DataFrame:
    """One processing date: the first of the table."""
    events = temporal_events(spark, folder)
    first = events.agg(F.min("event_date")).scalar()
    return temporal.daily_activity(events, first)


def daily_activity_dates(spark: SparkSession, folder: str) -> DataFrame:
    """What a backfill of the spike days writes."""
    spikes = volume_spikes(spark, folder).where("volume_multiplier > 1")
    return temporal.daily_activity(
        temporal.of_days(temporal_events(spark, folder), temporal.days_of(spikes))
    )


def _planned(spark: SparkSession, folder: str) -> DataFrame:
    return volume.planned_volumes(
        volume_bounds(spark, folder), volume_spikes(spark, folder), target=500, most=16
    )


def volume_plan(spark: SparkSession, folder: str) -> DataFrame:
    return _planned(spark, folder)


def _large_error_days(spark: SparkSession, folder: str) -> DataFrame:
    large = temporal_events(spark, folder).where(
        (F.col("event_type") == "error") & (F.col("gross_amount") > LARGE_VALUE)
    )
    return volume.existing_dates(large)


def existing_dates(spark: SparkSession, folder: str) -> DataFrame:
    return volume.existing_dates(temporal_events(spark, folder))


def missing_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Planned dates without a large error event."""
    return volume.missing_dates(_planned(spark, folder), _large_error_days(spark, folder))


def plan_audit(spark: SparkSession, folder: str) -> DataFrame:
    return volume.plan_audit(_planned(spark, folder), missing_dates(spark, folder))


def volume_check(spark: SparkSession, folder: str) -> DataFrame:
    return volume.volume_check(_planned(spark, folder), temporal_events(spark, folder))


QUERIES = {
    query.__name__: query
    for query in (
        daily_activity,
        daily_activity_first_day,
        daily_activity_dates,
        volume_plan,
        existing_dates,
        missing_dates,
        plan_audit,
        volume_check,
    )
}

EVENTS = """typed AS (
    SELECT CAST(ts AS DATE) AS event_date, user_id AS customer_id, event_type,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value AS gross_amount,
           CAST(round(value * 100) AS BIGINT) AS cents, ts
    FROM events)"""

_ACTIVITY = f"""WITH {EVENTS}
SELECT event_date,
       CASE k % 4 WHEN 0 THEN 'BR_SP' WHEN 1 THEN 'BR_RJ' WHEN 2 THEN 'BR_MG' ELSE 'BR_PR' END AS region,
       CASE k % 3 WHEN 0 THEN 'APP' WHEN 1 THEN 'WEB' ELSE 'API' END AS channel,
       event_type, count(*) AS event_count, count(DISTINCT customer_id) AS customer_count,
       {bigint('sum(cents)')} / 100.0 AS gross_revenue,
       ((2 * {bigint('sum(cents)')} * 100 + count(*)) // (2 * count(*))) / 10000.0 AS avg_ticket
FROM typed"""

PLAN = f"""{EVENTS},
bounds AS (
    SELECT min(event_date) AS d0, max(event_date) AS d1,
           count(*) // (max(event_date) - min(event_date) + 1) AS base FROM typed),
spikes AS (
    SELECT event_date, count(*) FILTER (WHERE gross_amount > 100) * 1000 // count(*) AS heavy
    FROM typed GROUP BY 1),
days AS (SELECT CAST(unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) AS event_date, base FROM bounds),
multiplied AS (
    SELECT event_date, base,
           CAST(CASE WHEN heavy >= 155 THEN 100 WHEN heavy >= 140 THEN 10 ELSE 1 END AS BIGINT)
             AS volume_multiplier
    FROM days LEFT JOIN spikes USING (event_date)),
planned AS (
    SELECT event_date, volume_multiplier, base * volume_multiplier AS expected_rows,
           CASE WHEN volume_multiplier >= 100 THEN 'VOLUME_SPIKE'
                WHEN volume_multiplier >= 10 THEN 'MEDIUM_SPIKE' ELSE 'NORMAL' END AS spike_label,
           CAST(least(16, greatest(1, (base * volume_multiplier + 499) // 500)) AS BIGINT) AS partitions
    FROM multiplied)"""

_LARGE = f"(SELECT event_date FROM typed WHERE event_type = 'error' AND gross_amount > {LARGE_VALUE})"

SQL = {
    "daily_activity": f"{_ACTIVITY} GROUP BY ALL",
    "daily_activity_first_day": f"""{_ACTIVITY}
WHERE event_date = (SELECT min(event_date) FROM typed) GROUP BY ALL""",
    "daily_activity_dates": f"""{_ACTIVITY.replace(EVENTS, PLAN)}
WHERE event_date IN (SELECT event_date FROM planned WHERE volume_multiplier > 1) GROUP BY ALL""",
    "volume_plan": f"WITH {PLAN} SELECT * FROM planned",
    "existing_dates": f"WITH {EVENTS} SELECT DISTINCT event_date FROM typed",
    "missing_dates": f"WITH {PLAN} SELECT * FROM planned WHERE event_date NOT IN {_LARGE}",
    "plan_audit": f"""WITH {PLAN}
SELECT event_date, volume_multiplier, expected_rows, spike_label,
       CASE WHEN event_date IN {_LARGE} THEN 'already_exists' ELSE 'generated' END AS write_status
FROM planned""",
    "volume_check": f"""WITH {PLAN},
actual AS (SELECT event_date, count(*) AS n FROM typed GROUP BY 1)
SELECT event_date, expected_rows, coalesce(n, 0) AS actual_rows,
       coalesce(n, 0) = expected_rows AS matches
FROM planned LEFT JOIN actual USING (event_date)""",
}
