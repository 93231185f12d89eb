"""Queries over task, stage and run metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.generate.volume import planned_volumes
from millrace.operators import budget, history, overhead, stagemetrics, taskstats
from millrace.plans import observability
from millrace.queries import events as event_queries
from millrace.queries.quality import RUNS
from millrace.queries.sql import bigint, ratio, rounded
from millrace.sources import eventlog
from millrace.sources.tables import (
    DAILY_IDENTITY,
    RUN_IDENTITY,
    daily_counters,
    event_log_lines,
    overhead_runs,
    run_counters,
    task_metrics,
    volume_bounds,
    volume_spikes,
)

RUN = ["run_id"]
# Thresholds sized for the test data, so that every profile occurs.
FINGERPRINT_RULES = stagemetrics.FingerprintRules(
    high_shuffle_amplification_ratio=1.5,
    high_shuffle_total_bytes=30_000_000,
    high_input_bytes=25_000_000,
    minimum_reliable_input_bytes=4_000_000,
    low_shuffle_bytes=1_000_000,
    high_gc_time_ratio=0.08,
    high_task_density_score=4.0,
    high_total_tasks=9,
    low_signal_executor_runtime_ms=400,
    low_signal_shuffle_bytes=3_000_000,
    low_parallelism_task_threshold=2,
)
BUDGET_RULES = budget.BudgetRules(min_executor_runtime_ms=800, min_shuffle_bytes=6_000_000)


# --- tasks ------------------------------------------------------------------------


def task_stage_stats(spark: SparkSession, folder: str) -> DataFrame:
    tasks = task_metrics(spark, folder)
    return taskstats.stage_stats(tasks, RUN, taskstats.low_end_metric(tasks))


def task_skew_stage(spark: SparkSession, folder: str) -> DataFrame:
    return taskstats.skewed_stage(task_metrics(spark, folder), RUN)


def task_skew_stage_by_duration(spark: SparkSession, folder: str) -> DataFrame:
    """The fallback for tables without shuffle bytes."""
    return taskstats.skewed_stage(task_metrics(spark, folder).drop("shuffleTotalBytesRead"), RUN)


def empty_partition_stage(spark: SparkSession, folder: str) -> DataFrame:
    return taskstats.starved_stage(task_metrics(spark, folder), RUN, preferred_task_count=19)


def task_metric_summary(spark: SparkSession, folder: str) -> DataFrame:
    return taskstats.metric_summary(task_metrics(spark, folder), RUN)


def task_metric_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    return taskstats.exact_metric_summary(task_metrics(spark, folder), RUN)


def task_outliers_slow(spark: SparkSession, folder: str) -> DataFrame:
    return taskstats.slowest_tasks(task_metrics(spark, folder), RUN)


def task_outliers_high(spark: SparkSession, folder: str) -> DataFrame:
    return taskstats.heaviest_tasks(task_metrics(spark, folder), [*RUN, "stageId"])


def task_outliers_low(spark: SparkSession, folder: str) -> DataFrame:
    return taskstats.emptiest_tasks(task_metrics(spark, folder), [*RUN, "stageId"])


def skew_diagnosis_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return observability.diagnose_skew(task_metrics(spark, folder), RUN)["outliers"]


def skew_diagnosis_summaries(spark: SparkSession, folder: str) -> DataFrame:
    return observability.diagnose_skew(task_metrics(spark, folder), RUN)["summaries"]


def starvation_diagnosis_outliers(spark: SparkSession, folder: str) -> DataFrame:
    tasks = task_metrics(spark, folder)
    return observability.diagnose_starvation(tasks, RUN, preferred_task_count=19)["outliers"]


# --- runs -------------------------------------------------------------------------


def stage_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return stagemetrics.stage_rollup(task_metrics(spark, folder), RUN)


def task_aggregate(spark: SparkSession, folder: str) -> DataFrame:
    return stagemetrics.task_aggregate(task_metrics(spark, folder), RUN)


def metric_usefulness(spark: SparkSession, folder: str) -> DataFrame:
    """Some counters are dropped here: a required one, and both shuffle counters."""
    counters = run_counters(spark, folder).withColumn(
        "executorRunTime", F.when(F.col("bytesRead").isNotNull(), F.col("executorRunTime"))
    )
    return stagemetrics.with_usefulness(counters).select("run_id", "valid", "reason")


def numeric_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return stagemetrics.numeric_metrics(run_counters(spark, folder), ["run_id"])


def run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return stagemetrics.run_metrics(run_counters(spark, folder), RUN_IDENTITY)


def stage_normalized(spark: SparkSession, folder: str) -> DataFrame:
    return stagemetrics.normalized_metrics(run_counters(spark, folder), RUN)


def workload_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    jobs = observability.fingerprint_runs(
        run_counters(spark, folder), RUN_IDENTITY, FINGERPRINT_RULES
    )
    return jobs["fingerprints"].select(
        "run_id",
        "workload_name",
        "num_tasks",
        "shuffle_amplification_ratio",
        "gc_time_ratio",
        "spill_ratio",
        "task_density_score",
        "workload_profile",
        "diagnostic_flags",
        "recommended_next_step",
    )


def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    runs = stagemetrics.run_metrics(run_counters(spark, folder), RUN_IDENTITY)
    return budget.pair_runs(runs, "approved_baseline", "candidate")


def budget_growth(spark: SparkSession, folder: str) -> DataFrame:
    return budget.growth(_pairs(spark, folder)).select(
        "workload_name",
        F.col("baseline.run_id").alias("baseline_run_id"),
        F.col("candidate.run_id").alias("candidate_run_id"),
        *budget.GROWTH,
        "spill_delta_pct",
    )


def budget_decision(spark: SparkSession, folder: str) -> DataFrame:
    decisions = budget.budget_decisions(_pairs(spark, folder), BUDGET_RULES)
    return budget.decision_records(decisions).drop("created_at")


def budget_unpaired(spark: SparkSession, folder: str) -> DataFrame:
    """Decisions where one workload in three lost its approved runs and one its candidates."""
    number = F.substring("workload_name", 10, 20).cast("long") % 3
    lost = F.when(number == 0, F.lit("approved_baseline")).when(number == 1, F.lit("candidate"))
    runs = run_metrics(spark, folder).where(~F.col("workload_variant").eqNullSafe(lost))
    pairs = budget.pair_runs(runs, "approved_baseline", "candidate")
    return budget.budget_decisions(pairs, BUDGET_RULES).select(
        "workload_name",
        F.col("baseline.run_id").alias("baseline_run_id"),
        F.col("candidate.run_id").alias("candidate_run_id"),
        "decision",
        "failed_rules",
        "executor_run_time_delta_pct",
    )


def overhead_summary(spark: SparkSession, folder: str) -> DataFrame:
    return overhead.overhead_summary(overhead_runs(spark, folder), ["benchmark_id"])


# --- history ----------------------------------------------------------------------


def _rates(spark: SparkSession, folder: str) -> DataFrame:
    plan = planned_volumes(volume_bounds(spark, folder), volume_spikes(spark, folder))
    return history.backfill_rates(daily_counters(spark, folder), plan, DAILY_IDENTITY)


def _history(spark: SparkSession, folder: str) -> DataFrame:
    return history.metrics_history(_rates(spark, folder))


def backfill_rates(spark: SparkSession, folder: str) -> DataFrame:
    return _rates(spark, folder).drop("created_at")


def backfill_rates_all_dates(spark: SparkSession, folder: str) -> DataFrame:
    """A plan of the spike days alone; the other dates are kept without rates."""
    plan = planned_volumes(volume_bounds(spark, folder), volume_spikes(spark, folder))
    rates = history.backfill_rates(
        daily_counters(spark, folder), plan.where("volume_multiplier > 1"), DAILY_IDENTITY
    )
    return rates.select(
        "processing_date", "records_read", "source_rows_for_date", "planned", *history.RATES
    )


def backfill_records(spark: SparkSession, folder: str) -> DataFrame:
    plan = planned_volumes(volume_bounds(spark, folder), volume_spikes(spark, folder))
    records = history.backfill_records(
        _rates(spark, folder), plan, "activity", app_name="daily", workload_name="activity"
    )
    return records.drop("created_at")


def unplanned_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Dates with events that a plan of the spike days alone would not expect."""
    spikes = volume_spikes(spark, folder)
    return history.unplanned_dates(daily_counters(spark, folder), spikes)


def metrics_history(spark: SparkSession, folder: str) -> DataFrame:
    return _history(spark, folder).drop("created_at")


def latest_batch(spark: SparkSession, folder: str) -> DataFrame:
    return history.latest_run(_history(spark, folder)).select("run_id")


def latest_batch_history(spark: SparkSession, folder: str) -> DataFrame:
    return history.of_latest_run(_history(spark, folder)).select(
        "run_id", "processing_date", "records_read"
    )


def run_kpis(spark: SparkSession, folder: str) -> DataFrame:
    return history.run_kpis(_history(spark, folder))


def normal_day_baseline(spark: SparkSession, folder: str) -> DataFrame:
    return history.normal_day_baseline(_history(spark, folder))


def drift_index(spark: SparkSession, folder: str) -> DataFrame:
    return history.drift_index(_history(spark, folder))


def pressure_signals(spark: SparkSession, folder: str) -> DataFrame:
    return history.pressure_signals(_history(spark, folder))


# --- event logs -------------------------------------------------------------------


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return eventlog.parse_events(event_log_lines(spark, folder), F.col("log"))


def eventlog_tasks(spark: SparkSession, folder: str) -> DataFrame:
    return eventlog.task_metrics(_events(spark, folder))


def eventlog_tasks_by_step(spark: SparkSession, folder: str) -> DataFrame:
    return eventlog.tasks_by_step(_events(spark, folder)).select(
        "log", "stageId", "taskId", "executorRunTime", "step", "description"
    )


def eventlog_stage_aggregate(spark: SparkSession, folder: str) -> DataFrame:
    return eventlog.stage_aggregate(_events(spark, folder))


QUERIES = {
    query.__name__: query
    for query in (
        task_stage_stats,
        task_skew_stage,
        task_skew_stage_by_duration,
        empty_partition_stage,
        task_metric_summary,
        task_metric_quantiles,
        task_outliers_slow,
        task_outliers_high,
        task_outliers_low,
        skew_diagnosis_outliers,
        skew_diagnosis_summaries,
        starvation_diagnosis_outliers,
        stage_rollup,
        task_aggregate,
        metric_usefulness,
        numeric_metrics,
        run_metrics,
        stage_normalized,
        workload_fingerprint,
        budget_growth,
        budget_decision,
        budget_unpaired,
        overhead_summary,
        backfill_rates,
        backfill_rates_all_dates,
        backfill_records,
        unplanned_dates,
        metrics_history,
        latest_batch,
        latest_batch_history,
        run_kpis,
        normal_day_baseline,
        drift_index,
        pressure_signals,
        eventlog_tasks,
        eventlog_tasks_by_step,
        eventlog_stage_aggregate,
    )
}


# --- SQL --------------------------------------------------------------------------


def _cents(condition: str) -> str:
    return bigint(f"coalesce(sum(cents) FILTER (WHERE {condition}), 0)")


TASKS = f"""lines AS (
    SELECT strftime(l_shipdate, '%Y-%m') AS run_id, *,
           CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
           CAST(l_quantity AS BIGINT) AS qty FROM lineitem),
tasks AS (
    SELECT run_id, l_suppkey % 5 AS "stageId", l_suppkey // 5 AS "index",
           'executor-' || (l_suppkey % 7) AS "executorId", 'host-' || (l_suppkey % 3) AS host,
           {bigint('sum(qty)')} AS duration,
           {bigint('sum(qty - l_linenumber)')} AS "executorRunTime",
           {bigint('sum(l_linenumber)')} AS "jvmGCTime", count(*) AS "recordsRead",
           {_cents('true')} AS "bytesRead",
           count(*) FILTER (WHERE l_returnflag = 'R') AS "shuffleRecordsRead",
           {_cents("l_returnflag = 'R'")} AS "shuffleTotalBytesRead",
           count(*) FILTER (WHERE l_linestatus = 'O') AS "recordsWritten",
           {_cents("l_returnflag IN ('A', 'R')")} AS "shuffleBytesWritten",
           {_cents("l_discount >= 0.095 AND l_linestatus = 'O'")} AS "memoryBytesSpilled",
           {_cents("l_discount >= 0.095 AND l_linestatus <> 'O'")} AS "diskBytesSpilled"
    FROM lines GROUP BY run_id, l_suppkey)"""


def _stage_stats(data: str) -> str:
    return f"""grouped AS (
    SELECT run_id, "stageId", count(*) AS "taskCount",
           CAST(min(duration) AS DOUBLE) AS "minDuration",
           CAST(quantile_disc(duration, 0.5) AS DOUBLE) AS "medianDuration",
           CAST(quantile_disc(duration, 0.75) AS DOUBLE) AS "p75Duration",
           CAST(max(duration) AS DOUBLE) AS "maxDuration",
           CAST(min("{data}") AS DOUBLE) AS "minData",
           CAST(quantile_disc("{data}", 0.5) AS DOUBLE) AS "medianData",
           CAST(quantile_disc("{data}", 0.75) AS DOUBLE) AS "p75Data",
           CAST(max("{data}") AS DOUBLE) AS "maxData",
           count(*) FILTER (WHERE "{data}" <= 0) AS "emptyTaskCount"
    FROM tasks GROUP BY 1, 2 HAVING count(*) >= 4),
stats AS (
    SELECT *, {ratio('"medianDuration"', '"minDuration"')} AS "durationMedianToMin",
           {ratio('"maxDuration"', '"p75Duration"')} AS "durationMaxToP75",
           {ratio('"medianData"', '"minData"')} AS "dataMedianToMin",
           {ratio('"maxData"', '"p75Data"')} AS "dataMaxToP75", '{data}' AS "dataMetric"
    FROM grouped)"""


_SIGNAL = """CASE WHEN "dataMaxToP75" >= 10 THEN 'strong skew signal'
    WHEN "dataMaxToP75" >= 3 THEN 'moderate skew signal' ELSE 'low skew signal' END"""


def _skewed(data: str) -> str:
    """Data candidates and the duration fallback as two separate searches."""
    return f"""WITH {TASKS}, {_stage_stats(data)},
by_data AS (
    SELECT * FROM stats WHERE "maxData" > 0
    QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY "dataMaxToP75" DESC,
        "durationMaxToP75" DESC, "maxData" DESC, "stageId") = 1),
by_duration AS (
    SELECT * FROM stats WHERE run_id NOT IN (SELECT run_id FROM by_data)
    QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY "durationMaxToP75" DESC,
        "maxDuration" DESC, "stageId") = 1),
chosen AS (
    SELECT *, {_SIGNAL} AS "skewSignal" FROM
    (SELECT * FROM by_data UNION ALL SELECT * FROM by_duration))"""


_STARVED_ORDER = """PARTITION BY run_id ORDER BY "emptyTaskCount" DESC, "dataMedianToMin" DESC,
        "dataMaxToP75", "taskCount" DESC, "stageId\""""
_DURATION_ORDER = """PARTITION BY run_id ORDER BY "durationMedianToMin" DESC, "durationMaxToP75",
        "taskCount" DESC, "stageId\""""
_STARVED = f"""WITH {TASKS}, {_stage_stats('shuffleRecordsRead')},
first_choice AS (
    SELECT * FROM stats WHERE "taskCount" = 19 AND "medianData" > 0 AND "emptyTaskCount" > 0
    QUALIFY row_number() OVER ({_STARVED_ORDER}) = 1),
second_choice AS (
    SELECT * FROM stats WHERE "medianData" > 0 AND "emptyTaskCount" > 0
    AND run_id NOT IN (SELECT run_id FROM first_choice)
    QUALIFY row_number() OVER ({_STARVED_ORDER}) = 1),
found AS (SELECT * FROM first_choice UNION ALL SELECT * FROM second_choice),
third_choice AS (
    SELECT * FROM stats WHERE "taskCount" = 19 AND run_id NOT IN (SELECT run_id FROM found)
    QUALIFY row_number() OVER ({_DURATION_ORDER}) = 1),
last_choice AS (
    SELECT * FROM stats WHERE run_id NOT IN (SELECT run_id FROM found)
    AND run_id NOT IN (SELECT run_id FROM third_choice)
    QUALIFY row_number() OVER ({_DURATION_ORDER}) = 1),
chosen AS (SELECT * FROM found UNION ALL SELECT * FROM third_choice UNION ALL SELECT * FROM last_choice)"""


def _metric_rows(source: str) -> str:
    return "\nUNION ALL ".join(
        f"""SELECT run_id, "stageId", count(*) AS "taskCount", '{metric}' AS metric,
       CAST(min("{metric}") AS DOUBLE) AS min,
       CAST(quantile_disc("{metric}", 0.25) AS DOUBLE) AS p25,
       CAST(quantile_disc("{metric}", 0.5) AS DOUBLE) AS median,
       CAST(quantile_disc("{metric}", 0.75) AS DOUBLE) AS p75,
       CAST(max("{metric}") AS DOUBLE) AS max,
       count(*) FILTER (WHERE "{metric}" <= 0) AS "zeroTaskCount"
FROM {source} GROUP BY 1, 2"""
        for metric in taskstats.SUMMARY_METRICS
    )


_EXACT_ROWS = f"""SELECT r.*, r."taskCount" >= 4 AS eligible, q.p95 FROM ({_metric_rows('tasks')}) r JOIN (
    SELECT run_id, "stageId", metric, CAST(quantile_disc(value, 0.95) AS DOUBLE) AS p95
    FROM (UNPIVOT (SELECT run_id, "stageId", {', '.join(f'CAST("{m}" AS BIGINT) AS "{m}"' for m in taskstats.SUMMARY_METRICS)}
                   FROM tasks)
          ON {', '.join(f'"{m}"' for m in taskstats.SUMMARY_METRICS)} INTO NAME metric VALUE value)
    GROUP BY ALL) q USING (run_id, "stageId", metric)"""
_SUMMARY_RATIOS = f"""SELECT *, {ratio('median', 'min')} AS "medianToMin",
    {ratio('max', 'p75')} AS "maxToP75" FROM rows_per_metric"""
_TASK_COLUMNS = "run_id, " + ", ".join(f'"{name}"' for name in taskstats.OUTLIER_COLUMNS)
_HIGH_ORDER = '"shuffleTotalBytesRead" DESC, duration DESC, "executorRunTime" DESC, "stageId", "index"'
_LOW_ORDER = '"shuffleRecordsRead", duration, "executorRunTime", "stageId", "index"'


def _outliers(by: str, order: str, source: str = "tasks", where: str = "true") -> str:
    return f"""SELECT * FROM (
    SELECT {_TASK_COLUMNS},
           CAST(row_number() OVER (PARTITION BY {by} ORDER BY {order}) AS INTEGER) AS outlier_rank
    FROM {source} WHERE {where}) WHERE outlier_rank <= 5"""


_CHOSEN_TASKS = '(SELECT t.* FROM tasks t JOIN chosen c USING (run_id, "stageId"))'
_COUNTERS = (
    "executorRunTime",
    "bytesRead",
    "recordsRead",
    "recordsWritten",
    "shuffleTotalBytesRead",
    "shuffleBytesWritten",
    "memoryBytesSpilled",
    "diskBytesSpilled",
    "jvmGCTime",
)
_SUMS = ", ".join(f'CAST(sum("{name}") AS BIGINT) AS "{name}"' for name in _COUNTERS)

_PLAIN = f"""{RUNS},
plain AS (
    SELECT run_id, app_name, workload_name, workload_variant, created_at,
           run_ms AS executor_run_time_ms, coalesce(input, 0) AS input_bytes,
           coalesce(sh_read, 0) AS shuffle_bytes_read, coalesce(sh_written, 0) AS shuffle_bytes_written,
           coalesce(mem, 0) AS memory_bytes_spilled, coalesce(disk, 0) AS disk_bytes_spilled,
           gc_ms AS jvm_gc_time_ms, stages AS num_stages, tasks AS num_tasks, records_read,
           records_written, coalesce(sh_read, 0) + coalesce(sh_written, 0) AS shuffle_total_bytes,
           coalesce(mem, 0) + coalesce(disk, 0) AS spill_total_bytes
    FROM runs),
ratios AS (
    SELECT *,
           CASE WHEN input_bytes > 0
                THEN {rounded('CAST(shuffle_total_bytes AS DOUBLE) / input_bytes', 6)} END
             AS shuffle_amplification_ratio,
           {rounded('CAST(jvm_gc_time_ms AS DOUBLE) / executor_run_time_ms', 6)} AS gc_time_ratio,
           {rounded('CAST(spill_total_bytes AS DOUBLE) / greatest(input_bytes, shuffle_total_bytes, 1)', 6)}
             AS spill_ratio,
           {rounded('CAST(num_tasks AS DOUBLE) / num_stages', 4)} AS task_density_score
    FROM plain)"""

_R = FINGERPRINT_RULES
_FLAGS = {
    "INPUT_BYTES_UNAVAILABLE_FOR_RATIO": "input_bytes = 0",
    "INPUT_BYTES_LOW_CONFIDENCE_FOR_RATIO": f"input_bytes > 0 AND input_bytes < {_R.minimum_reliable_input_bytes}",
    "HIGH_SHUFFLE_AMPLIFICATION": f"input_bytes >= {_R.minimum_reliable_input_bytes} "
    f"AND shuffle_amplification_ratio >= {_R.high_shuffle_amplification_ratio}",
    "HIGH_SHUFFLE_VOLUME": f"shuffle_total_bytes >= {_R.high_shuffle_total_bytes}",
    "SPILL_DETECTED": "spill_total_bytes >= 1",
    "HIGH_GC_RATIO": f"gc_time_ratio >= {_R.high_gc_time_ratio}",
    "HIGH_INPUT_LOW_SHUFFLE": f"input_bytes >= {_R.high_input_bytes} "
    f"AND shuffle_total_bytes <= {_R.low_shuffle_bytes}",
    "TASK_OVERHEAD_SIGNAL": f"num_tasks >= {_R.high_total_tasks} "
    f"OR task_density_score >= {_R.high_task_density_score}",
    "LOW_PARALLELISM_SIGNAL": f"num_tasks <= {_R.low_parallelism_task_threshold} "
    f"AND executor_run_time_ms >= {_R.low_signal_executor_runtime_ms}",
}
_FLAG_COLUMNS = ", ".join(f"coalesce({c}, false) AS {name.lower()}_f" for name, c in _FLAGS.items())
_FLAG_TEXT = ", ".join(f"CASE WHEN {name.lower()}_f THEN '{name}' END" for name in _FLAGS)
_ADVICE = " ".join(
    f"WHEN '{profile}' THEN '{text}'" for profile, text in stagemetrics.NEXT_STEPS.items()
)
_FINGERPRINT = f"""WITH {_PLAIN},
flagged AS (SELECT *, {_FLAG_COLUMNS} FROM ratios),
profiled AS (
    SELECT *, CASE
        WHEN executor_run_time_ms < {_R.low_signal_executor_runtime_ms}
             AND shuffle_total_bytes < {_R.low_signal_shuffle_bytes} AND spill_total_bytes = 0
            THEN 'BALANCED_OR_LOW_SIGNAL'
        WHEN spill_detected_f THEN 'MEMORY_PRESSURE' WHEN high_gc_ratio_f THEN 'GC_PRESSURE'
        WHEN high_input_low_shuffle_f THEN 'IO_HEAVY_SCAN'
        WHEN high_shuffle_amplification_f OR high_shuffle_volume_f THEN 'SHUFFLE_HEAVY'
        WHEN task_overhead_signal_f THEN 'MANY_SMALL_TASKS'
        WHEN low_parallelism_signal_f THEN 'LOW_PARALLELISM_SIGNAL'
        ELSE 'BALANCED_OR_LOW_SIGNAL' END AS workload_profile
    FROM flagged)
SELECT run_id, workload_name, num_tasks, shuffle_amplification_ratio, gc_time_ratio, spill_ratio,
       task_density_score, workload_profile,
       concat_ws(',', {_FLAG_TEXT},
           CASE WHEN workload_profile = 'BALANCED_OR_LOW_SIGNAL' THEN 'LOW_SIGNAL' END)
         AS diagnostic_flags,
       CASE workload_profile {_ADVICE} END AS recommended_next_step
FROM profiled"""


def _growth(before: str, after: str) -> str:
    return (
        f"CASE WHEN {before} = 0 AND {after} = 0 THEN 0.0 WHEN {before} = 0 THEN 100.0 "
        f"ELSE {rounded(f'(CAST({after} AS DOUBLE) - {before}) / {before} * 100.0', 4)} END"
    )


_GROWTH_COLUMNS = ", ".join(
    f"CAST({_growth('b.' + metric, 'c.' + metric)} AS DOUBLE) AS {name}"
    for name, metric in {**budget.GROWTH, "spill_delta_pct": "spill_total_bytes"}.items()
)


def _latest(variant: str) -> str:
    return f"""(SELECT * FROM plain WHERE workload_variant = '{variant}'
    QUALIFY row_number() OVER (PARTITION BY workload_name ORDER BY created_at DESC, run_id DESC) = 1)"""


_BUDGET_JSON = ", ".join(f"'{name}', {{side}}.{name}" for name in budget.BUDGET_METRICS)


def _limits(profile: str) -> str:
    t = BUDGET_RULES.thresholds(profile)
    return (
        f"('{profile}', {t.max_executor_runtime_growth_pct}, {t.max_shuffle_written_growth_pct}, "
        f"{t.max_shuffle_read_growth_pct}, {t.max_num_tasks_growth_pct}, "
        f"{t.max_num_stages_growth_pct})"
    )


_PAIRS = f"""WITH {_PLAIN},
pairs AS (
    SELECT workload_name, b.run_id AS baseline_run_id, c.run_id AS candidate_run_id,
           {_GROWTH_COLUMNS},
           CASE WHEN b.spill_total_bytes = 0 AND c.spill_total_bytes > 0 THEN 'MEMORY_PRESSURE'
                WHEN c.shuffle_total_bytes >= 1048576 THEN 'SHUFFLE_HEAVY'
                ELSE 'BALANCED_OR_LOW_SIGNAL' END AS workload_profile,
           b.memory_bytes_spilled <= 0 AND c.memory_bytes_spilled > 0 AS new_memory,
           b.disk_bytes_spilled <= 0 AND c.disk_bytes_spilled > 0 AS new_disk,
           greatest(b.executor_run_time_ms, c.executor_run_time_ms) < {BUDGET_RULES.min_executor_runtime_ms}
             AND greatest(b.shuffle_total_bytes, c.shuffle_total_bytes) < {BUDGET_RULES.min_shuffle_bytes}
             AS low_signal,
           CAST(json_object({_BUDGET_JSON.format(side='b')}) AS VARCHAR) AS baseline_metrics,
           CAST(json_object({_BUDGET_JSON.format(side='c')}) AS VARCHAR) AS candidate_metrics
    FROM {_latest('approved_baseline')} b JOIN {_latest('candidate')} c USING (workload_name))"""

_DELTAS = ", ".join([*budget.GROWTH, "spill_delta_pct"])
_SUPPLIER = "CAST(substr(workload_name, 10) AS BIGINT) % 3"
_JUDGED = f"""{_PAIRS},
limits(workload_profile, runtime, written, read, tasks, stages) AS (
    VALUES {', '.join(_limits(p) for p in (budget.SHUFFLE_HEAVY, budget.MEMORY_PRESSURE, budget.BALANCED))}),
judged AS (
    SELECT *, concat_ws(',',
        CASE WHEN executor_run_time_delta_pct > runtime THEN 'MAX_EXECUTOR_RUNTIME_GROWTH_PCT' END,
        CASE WHEN shuffle_written_delta_pct > written THEN 'MAX_SHUFFLE_WRITTEN_GROWTH_PCT' END,
        CASE WHEN shuffle_read_delta_pct > read THEN 'MAX_SHUFFLE_READ_GROWTH_PCT' END,
        CASE WHEN num_tasks_delta_pct > tasks THEN 'MAX_NUM_TASKS_GROWTH_PCT' END,
        CASE WHEN num_stages_delta_pct > stages THEN 'MAX_NUM_STAGES_GROWTH_PCT' END,
        CASE WHEN new_memory THEN 'MEMORY_SPILL_BYTES_ABOVE_BUDGET' END,
        CASE WHEN new_disk THEN 'DISK_SPILL_BYTES_ABOVE_BUDGET' END) AS failed_rules
    FROM pairs JOIN limits USING (workload_profile))"""
_DECISION = f"""{_JUDGED}
SELECT baseline_run_id, candidate_run_id, workload_name, workload_profile,
       CASE WHEN low_signal THEN 'WARNING_LOW_SIGNAL' WHEN failed_rules <> '' THEN 'FAIL'
            ELSE 'PASS' END AS decision,
       failed_rules, CASE WHEN low_signal THEN 'LOW_SIGNAL_LOCAL_RUN' ELSE '' END AS warning_flags,
       {_DELTAS}, baseline_metrics, candidate_metrics
FROM judged"""

_OVERHEAD = f"""WITH measured AS (
    SELECT strftime(o_orderdate, '%Y') AS benchmark_id,
           CASE o_orderstatus WHEN 'F' THEN 'none' WHEN 'O' THEN 'stage' ELSE 'task' END AS mode,
           CAST(round(o_totalprice * 100) AS BIGINT) // 100 AS ms, o_custkey AS tasks,
           CAST(round(o_totalprice * 100) AS BIGINT) AS bytes
    FROM orders WHERE o_orderpriority <> '5-LOW'),
by_mode AS (
    SELECT benchmark_id, mode, count(*) AS runs, CAST(sum(ms) AS DOUBLE) / count(ms) AS avg_ms,
           quantile_cont(CAST(ms AS DOUBLE), 0.5) AS median_ms,
           CASE WHEN mode <> 'none' THEN CAST(sum(tasks) AS DOUBLE) / count(*) END AS avg_num_tasks,
           CASE WHEN mode <> 'none' THEN CAST(sum(bytes) AS DOUBLE) / count(*) END
             AS avg_shuffle_bytes_written
    FROM measured GROUP BY 1, 2),
compared AS (
    SELECT m.*, avg_ms - base_avg AS avg_delta_ms, median_ms - base_median AS median_delta_ms,
           base_avg, base_median
    FROM by_mode m LEFT JOIN (SELECT benchmark_id, avg_ms AS base_avg, median_ms AS base_median
                              FROM by_mode WHERE mode = 'none') USING (benchmark_id))
SELECT benchmark_id, mode, runs, avg_ms, median_ms, avg_delta_ms,
       {rounded('avg_delta_ms / base_avg * 100.0', 4)} AS avg_delta_pct, median_delta_ms,
       {rounded('median_delta_ms / base_median * 100.0', 4)} AS median_delta_pct,
       avg_num_tasks, avg_shuffle_bytes_written
FROM compared"""

_RATES_SQL = ", ".join(
    f"round(CAST({metric} AS DOUBLE) / greatest(CAST(source_rows_for_date AS DOUBLE) / 1000000.0, "
    f"CAST(0.000001 AS DOUBLE)), 4) AS {name}"
    for name, metric in history.RATES.items()
)
_DAILY = f"""{event_queries.PLAN},
counters AS (
    SELECT 'batch-' || (k % 2) AS run_id, event_date AS processing_date,
           {bigint('sum(cents)')} AS executor_run_time_ms,
           {bigint('sum(cents + k)')} AS input_bytes,
           {_cents("event_type = 'click'")} AS shuffle_bytes_read,
           {_cents("event_type IN ('view', 'signup')")} AS shuffle_bytes_written,
           {_cents("event_type = 'error'")} AS memory_bytes_spilled,
           {_cents("event_type = 'purchase'")} AS disk_bytes_spilled,
           {bigint('sum(k)')} AS jvm_gc_time_ms, max(k) % 5 + 1 AS num_stages, max(k) + 1 AS num_tasks,
           count(*) AS records_read, count(*) FILTER (WHERE event_type = 'purchase') AS records_written,
           max(ts) AS created_at
    FROM typed GROUP BY 1, 2),
rates AS (
    SELECT run_id, run_id || '-' || strftime(processing_date, '%Y%m%d') AS date_run_id,
           'early_partition_filter' AS filter_strategy, c.* EXCLUDE (run_id),
           shuffle_bytes_read + shuffle_bytes_written AS shuffle_total_bytes,
           expected_rows AS source_rows_for_date, volume_multiplier, spike_label, true AS planned
    FROM counters c JOIN planned ON event_date = processing_date),
daily AS (SELECT *, {_RATES_SQL} FROM rates)"""

_HISTORY_NUMBERS = ", ".join(f"CAST({name} AS DOUBLE) AS {name}" for name in history.HISTORY_NUMBERS)
_HISTORY = f"""{_DAILY},
history AS (
    SELECT run_id, date_run_id, filter_strategy, processing_date, spike_label, {_HISTORY_NUMBERS},
           created_at,
           CASE WHEN source_rows_for_date > 0 THEN CAST(records_read AS DOUBLE) / source_rows_for_date END
             AS records_read_to_expected_ratio,
           CASE WHEN source_rows_for_date > 0
                THEN CAST(shuffle_bytes_written AS DOUBLE) / source_rows_for_date END
             AS shuffle_written_per_source_row
    FROM daily)"""
_LATEST_RUN = "(SELECT run_id FROM history ORDER BY created_at DESC, run_id DESC LIMIT 1)"
_BASELINES = ", ".join(
    f"coalesce(nullif(quantile_cont({name}, 0.5) FILTER (WHERE spike_label = 'NORMAL' "
    f"AND {name} <> 0), 0.0), 1.0) AS {name}_baseline"
    for name in history.DRIFT_METRICS
)
_INDEXES = ", ".join(f"{name} / {name}_baseline AS {name}_index" for name in history.DRIFT_METRICS)

_EVENT_COLUMNS = """run_id AS log, "stageId", CAST(0 AS BIGINT) AS "stageAttempt",
       "index" * 5 + "stageId" AS "taskId", "index", "executorId", host, true AS successful, duration,
       "executorRunTime", "jvmGCTime", "recordsRead", "bytesRead", "recordsWritten",
       "shuffleRecordsRead", "shuffleTotalBytesRead" + 7 AS "shuffleTotalBytesRead",
       "shuffleBytesWritten", "memoryBytesSpilled", "diskBytesSpilled\""""
_STEP = "CASE WHEN \"stageId\" <= 2 THEN 'load' ELSE 'report' END"
_EVENT_SUMS = ", ".join(
    f'CAST(sum("{name}") AS BIGINT) AS "{name}"'
    for name in _COUNTERS
)

SQL = {
    "task_stage_stats": f"WITH {TASKS}, {_stage_stats('shuffleRecordsRead')} SELECT * FROM stats",
    "task_skew_stage": f"{_skewed('shuffleTotalBytesRead')} SELECT * FROM chosen",
    "task_skew_stage_by_duration": f"{_skewed('duration')} SELECT * FROM chosen",
    "empty_partition_stage": f"{_STARVED} SELECT * FROM chosen",
    "task_metric_summary": f"WITH {TASKS}, rows_per_metric AS ({_metric_rows('tasks')}) {_SUMMARY_RATIOS}",
    "task_metric_quantiles": f"WITH {TASKS}, rows_per_metric AS ({_EXACT_ROWS}) {_SUMMARY_RATIOS}",
    "task_outliers_slow": f"WITH {TASKS} "
    + _outliers(
        "run_id",
        '"executorRunTime" DESC, duration DESC, "stageId", "index"',
        where='"recordsWritten" > 0',
    ),
    "task_outliers_high": f"WITH {TASKS} " + _outliers('run_id, "stageId"', _HIGH_ORDER),
    "task_outliers_low": f"WITH {TASKS} " + _outliers('run_id, "stageId"', _LOW_ORDER),
    "skew_diagnosis_outliers": f"{_skewed('shuffleTotalBytesRead')} "
    + _outliers('run_id, "stageId"', _HIGH_ORDER, _CHOSEN_TASKS),
    "skew_diagnosis_summaries": f"{_skewed('shuffleTotalBytesRead')}, chosen_tasks AS {_CHOSEN_TASKS}, "
    f"rows_per_metric AS ({_metric_rows('chosen_tasks')}) {_SUMMARY_RATIOS} WHERE max > 0",
    "starvation_diagnosis_outliers": f"{_STARVED} "
    + _outliers('run_id, "stageId"', _LOW_ORDER, _CHOSEN_TASKS),
    "stage_rollup": f"""WITH {TASKS} SELECT run_id, count(DISTINCT "stageId") AS "numStages",
       count(*) AS "numTasks", {_SUMS} FROM tasks GROUP BY 1""",
    "task_aggregate": f"""WITH {TASKS} SELECT run_id, count(*) AS "numTasks", {_SUMS}
FROM tasks GROUP BY 1""",
    "metric_usefulness": f"""WITH {RUNS},
reasons AS (
    SELECT run_id, CASE WHEN input IS NULL THEN 'Missing required metrics: executorRunTime'
        WHEN sh_read IS NULL AND sh_written IS NULL THEN 'Expected at least one shuffle metric' END
        AS reason FROM runs)
SELECT run_id, reason IS NULL AS valid, reason FROM reasons""",
    "numeric_metrics": f"""WITH {RUNS}
SELECT run_id, stages AS "numStages", tasks AS "numTasks", run_ms AS "executorRunTime",
       input AS "bytesRead", records_read AS "recordsRead", records_written AS "recordsWritten",
       sh_read AS "shuffleTotalBytesRead", sh_written AS "shuffleBytesWritten",
       mem AS "memoryBytesSpilled", disk AS "diskBytesSpilled", gc_ms AS "jvmGCTime" FROM runs""",
    "run_metrics": f"WITH {_PLAIN} SELECT * FROM plain",
    "stage_normalized": f"WITH {_PLAIN} "
    "SELECT * EXCLUDE (app_name, workload_name, workload_variant, created_at) FROM ratios",
    "workload_fingerprint": _FINGERPRINT,
    "budget_growth": f"{_PAIRS} SELECT workload_name, baseline_run_id, candidate_run_id, {_DELTAS} FROM pairs",
    "budget_decision": _DECISION,
    "budget_unpaired": f"""{_JUDGED}
SELECT workload_name, baseline_run_id, candidate_run_id,
       CASE WHEN low_signal THEN 'WARNING_LOW_SIGNAL' WHEN failed_rules <> '' THEN 'FAIL'
            ELSE 'PASS' END AS decision, failed_rules, executor_run_time_delta_pct
FROM judged WHERE {_SUPPLIER} = 2
UNION ALL SELECT workload_name, NULL, run_id, 'MISSING_BASELINE', '', NULL
FROM {_latest('candidate')} WHERE {_SUPPLIER} = 0
UNION ALL SELECT workload_name, run_id, NULL, 'MISSING_CANDIDATE', '', NULL
FROM {_latest('approved_baseline')} WHERE {_SUPPLIER} = 1""",
    "overhead_summary": _OVERHEAD,
    "backfill_rates": f"WITH {_DAILY} SELECT * EXCLUDE (created_at) FROM daily",
    "backfill_rates_all_dates": f"""WITH {_DAILY}
SELECT processing_date, records_read, planned, source_rows_for_date,
       {', '.join(f'CASE WHEN planned THEN {name} END AS {name}' for name in history.RATES)}
FROM (SELECT * REPLACE (volume_multiplier > 1 AS planned,
             CASE WHEN volume_multiplier > 1 THEN source_rows_for_date END AS source_rows_for_date)
      FROM daily)""",
    "backfill_records": f"""WITH {_DAILY},
span AS (SELECT CAST(min(event_date) AS VARCHAR) AS d0, CAST(max(event_date) AS VARCHAR) AS d1 FROM planned)
SELECT run_id, date_run_id, 'daily' AS app_name, CAST(NULL AS VARCHAR) AS application_id,
       CAST(NULL AS VARCHAR) AS lab_id, 'activity' AS workload_name, filter_strategy,
       CAST(processing_date AS VARCHAR) AS processing_date, d0 AS source_start_date,
       d1 AS source_end_date, source_rows_for_date, volume_multiplier, spike_label,
       'stage' AS collector_type, executor_run_time_ms, records_read, records_written, input_bytes,
       shuffle_bytes_written, shuffle_bytes_read, shuffle_total_bytes, memory_bytes_spilled,
       disk_bytes_spilled, jvm_gc_time_ms, num_stages, num_tasks, runtime_per_million_rows,
       shuffle_per_million_rows, input_bytes_per_million_rows, tasks_per_million_rows,
       'activity/event_date=' || CAST(processing_date AS VARCHAR) AS business_output_path
FROM daily, span""",
    "unplanned_dates": f"""WITH {event_queries.PLAN}
SELECT DISTINCT event_date AS processing_date FROM typed
WHERE event_date NOT IN (SELECT event_date FROM planned WHERE volume_multiplier > 1)""",
    "metrics_history": f"WITH {_HISTORY} SELECT * EXCLUDE (created_at) FROM history",
    "latest_batch": f"WITH {_HISTORY} SELECT run_id FROM {_LATEST_RUN}",
    "latest_batch_history": f"""WITH {_HISTORY}
SELECT run_id, processing_date, records_read FROM history WHERE run_id IN {_LATEST_RUN}""",
    "run_kpis": f"""WITH {_HISTORY}
SELECT run_id, count(*) AS processed_dates, sum(source_rows_for_date) AS expected_source_rows,
       count(*) FILTER (WHERE spike_label IN ('MEDIUM_SPIKE', 'VOLUME_SPIKE')) AS spike_days,
       first(processing_date ORDER BY shuffle_bytes_written DESC, processing_date) AS max_shuffle_day,
       first(processing_date ORDER BY source_rows_for_date DESC, processing_date) AS max_volume_day,
       max(source_rows_for_date) AS max_expected_rows, max(records_read) AS max_records_read,
       max(shuffle_bytes_written) AS max_shuffle_written,
       max(executor_run_time_ms) AS max_executor_run_time_ms
FROM history GROUP BY 1""",
    "normal_day_baseline": f"WITH {_HISTORY} SELECT run_id, {_BASELINES} FROM history GROUP BY 1",
    "drift_index": f"""WITH {_HISTORY},
baselines AS (SELECT run_id, {_BASELINES} FROM history GROUP BY 1)
SELECT run_id, processing_date, spike_label, source_rows_for_date, {_INDEXES}
FROM history JOIN baselines USING (run_id)""",
    "pressure_signals": f"""WITH {_HISTORY}
SELECT run_id, processing_date, spike_label, shuffle_bytes_written / 1048576.0 AS shuffle_written_mb,
       shuffle_bytes_read / 1048576.0 AS shuffle_read_mb,
       source_rows_for_date / 1000000.0 AS source_rows_millions,
       memory_bytes_spilled / 1048576.0 AS memory_spill_mb,
       disk_bytes_spilled / 1048576.0 AS disk_spill_mb,
       coalesce(CASE WHEN executor_run_time_ms > 0 THEN jvm_gc_time_ms / executor_run_time_ms END, 0.0)
         * 100.0 AS gc_ratio_pct
FROM history""",
    "eventlog_tasks": f"WITH {TASKS} SELECT {_EVENT_COLUMNS} FROM tasks",
    "eventlog_tasks_by_step": f"""WITH {TASKS}
SELECT run_id AS log, "stageId", "index" * 5 + "stageId" AS "taskId", "executorRunTime",
       {_STEP} AS step, 'step ' || {_STEP} AS description FROM tasks""",
    "eventlog_stage_aggregate": f"""WITH {TASKS}, logged AS (SELECT {_EVENT_COLUMNS} FROM tasks)
SELECT log, {_STEP} AS step, count(DISTINCT "stageId") AS "numStages", count(*) AS "numTasks",
       {_EVENT_SUMS}
FROM logged GROUP BY 1, 2""",
}
