"""Statistics over task-metric tables of any number of runs.

Input: one row per finished task with ``stageId``, ``duration`` and any of the
metric columns below. ``run`` names the columns that identify a run; use ``[]``
for a table of one run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.functions.ratios import sentinel_ratio, skew_wording
from millrace.operators.quantiles import exact_quantiles
from millrace.operators.ranking import top_n

# The metrics that are summarised, in report order.
SUMMARY_METRICS = (
    "duration",
    "executorRunTime",
    "recordsRead",
    "bytesRead",
    "shuffleRecordsRead",
    "shuffleTotalBytesRead",
    "recordsWritten",
    "shuffleBytesWritten",
)
# Fixed value: columns shown for one outlier task.
OUTLIER_COLUMNS = (
    "stageId",
    "index",
    "executorId",
    "host",
    "duration",
    "executorRunTime",
    "recordsRead",
    "bytesRead",
    "shuffleRecordsRead",
    "shuffleTotalBytesRead",
    "recordsWritten",
    "shuffleBytesWritten",
    "memoryBytesSpilled",
    "diskBytesSpilled",
)
# Fixed value: what "little work" is measured by, best column first.
LOW_END_PREFERENCE = ("shuffleRecordsRead", "recordsWritten", "recordsRead", "duration")
HIGH_END_METRIC = "shuffleTotalBytesRead"
MIN_STAGE_TASKS = 4
TOP_N = 5
PERCENTILE_ACCURACY = 10000
EXACT_QUANTILES = {"p25": 250, "median": 500, "p75": 750, "p95": 950}


def high_end_metric(tasks: DataFrame) -> str:
    return HIGH_END_METRIC if HIGH_END_METRIC in tasks.columns else "duration"


def low_end_metric(tasks: DataFrame) -> str:
    return next((name for name in LOW_END_PREFERENCE if name in tasks.columns), "duration")


def present_columns(tasks: DataFrame, wanted: tuple[str, ...]) -> list[str]:
    return [name for name in wanted if name in tasks.columns]


def known(metric: str) -> Column:
    """The metric as double, with an unknown value counted as no work."""
    return F.coalesce(F.col(metric).cast("double"), F.lit(0.0))


def quartiles(metric: str) -> Column:
    """p25, p50, p75 of the known values in one mergeable sketch. Each is a value of
    the data, not an interpolation; unknown values are left out."""
    return F.percentile_approx(
        F.col(metric).cast("double"), [0.25, 0.50, 0.75], PERCENTILE_ACCURACY
    )


def is_empty(metric: str) -> Column:
    return known(metric) <= 0


def stage_stats(tasks: DataFrame, run: list[str], data_metric: str) -> DataFrame:
    """Distribution of duration and of one data metric for every stage at once.
    Stages with fewer than four tasks are left out."""
    grouped = tasks.groupBy(*run, "stageId").agg(
        F.count(F.lit(1)).alias("taskCount"),
        F.min(known("duration")).alias("minDuration"),
        quartiles("duration").alias("durationQuartiles"),
        F.max(known("duration")).alias("maxDuration"),
        F.min(known(data_metric)).alias("minData"),
        quartiles(data_metric).alias("dataQuartiles"),
        F.max(known(data_metric)).alias("maxData"),
        F.count_if(is_empty(data_metric)).alias("emptyTaskCount"),
    )
    median_duration, p75_duration = F.col("durationQuartiles")[1], F.col("durationQuartiles")[2]
    median_data, p75_data = F.col("dataQuartiles")[1], F.col("dataQuartiles")[2]
    return grouped.where(F.col("taskCount") >= MIN_STAGE_TASKS).select(
        *run,
        "stageId",
        "taskCount",
        "minDuration",
        median_duration.alias("medianDuration"),
        p75_duration.alias("p75Duration"),
        "maxDuration",
        "minData",
        median_data.alias("medianData"),
        p75_data.alias("p75Data"),
        "maxData",
        "emptyTaskCount",
        sentinel_ratio(median_duration, F.col("minDuration")).alias("durationMedianToMin"),
        sentinel_ratio(F.col("maxDuration"), p75_duration).alias("durationMaxToP75"),
        sentinel_ratio(median_data, F.col("minData")).alias("dataMedianToMin"),
        sentinel_ratio(F.col("maxData"), p75_data).alias("dataMaxToP75"),
        F.lit(data_metric).alias("dataMetric"),
    )


def _first_per_run(stages: DataFrame, run: list[str], order: list[Column]) -> DataFrame:
    if not run:
        return stages.orderBy(*order).limit(1)
    ranked = stages.withColumn(
        "_place", F.row_number().over(Window.partitionBy(*run).orderBy(*order))
    )
    return ranked.where(F.col("_place") == 1).drop("_place")


def skewed_stage(tasks: DataFrame, run: list[str]) -> DataFrame:
    """The stage of each run with the clearest long tail: first by data, and only
    where no stage moved data by duration. Ties go to the smallest stage id."""
    stages = stage_stats(tasks, run, high_end_metric(tasks))
    has_data = F.col("maxData") > 0
    order = [
        has_data.desc(),
        F.when(has_data, F.col("dataMaxToP75")).desc(),
        F.desc("durationMaxToP75"),
        F.when(has_data, F.col("maxData")).otherwise(F.col("maxDuration")).desc(),
        F.asc("stageId"),
    ]
    return _first_per_run(stages, run, order).withColumn(
        "skewSignal", skew_wording(F.col("dataMaxToP75"))
    )


def starved_stage(
    tasks: DataFrame, run: list[str], preferred_task_count: int | None = None
) -> DataFrame:
    """The stage of each run with the most tasks without work: first among the stages
    of the preferred size, then any; without empty tasks by the duration tail."""
    stages = stage_stats(tasks, run, low_end_metric(tasks))
    preferred = (
        F.col("taskCount") == preferred_task_count if preferred_task_count else F.lit(True)
    )
    starved = (F.col("medianData") > 0) & (F.col("emptyTaskCount") > 0)
    choice = (
        F.when(starved & preferred, F.lit(3))
        .when(starved, F.lit(2))
        .when(preferred, F.lit(1))
        .otherwise(F.lit(0))
    )
    order = [
        choice.desc(),
        F.when(starved, F.col("emptyTaskCount")).desc(),
        F.when(starved, F.col("dataMedianToMin")).otherwise(F.col("durationMedianToMin")).desc(),
        F.when(starved, F.col("dataMaxToP75")).otherwise(F.col("durationMaxToP75")).asc(),
        F.desc("taskCount"),
        F.asc("stageId"),
    ]
    return _first_per_run(stages, run, order)


def metric_summary(tasks: DataFrame, run: list[str]) -> DataFrame:
    """Distribution of every summary metric in every stage, one row per stage and
    metric. Tasks are aggregated once, wide, and only the result is unpivoted."""
    metrics = present_columns(tasks, SUMMARY_METRICS)
    measures = [F.count(F.lit(1)).alias("taskCount")]
    for name in metrics:
        measures.append(
            F.struct(
                F.min(known(name)).alias("min"),
                quartiles(name).alias("quartiles"),
                F.max(known(name)).alias("max"),
                F.count_if(is_empty(name)).alias("zeroTaskCount"),
            ).alias(name)
        )
    wide = tasks.groupBy(*run, "stageId").agg(*measures)
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("metric"),
                F.col(f"{name}.min").alias("min"),
                F.col(f"{name}.quartiles")[0].alias("p25"),
                F.col(f"{name}.quartiles")[1].alias("median"),
                F.col(f"{name}.quartiles")[2].alias("p75"),
                F.col(f"{name}.max").alias("max"),
                F.col(f"{name}.zeroTaskCount").alias("zeroTaskCount"),
            )
            for name in metrics
        ]
    )
    return wide.select(*run, "stageId", "taskCount", F.inline(rows)).select(
        "*",
        sentinel_ratio(F.col("median"), F.col("min")).alias("medianToMin"),
        sentinel_ratio(F.col("max"), F.col("p75")).alias("maxToP75"),
    )


def exact_metric_summary(tasks: DataFrame, run: list[str]) -> DataFrame:
    """``metric_summary`` for stages of any size and number, with exact quantiles.

    Every stage has its rows: ``eligible`` is false for those too small to be judged. Quantiles
    are over known values and null where there is none; extremes count unknown as no work.
    """
    metrics = present_columns(tasks, SUMMARY_METRICS)
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("metric"), F.col(name).cast("long").alias("value"))
            for name in metrics
        ]
    )
    values = tasks.select(*run, "stageId", F.inline(pairs))
    keys = [*run, "stageId", "metric"]
    summary = values.groupBy(F.struct(*keys).alias("_key")).agg(
        F.count(F.lit(1)).alias("taskCount"),
        F.min(known("value")).alias("min"),
        F.max(known("value")).alias("max"),
        F.count_if(is_empty("value")).alias("zeroTaskCount"),
    )
    quantiles = exact_quantiles(values, keys, "value", EXACT_QUANTILES).select(
        F.struct(*keys).alias("_key"),
        *[F.col(name).cast("double").alias(name) for name in EXACT_QUANTILES],
    )
    return summary.join(quantiles, "_key", "left").select(
        "_key.*",
        "taskCount",
        (F.col("taskCount") >= MIN_STAGE_TASKS).alias("eligible"),
        "min",
        *EXACT_QUANTILES,
        "max",
        "zeroTaskCount",
        sentinel_ratio(F.col("median"), F.col("min")).alias("medianToMin"),
        sentinel_ratio(F.col("max"), F.col("p75")).alias("maxToP75"),
    )


def _outliers(tasks: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    shown = present_columns(tasks, OUTLIER_COLUMNS)
    ties = [F.asc(name) for name in ("stageId", "index") if name in shown]
    columns = [name for name in by if name not in shown] + shown
    return top_n(tasks.select(*columns), by, order + ties, n)


def slowest_tasks(tasks: DataFrame, by: list[str], n: int = TOP_N) -> DataFrame:
    """Longest-running tasks that wrote something, where writing is known."""
    writers = (
        tasks.where(F.col("recordsWritten") > 0) if "recordsWritten" in tasks.columns else tasks
    )
    return _outliers(writers, by, [F.desc("executorRunTime"), F.desc("duration")], n)


def heaviest_tasks(tasks: DataFrame, by: list[str], n: int = TOP_N) -> DataFrame:
    """Tasks that read the most shuffle data."""
    order = [F.desc("duration"), F.desc("executorRunTime")]
    if HIGH_END_METRIC in tasks.columns:
        order = [F.desc(HIGH_END_METRIC), *order]
    return _outliers(tasks, by, order, n)


def emptiest_tasks(tasks: DataFrame, by: list[str], n: int = TOP_N) -> DataFrame:
    """Tasks with the least work."""
    order = [F.asc(low_end_metric(tasks)), F.asc("duration"), F.asc("executorRunTime")]
    return _outliers(tasks, by, order, n)
