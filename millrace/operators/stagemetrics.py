"""Run-level stage metrics: roll-up, usefulness, normalised forms and the workload
fingerprint. One row per run; rules apply to all runs at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.labels import any_of, joined_names
from millrace.functions.ratios import safe_ratio

REQUIRED = ("numStages", "numTasks", "executorRunTime")
SHUFFLE = ("shuffleBytesWritten", "shuffleTotalBytesRead")
# Normalised name for each raw counter.
COUNTER_NAMES = {
    "executor_run_time_ms": "executorRunTime",
    "input_bytes": "bytesRead",
    "shuffle_bytes_read": "shuffleTotalBytesRead",
    "shuffle_bytes_written": "shuffleBytesWritten",
    "memory_bytes_spilled": "memoryBytesSpilled",
    "disk_bytes_spilled": "diskBytesSpilled",
    "jvm_gc_time_ms": "jvmGCTime",
    "num_stages": "numStages",
    "num_tasks": "numTasks",
    "records_read": "recordsRead",
    "records_written": "recordsWritten",
}
OPTIONAL_METRICS = (
    "shuffle_bytes_written",
    "shuffle_bytes_read",
    "jvm_gc_time_ms",
    "memory_bytes_spilled",
    "disk_bytes_spilled",
    "input_bytes",
)
TASK_COUNTERS = (
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


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns; booleans are not numbers here."""
    return [field.name for field in df.schema.fields if isinstance(field.dataType, T.NumericType)]


def numeric_metrics(df: DataFrame, identity: list[str]) -> DataFrame:
    """Identity columns and every numeric metric; other values are dropped."""
    return df.select(*identity, *[n for n in numeric_columns(df) if n not in identity])


def task_aggregate(tasks: DataFrame, run: list[str]) -> DataFrame:
    """Sums of the task counters per run."""
    present = [name for name in TASK_COUNTERS if name in tasks.columns]
    return tasks.groupBy(*run).agg(
        F.count(F.lit(1)).alias("numTasks"), *[F.sum(name).alias(name) for name in present]
    )


def stage_rollup(tasks: DataFrame, run: list[str]) -> DataFrame:
    """Stage-level aggregate per run. Tasks are first summed per stage, so counting
    stages needs no distinct over tasks."""
    per_stage = task_aggregate(tasks, [*run, "stageId"])
    sums = [name for name in per_stage.columns if name not in (*run, "stageId")]
    return per_stage.groupBy(*run).agg(
        F.count(F.lit(1)).alias("numStages"), *[F.sum(name).alias(name) for name in sums]
    )


def raw(df: DataFrame, name: str) -> Column:
    """A raw counter, null where the table does not have it."""
    return F.col(name).cast("long") if name in df.columns else F.lit(None).cast("long")


def counter(df: DataFrame, name: str) -> Column:
    return F.coalesce(raw(df, COUNTER_NAMES[name]), F.lit(0).cast("long"))


def with_usefulness(df: DataFrame) -> DataFrame:
    """Adds ``reason`` (null when useful) and ``valid``. A null counter was not emitted."""
    missing = F.concat_ws(", ", *[F.when(raw(df, n).isNull(), F.lit(n)) for n in REQUIRED])
    reason = (
        F.when(missing != "", F.concat(F.lit("Missing required metrics: "), missing))
        .when(raw(df, "numStages") <= 0, F.lit("Metric numStages must be greater than zero"))
        .when(raw(df, "numTasks") <= 0, F.lit("Metric numTasks must be greater than zero"))
        .when(raw(df, "executorRunTime") < 0, F.lit("Metric executorRunTime must be non-negative"))
        .when(
            ~any_of([raw(df, n).isNotNull() for n in SHUFFLE]),
            F.lit("Expected at least one shuffle metric"),
        )
    )
    return df.withColumn("reason", reason).withColumn("valid", F.col("reason").isNull())


def _require(df: DataFrame) -> DataFrame:
    for name in REQUIRED:
        if name not in df.columns:
            raise ValueError(f"metrics table has no {name} column")
    return df


def _rejection() -> Column:
    """Why a run has no ratios, or null: a required counter is null, or below one."""
    null = F.concat_ws(",", *[F.when(F.col(n).isNull(), F.lit(n)) for n in REQUIRED])
    return (
        F.when(null != "", F.concat(F.lit("null: "), null))
        .when(F.col("numStages") < 1, F.lit("no stage"))
        .when(F.col("numTasks") < 1, F.lit("no task"))
    )


def _usable(df: DataFrame) -> DataFrame:
    """Rows with the required counters and at least one stage and task."""
    return _require(df).where(_rejection().isNull())


def rejected_runs(df: DataFrame, identity: list[str]) -> DataFrame:
    """The runs that ``run_metrics`` cannot use, each with its ``rejection``."""
    found = _require(df).withColumn("rejection", _rejection())
    return found.where("rejection IS NOT NULL").select(*identity, *REQUIRED, "rejection")


def run_metrics(df: DataFrame, identity: list[str]) -> DataFrame:
    """The eleven counters under their normalised names with shuffle and spill totals.
    Runs without stages, tasks or run time are in ``rejected_runs`` instead."""
    plain = _usable(df).select(
        *identity, *[counter(df, name).alias(name) for name in COUNTER_NAMES]
    )
    return plain.select(
        "*",
        (F.col("shuffle_bytes_read") + F.col("shuffle_bytes_written")).alias("shuffle_total_bytes"),
        (F.col("memory_bytes_spilled") + F.col("disk_bytes_spilled")).alias("spill_total_bytes"),
    )


def normalized_metrics(df: DataFrame, identity: list[str]) -> DataFrame:
    """``run_metrics`` with shuffle amplification, GC, spill and task-density ratios."""
    zero = F.lit(0.0)
    return run_metrics(df, identity).select(
        "*",
        safe_ratio(F.col("shuffle_total_bytes"), F.col("input_bytes")).alias(
            "shuffle_amplification_ratio"
        ),
        F.coalesce(safe_ratio(F.col("jvm_gc_time_ms"), F.col("executor_run_time_ms")), zero).alias(
            "gc_time_ratio"
        ),
        F.coalesce(
            safe_ratio(
                F.col("spill_total_bytes"),
                F.greatest(F.col("input_bytes"), F.col("shuffle_total_bytes"), F.lit(1)),
            ),
            zero,
        ).alias("spill_ratio"),
        safe_ratio(F.col("num_tasks"), F.col("num_stages"), 4).alias("task_density_score"),
    )


def contract_ready(df: DataFrame, identity: list[str]) -> DataFrame:
    """Counters with an ``<metric>_available`` flag each, so that an emitted zero and a
    metric that was never emitted stay apart. Every run is kept, and a required counter
    that is null stays null, so that the contract judges it."""
    required = ("executor_run_time_ms", "num_stages", "num_tasks")
    return _require(df).select(
        *identity,
        *[counter(df, name).alias(name) for name in OPTIONAL_METRICS],
        *[raw(df, COUNTER_NAMES[name]).cast("long").alias(name) for name in required],
        *[
            raw(df, COUNTER_NAMES[name]).isNotNull().alias(f"{name}_available")
            for name in OPTIONAL_METRICS
        ],
    )


@dataclass(frozen=True)
class FingerprintRules:
    """Thresholds; the defaults are fixed values."""

    high_shuffle_amplification_ratio: float = 2.0
    high_shuffle_total_bytes: int = 67108864
    high_input_bytes: int = 134217728
    minimum_reliable_input_bytes: int = 1048576
    low_shuffle_bytes: int = 1048576
    high_gc_time_ratio: float = 0.10
    spill_detected_bytes: int = 1
    high_task_density_score: float = 128.0
    high_total_tasks: int = 1000
    low_signal_executor_runtime_ms: int = 1000
    low_signal_shuffle_bytes: int = 1048576
    low_parallelism_task_threshold: int = 4


# Advice per workload profile.
NEXT_STEPS = {
    "SHUFFLE_HEAVY": "Review joins, aggregations, partitioning, and unnecessary repartitions.",
    "MEMORY_PRESSURE": "Review wide transformations, executor memory, partition sizing, caching, and aggregation strategy.",
    "IO_HEAVY_SCAN": "Review partition pruning, column pruning, file layout, and predicate pushdown.",
    "GC_PRESSURE": "Review object pressure, caching, UDFs, serialization, executor memory, and partition sizing.",
    "MANY_SMALL_TASKS": "Review partition count, small files, and unnecessary repartitions.",
    "LOW_PARALLELISM_SIGNAL": "Review available cores, partition count, scheduler behavior, and whether the workload exposes enough parallelism.",
    "BALANCED_OR_LOW_SIGNAL": "No strong diagnosis; run at a larger scale or compare against a baseline.",
}


def workload_fingerprint(
    normalized: DataFrame, rules: FingerprintRules = FingerprintRules()
) -> DataFrame:
    """Adds profile, flags and advice to normalised metrics. The ratios are read from
    the input and not computed again."""
    c = F.col
    spill = c("memory_bytes_spilled") + c("disk_bytes_spilled")
    reliable = c("input_bytes") >= rules.minimum_reliable_input_bytes
    runtime_is_low = c("executor_run_time_ms") < rules.low_signal_executor_runtime_ms

    amplified = reliable & F.coalesce(
        c("shuffle_amplification_ratio") >= rules.high_shuffle_amplification_ratio, F.lit(False)
    )
    voluminous = c("shuffle_total_bytes") >= rules.high_shuffle_total_bytes
    spilled = spill >= rules.spill_detected_bytes
    gc_bound = c("gc_time_ratio") >= rules.high_gc_time_ratio
    scan_bound = (c("input_bytes") >= rules.high_input_bytes) & (
        c("shuffle_total_bytes") <= rules.low_shuffle_bytes
    )
    task_bound = (c("num_tasks") >= rules.high_total_tasks) | (
        c("task_density_score") >= rules.high_task_density_score
    )
    few_tasks = (c("num_tasks") <= rules.low_parallelism_task_threshold) & ~runtime_is_low
    too_small = (
        runtime_is_low & (c("shuffle_total_bytes") < rules.low_signal_shuffle_bytes) & (spill == 0)
    )

    # A run too small to judge ends the decision; otherwise the first match wins.
    profile = (
        F.when(too_small, F.lit("BALANCED_OR_LOW_SIGNAL"))
        .when(spilled, F.lit("MEMORY_PRESSURE"))
        .when(gc_bound, F.lit("GC_PRESSURE"))
        .when(scan_bound, F.lit("IO_HEAVY_SCAN"))
        .when(amplified | voluminous, F.lit("SHUFFLE_HEAVY"))
        .when(task_bound, F.lit("MANY_SMALL_TASKS"))
        .when(few_tasks, F.lit("LOW_PARALLELISM_SIGNAL"))
        .otherwise(F.lit("BALANCED_OR_LOW_SIGNAL"))
    )
    flags = joined_names(
        ("INPUT_BYTES_UNAVAILABLE_FOR_RATIO", c("input_bytes") == 0),
        ("INPUT_BYTES_LOW_CONFIDENCE_FOR_RATIO", (c("input_bytes") != 0) & ~reliable),
        ("HIGH_SHUFFLE_AMPLIFICATION", amplified),
        ("HIGH_SHUFFLE_VOLUME", voluminous),
        ("SPILL_DETECTED", spilled),
        ("HIGH_GC_RATIO", gc_bound),
        ("HIGH_INPUT_LOW_SHUFFLE", scan_bound),
        ("TASK_OVERHEAD_SIGNAL", task_bound),
        ("LOW_PARALLELISM_SIGNAL", few_tasks),
        ("LOW_SIGNAL", c("workload_profile") == "BALANCED_OR_LOW_SIGNAL"),
    )
    advice = F.create_map(*[F.lit(text) for pair in NEXT_STEPS.items() for text in pair])
    return (
        normalized.withColumn("workload_profile", profile)
        .withColumn("diagnostic_flags", flags)
        .withColumn("recommended_next_step", advice[c("workload_profile")])
    )


STAGE_METRIC_COLUMNS = (
    "run_id",
    "app_name",
    "application_id",
    "workload_name",
    "workload_variant",
    "collector_type",
    "executor_run_time_ms",
    "input_bytes",
    "shuffle_total_bytes",
    "shuffle_bytes_read",
    "shuffle_bytes_written",
    "memory_bytes_spilled",
    "disk_bytes_spilled",
    "jvm_gc_time_ms",
    "num_stages",
    "num_tasks",
    "records_read",
    "records_written",
    "created_at",
)
FINGERPRINT_COLUMNS = (
    "run_id",
    "app_name",
    "application_id",
    "workload_name",
    "workload_variant",
    "executor_run_time_ms",
    "input_bytes",
    "shuffle_bytes_read",
    "shuffle_bytes_written",
    "memory_bytes_spilled",
    "disk_bytes_spilled",
    "jvm_gc_time_ms",
    "num_stages",
    "num_tasks",
    "shuffle_amplification_ratio",
    "gc_time_ratio",
    "spill_ratio",
    "task_density_score",
    "workload_profile",
    "diagnostic_flags",
    "recommended_next_step",
    "created_at",
)


def _record(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The stored columns in order; identity a table lacks is null, a missing creation
    time is now and the collector is the stage collector."""
    fill = {
        "created_at": F.current_timestamp().cast("string"),
        "collector_type": F.lit("stage"),
    }
    nothing = F.lit(None).cast("string")
    return df.select(
        *[
            (F.col(name) if name in df.columns else fill.get(name, nothing)).alias(name)
            for name in columns
        ]
    )


def stage_metric_records(normalized: DataFrame) -> DataFrame:
    return _record(normalized, STAGE_METRIC_COLUMNS)


def fingerprint_records(classified: DataFrame) -> DataFrame:
    return _record(classified, FINGERPRINT_COLUMNS)
