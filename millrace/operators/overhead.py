"""Cost of observing a workload: repeated runs compared by collector mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.operators.aggregates import exact_median

WITHOUT_COLLECTOR = "none"
# Fixed value: one record per benchmark run.
OVERHEAD_RUN_SCHEMA = """
    schema_version int, benchmark_id string, run_id string, iteration int, is_warmup boolean,
    mode string, config_name string, app_name string, application_id string,
    workload_output_path string, started_at_utc string, ended_at_utc string,
    app_wall_ms long, spark_session_ms long, workload_wall_ms long, collector_begin_end_ms long,
    collector_report_ms long, collector_aggregate_ms long, metadata_write_ms long,
    validation_wall_ms long, row_count long, num_stages long, num_tasks long,
    executor_run_time_ms long, shuffle_bytes_written long, spark_version string
"""


# Fixed value: raw counters kept with a benchmark run.
RUN_COUNTERS = {
    "num_stages": "numStages",
    "num_tasks": "numTasks",
    "executor_run_time_ms": "executorRunTime",
    "shuffle_bytes_written": "shuffleBytesWritten",
}


def overhead_run_records(timings: DataFrame, counters: DataFrame) -> DataFrame:
    """Benchmark runs with the counters of their collector, matched by ``run_id``. A run
    without a collector has unknown counters, not zeros."""
    collected = counters.select(
        "run_id", *[F.col(raw).alias(name) for name, raw in RUN_COUNTERS.items()]
    )
    known = timings.drop(*RUN_COUNTERS).join(collected, "run_id", "left")
    return known.withColumns(
        {
            name: F.when(F.col("mode") != WITHOUT_COLLECTOR, F.col(name).cast("long"))
            for name in RUN_COUNTERS
        }
    )


def overhead_summary(runs: DataFrame, benchmark: list[str]) -> DataFrame:
    """Average and median workload time per benchmark and mode against the mode without
    a collector. Warm-ups are left out, and counters of that mode are unknown: the
    zeros stored there were never measured."""
    measured = runs.where(~F.col("is_warmup"))
    keys = [*benchmark, "mode"]

    def collected(name: str) -> Column:
        return F.avg(F.when(F.col("mode") != WITHOUT_COLLECTOR, F.col(name))).alias(f"avg_{name}")

    averages = measured.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("runs"),
        (
            F.sum("workload_wall_ms").cast("double") / F.count("workload_wall_ms").cast("double")
        ).alias("avg_ms"),
        collected("num_tasks"),
        collected("shuffle_bytes_written"),
    )
    medians = exact_median(measured, keys, "workload_wall_ms").withColumnRenamed(
        "median", "median_ms"
    )
    by_mode = averages.join(medians, keys, "left")
    # A benchmark has one row per mode here, so this window is tiny.
    same_benchmark = Window.partitionBy(*benchmark)

    def without_collector(name: str) -> Column:
        return F.max(F.when(F.col("mode") == WITHOUT_COLLECTOR, F.col(name))).over(same_benchmark)

    compared = by_mode.withColumns(
        {"base_avg": without_collector("avg_ms"), "base_median": without_collector("median_ms")}
    )

    def pct(delta: Column, base: Column) -> Column:
        return F.when(base > 0, F.round(delta / base * F.lit(100.0), 4))

    avg_delta = F.col("avg_ms") - F.col("base_avg")
    median_delta = F.col("median_ms") - F.col("base_median")
    return compared.select(
        *keys,
        "runs",
        "avg_ms",
        "median_ms",
        avg_delta.alias("avg_delta_ms"),
        pct(avg_delta, F.col("base_avg")).alias("avg_delta_pct"),
        median_delta.alias("median_delta_ms"),
        pct(median_delta, F.col("base_median")).alias("median_delta_pct"),
        "avg_num_tasks",
        "avg_shuffle_bytes_written",
    )
