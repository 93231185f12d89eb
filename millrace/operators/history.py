"""Metrics by business date: normalised rates, history, latest batch, drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import StructType

from millrace.functions.ratios import gc_share_pct, mebibytes, per_million
from millrace.operators.stagemetrics import run_metrics
from millrace.sources.artifacts import Artifact, read_artifact, write_artifact

RATES = {
    "runtime_per_million_rows": "executor_run_time_ms",
    "shuffle_per_million_rows": "shuffle_total_bytes",
    "input_bytes_per_million_rows": "input_bytes",
    "tasks_per_million_rows": "num_tasks",
}
HISTORY_TEXT = ("run_id", "date_run_id", "filter_strategy")
HISTORY_NUMBERS = (
    "volume_multiplier",
    "source_rows_for_date",
    "records_read",
    "executor_run_time_ms",
    "shuffle_bytes_written",
    "shuffle_bytes_read",
    "input_bytes",
    "num_stages",
    "num_tasks",
    "memory_bytes_spilled",
    "disk_bytes_spilled",
    "jvm_gc_time_ms",
    *RATES,
)
DRIFT_METRICS = ("runtime_per_million_rows", "shuffle_per_million_rows", "tasks_per_million_rows")


def backfill_rates(raw_metrics: DataFrame, plan: DataFrame, identity: list[str]) -> DataFrame:
    """Raw counters per processing date with the planned volume and rates per million
    planned rows. Dates outside the plan have no rates and ``planned`` false."""
    metrics = run_metrics(raw_metrics, identity).drop("spill_total_bytes")
    planned = plan.select(
        F.col("event_date").alias("processing_date"),
        F.col("expected_rows").alias("source_rows_for_date"),
        "volume_multiplier",
        "spike_label",
        F.lit(True).alias("planned"),
    )
    rows = F.col("source_rows_for_date")
    return metrics.join(planned, "processing_date", "left").withColumns(
        {
            name: F.when(rows.isNotNull(), per_million(F.col(metric), rows))
            for name, metric in RATES.items()
        }
        | {"planned": F.coalesce("planned", F.lit(False))}
    )


# Fixed value: one stored record per run and processing date.
BACKFILL_COLUMNS = (
    "run_id",
    "date_run_id",
    "app_name",
    "application_id",
    "lab_id",
    "workload_name",
    "filter_strategy",
    "processing_date",
    "source_start_date",
    "source_end_date",
    "source_rows_for_date",
    "volume_multiplier",
    "spike_label",
    "collector_type",
    "executor_run_time_ms",
    "records_read",
    "records_written",
    "input_bytes",
    "shuffle_bytes_written",
    "shuffle_bytes_read",
    "shuffle_total_bytes",
    "memory_bytes_spilled",
    "disk_bytes_spilled",
    "jvm_gc_time_ms",
    "num_stages",
    "num_tasks",
    *RATES,
    "business_output_path",
    "created_at",
)


def backfill_records(
    rates: DataFrame, plan: DataFrame, output_path: str, **identity: str
) -> DataFrame:
    """The stored form of ``backfill_rates``: dates as text, the plan's date range, the
    date's output folder and identity values; what is not given is null."""
    span = plan.agg(
        F.struct(
            F.min("event_date").cast("string").alias("first"),
            F.max("event_date").cast("string").alias("last"),
        )
    ).scalar()
    day = F.col("processing_date").cast("string")
    values = {
        "processing_date": day,
        "source_start_date": span["first"],
        "source_end_date": span["last"],
        "collector_type": F.lit("stage"),
        "business_output_path": F.concat(F.lit(f"{output_path}/event_date="), day),
        **{name: F.lit(value) for name, value in identity.items()},
    }
    nothing = F.lit(None).cast("string")
    return rates.select(
        *[
            values.get(name, F.col(name) if name in rates.columns else nothing).alias(name)
            for name in BACKFILL_COLUMNS
        ]
    )


def unplanned_dates(raw_metrics: DataFrame, plan: DataFrame) -> DataFrame:
    planned = plan.select(F.col("event_date").alias("processing_date"))
    return raw_metrics.select("processing_date").distinct().join(planned, "processing_date", "left_anti")


def metrics_history(metrics: DataFrame) -> DataFrame:
    """Typed history with two ratios to the planned rows; null for an empty day."""

    def per_source_row(name: str) -> Column:
        rows = F.col("source_rows_for_date")
        return F.when(rows > 0, F.col(name) / rows)

    typed = metrics.select(
        *[F.col(name).cast("string").alias(name) for name in HISTORY_TEXT],
        F.col("processing_date").cast("date").alias("processing_date"),
        F.coalesce(F.col("spike_label").cast("string"), F.lit("UNKNOWN")).alias("spike_label"),
        *[F.col(name).cast("double").alias(name) for name in HISTORY_NUMBERS],
        F.col("created_at").cast("timestamp").alias("created_at"),
    )
    return typed.select(
        "*",
        per_source_row("records_read").alias("records_read_to_expected_ratio"),
        per_source_row("shuffle_bytes_written").alias("shuffle_written_per_source_row"),
    ).orderBy("processing_date")


def append_run(history: DataFrame, store: Artifact) -> None:
    """Adds runs to the stored history, one partition each. A run that is written again
    replaces itself, and all others stay, so a failed append is simply repeated."""
    by_run = Artifact(store.path, store.format, "overwrite", store.options, ("run_id",))
    write_artifact(history, by_run, replace_partitions=True)


def stored_history(
    spark: SparkSession, store: Artifact, schema: StructType, view: str = "metrics_history"
) -> DataFrame:
    """The stored history, also as a temporary view for SQL."""
    history = read_artifact(spark, store, schema)
    history.createOrReplaceTempView(view)
    return history


def stored_latest_run(spark: SparkSession, view: str = "metrics_history") -> DataFrame:
    """Rows of the newest run in the view, by date. The run is found from two columns; its
    name is a filter on the partitions, so the other runs' files are not opened."""
    return spark.sql(
        f"""
        SELECT * FROM {view}
        WHERE run_id = (SELECT max_by(run_id, struct(created_at, run_id)) FROM {view})
        ORDER BY processing_date"""
    )


def latest_run(history: DataFrame) -> DataFrame:
    """One row: the run with the newest record (largest id on a tie)."""
    newest = F.max(F.struct("created_at", "run_id")).alias("newest")
    return history.agg(newest).select(
        F.col("newest.run_id").alias("run_id"), F.col("newest.created_at").alias("created_at")
    )


def of_latest_run(history: DataFrame) -> DataFrame:
    return history.join(latest_run(history).select("run_id"), "run_id", "left_semi")


def run_kpis(history: DataFrame) -> DataFrame:
    """One row per run: dates, volume, spikes, maxima and the days they fell on
    (the earliest day on a tie)."""

    def day_of_max(name: str) -> Column:
        return F.max_by(
            "processing_date", F.struct(F.col(name), -F.unix_date(F.col("processing_date")))
        )

    return history.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("processed_dates"),
        F.sum("source_rows_for_date").alias("expected_source_rows"),
        F.count_if(F.col("spike_label").isin("MEDIUM_SPIKE", "VOLUME_SPIKE")).alias("spike_days"),
        day_of_max("shuffle_bytes_written").alias("max_shuffle_day"),
        day_of_max("source_rows_for_date").alias("max_volume_day"),
        F.max("source_rows_for_date").alias("max_expected_rows"),
        F.max("records_read").alias("max_records_read"),
        F.max("shuffle_bytes_written").alias("max_shuffle_written"),
        F.max("executor_run_time_ms").alias("max_executor_run_time_ms"),
    )


def _baseline(name: str) -> Column:
    """Median of a metric over the NORMAL days, zeros left out; 1.0 without such a day."""
    normal = F.when((F.col("spike_label") == "NORMAL") & (F.col(name) != 0), F.col(name))
    return F.percentile(normal, 0.5)


def _usable_baseline(median: Column) -> Column:
    return F.coalesce(F.nullif(median, F.lit(0.0)), F.lit(1.0))


def normal_day_baseline(history: DataFrame) -> DataFrame:
    """Baseline of each drift metric per run. A run has one row per date, so a group
    stays small."""
    return history.groupBy("run_id").agg(
        *[_usable_baseline(_baseline(name)).alias(f"{name}_baseline") for name in DRIFT_METRICS]
    )


def drift_index(history: DataFrame) -> DataFrame:
    """Each drift metric over its normal-day baseline of the same run, in one pass."""
    same_run = Window.partitionBy("run_id")
    return history.select(
        "run_id",
        "processing_date",
        "spike_label",
        "source_rows_for_date",
        *[
            (F.col(name) / _usable_baseline(_baseline(name).over(same_run))).alias(f"{name}_index")
            for name in DRIFT_METRICS
        ],
    )


def pressure_signals(history: DataFrame) -> DataFrame:
    """Shuffle, spill and GC per date in readable units."""
    return history.select(
        "run_id",
        "processing_date",
        "spike_label",
        mebibytes(F.col("shuffle_bytes_written")).alias("shuffle_written_mb"),
        mebibytes(F.col("shuffle_bytes_read")).alias("shuffle_read_mb"),
        (F.col("source_rows_for_date").cast("double") / F.lit(1000000.0)).alias(
            "source_rows_millions"
        ),
        mebibytes(F.col("memory_bytes_spilled")).alias("memory_spill_mb"),
        mebibytes(F.col("disk_bytes_spilled")).alias("disk_spill_mb"),
        gc_share_pct(F.col("jvm_gc_time_ms"), F.col("executor_run_time_ms")).alias("gc_ratio_pct"),
    )
