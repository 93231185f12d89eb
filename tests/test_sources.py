"""Artifacts, file statistics, history and overhead tables."""

from datetime import date, datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.operators import history, overhead
from millrace.operators.profile import has_rows
from millrace.sources import files
from millrace.sources.artifacts import (
    Artifact,
    read_artifact,
    read_or_empty,
    run_output,
    single_run_output,
    write_artifact,
)


def test_write_refuses_then_replaces(spark, tmp_path):
    target = Artifact(str(tmp_path / "t"))
    write_artifact(spark.range(5), target)
    with pytest.raises(AnalysisException):
        write_artifact(spark.range(5), target)
    write_artifact(spark.range(3).withColumn("x", F.lit(1)), Artifact(target.path, mode="overwrite"))
    assert read_artifact(spark, target).columns == ["id", "x"]


def test_append_with_new_columns(spark, tmp_path):
    target = Artifact(str(tmp_path / "t"), mode="append", merge_schema=True)
    write_artifact(spark.range(2), target)
    write_artifact(spark.range(2).withColumn("x", F.lit("new")), target)
    df = read_artifact(spark, target)
    assert sorted(df.columns) == ["id", "x"] and df.where("x is null").count() == 2


def test_json_and_options(spark, tmp_path):
    target = Artifact(str(tmp_path / "t"), "json", options={"ignoreNullFields": False})
    write_artifact(spark.range(2).withColumn("x", F.lit(None).cast("string")), target)
    assert read_artifact(spark, target).columns == ["id", "x"]


def test_file_size_is_bounded(spark, tmp_path):
    target = Artifact(str(tmp_path / "t"))
    write_artifact(spark.range(0, 100, 1, 1), target, max_records_per_file=30)
    stats = files.file_stats(files.file_sizes(spark, target.path)).first()
    assert stats.file_count == 4 and stats.min_file_bytes > 0


def test_unknown_format_and_empty_path():
    with pytest.raises(ValueError):
        Artifact("x", "csvish")
    with pytest.raises(ValueError):
        Artifact("")


def test_missing_table_is_empty(spark, tmp_path):
    df = read_or_empty(spark, Artifact(str(tmp_path / "none")), "event_date date")
    assert df.isEmpty() and df.columns == ["event_date"] and not has_rows(df)


def test_outputs_per_run(spark, tmp_path):
    base = str(tmp_path / "runs")
    one = single_run_output(base, "b", "stage", 1, "r1")
    write_artifact(spark.range(4), one)
    with pytest.raises(AnalysisException):
        write_artifact(spark.range(4), one)
    two = spark.range(3).select(
        "id", F.lit("b").alias("benchmark_id"), F.lit("task").alias("mode"),
        F.lit(2).alias("iteration"), F.lit("r2").alias("run_id"),
    )
    write_artifact(two, run_output(base))
    counts = read_artifact(spark, Artifact(base)).groupBy("mode", "run_id").count().collect()
    assert {(r.mode, r.run_id, r["count"]) for r in counts} == {("stage", "r1", 4), ("task", "r2", 3)}


@pytest.mark.parametrize(
    ("sizes", "want"),
    [([], (0, 0, 0, 0, 0.0)), ([100, 250, 650], (3, 1000, 100, 650, 1000 / 3))],
)
def test_file_stats(spark, sizes, want):
    df = spark.createDataFrame([(s,) for s in sizes], "file_bytes long")
    assert tuple(files.file_stats(df).first()) == want


def test_file_sizes_match_the_disk(spark, tmp_path):
    path = tmp_path / "t"
    spark.range(1000).repartition(3).write.parquet(str(path))
    want = sorted(f.stat().st_size for f in path.glob("*.parquet"))
    assert sorted(r.file_bytes for r in files.file_sizes(spark, str(path)).collect()) == want


RAW = """run_id string, date_run_id string, filter_strategy string, processing_date date,
    created_at timestamp, numStages long, numTasks long, executorRunTime long, bytesRead long,
    recordsRead long, recordsWritten long, shuffleTotalBytesRead long, shuffleBytesWritten long"""
PLAN = "event_date date, expected_rows long, volume_multiplier long, spike_label string"


def daily(spark):
    rows = []
    for batch, run in enumerate(("old", "new")):
        for d in range(1, 6):
            slow = 1000 * d * (batch + 1)
            rows.append(
                (run, f"{run}-{d}", "early", date(2026, 1, d), datetime(2026, 2, 1 + batch, d), 4, 25,
                 slow, 1000, 10000, 12, 1500, 2500)
            )
    plan = [(date(2026, 1, d), 0 if d == 5 else 10_000, 1, "VOLUME_SPIKE" if d == 4 else "NORMAL") for d in range(1, 6)]
    raw = spark.createDataFrame(rows, RAW)
    identity = ["run_id", "date_run_id", "filter_strategy", "processing_date", "created_at"]
    return raw, spark.createDataFrame(plan, PLAN), identity


def test_rates_per_million_rows(spark):
    raw, plan, identity = daily(spark)
    row = history.backfill_rates(raw, plan, identity).where("date_run_id = 'old-5'").first()
    assert row.runtime_per_million_rows == 5000 / 0.000001
    row = history.backfill_rates(raw, plan, identity).where("run_id = 'old' and executor_run_time_ms = 4000").first()
    assert row.shuffle_per_million_rows == 400000.0 and row.tasks_per_million_rows == 2500.0
    five = history.backfill_rates(raw, plan.withColumn("expected_rows", F.lit(10_000)), identity)
    assert five.where("date_run_id = 'old-5'").first().runtime_per_million_rows == 500000.0


def test_unplanned_dates_are_reported(spark):
    raw, plan, identity = daily(spark)
    short = plan.where("event_date < '2026-01-04'")
    rates = history.backfill_rates(raw, short, identity)
    assert rates.where("planned").count() == 6
    left = rates.where("NOT planned").collect()
    assert len(left) == 4 and all(r.runtime_per_million_rows is None for r in left)
    assert sorted(str(r[0]) for r in history.unplanned_dates(raw, short).collect()) == [
        "2026-01-04",
        "2026-01-05",
    ]


def test_history_keeps_batches_apart(spark):
    raw, plan, identity = daily(spark)
    past = history.metrics_history(history.backfill_rates(raw, plan, identity))
    empty_day = past.where("processing_date = '2026-01-05'").first()
    assert empty_day.records_read_to_expected_ratio is None
    assert past.where("processing_date = '2026-01-01'").first().records_read_to_expected_ratio == 1.0
    assert history.latest_run(past).first().run_id == "new"
    assert history.of_latest_run(past).count() == 5
    base = {r.run_id: r for r in history.normal_day_baseline(past).collect()}
    # NORMAL days 1, 2, 3 and 5; day 5 has no planned rows and an enormous rate.
    assert base["old"].runtime_per_million_rows_baseline == 250000.0
    assert base["new"].runtime_per_million_rows_baseline == 500000.0
    index = history.drift_index(past).where("processing_date = '2026-01-04'").collect()
    assert {r.run_id: r.runtime_per_million_rows_index for r in index} == {"old": 1.6, "new": 1.6}
    kpis = {r.run_id: r for r in history.run_kpis(past).collect()}
    assert (kpis["new"].processed_dates, kpis["new"].spike_days) == (5, 1)
    assert str(kpis["new"].max_shuffle_day) == "2026-01-01"
    assert kpis["new"].max_executor_run_time_ms == 10000.0


def test_baseline_without_normal_days_is_one(spark):
    raw, plan, identity = daily(spark)
    spikes = plan.withColumn("spike_label", F.lit("VOLUME_SPIKE"))
    past = history.metrics_history(history.backfill_rates(raw, spikes, identity))
    assert history.normal_day_baseline(past).first().tasks_per_million_rows_baseline == 1.0


def test_overhead_summary(spark):
    runs = []
    for mode, times in {"none": (100, 110, 900), "stage": (120, 130, 140, 150), "task": (200,)}.items():
        for i, ms in enumerate(times):
            tasks = 0 if mode == "none" else 2581
            runs.append(("b", f"{mode}{i}", mode, False, ms, tasks, tasks))
        runs.append(("b", f"{mode}w", mode, True, 10**6, 1, 1))
    df = spark.createDataFrame(
        runs,
        "benchmark_id string, run_id string, mode string, is_warmup boolean, workload_wall_ms long,"
        "num_tasks long, shuffle_bytes_written long",
    )
    rows = {r["mode"]: r for r in overhead.overhead_summary(df, ["benchmark_id"]).collect()}
    assert (rows["none"].runs, rows["none"].avg_ms, rows["none"].median_ms) == (3, 370.0, 110.0)
    assert rows["none"].avg_num_tasks is None and rows["none"].median_delta_pct == 0.0
    assert (rows["stage"].median_ms, rows["stage"].median_delta_ms) == (135.0, 25.0)
    assert rows["stage"].median_delta_pct == 22.7273 and rows["stage"].avg_num_tasks == 2581.0
    assert rows["task"].avg_delta_ms == -170.0


def test_run_without_collector_has_unknown_counters(spark):
    timings = spark.createDataFrame(
        [("a", "none", 100, 0), ("b", "stage", 120, 0)],
        "run_id string, mode string, workload_wall_ms long, num_tasks long",
    )
    counters = spark.createDataFrame(
        [("b", 20, 2581, 900, 64)],
        "run_id string, numStages int, numTasks int, executorRunTime int, shuffleBytesWritten int",
    )
    rows = {r.run_id: r for r in overhead.overhead_run_records(timings, counters).collect()}
    assert rows["a"].num_tasks is None and rows["a"].shuffle_bytes_written is None
    assert (rows["b"].num_stages, rows["b"].num_tasks) == (20, 2581)


def test_overhead_schema_is_complete(spark):
    df = spark.createDataFrame([], overhead.OVERHEAD_RUN_SCHEMA)
    assert len(df.columns) == 26 and overhead.overhead_summary(df, ["benchmark_id"]).isEmpty()
