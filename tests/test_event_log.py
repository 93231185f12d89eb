"""Event logs written by real applications."""

import os
import subprocess
import sys
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.operators import history
from millrace.operators.stagemetrics import NEXT_STEPS, with_usefulness
from millrace.plans import temporal
from millrace.plans.observability import fingerprint_runs
from millrace.sources import eventlog

APP = """
import sys
sys.path.insert(0, sys.argv[2])
from pyspark.sql import SparkSession, functions as F
from millrace.sources.eventlog import job_step
spark = (
    SparkSession.builder.master("local[2]").appName("logged")
    .config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true")
    .config("spark.eventLog.dir", sys.argv[1]).config("spark.eventLog.compress", "false")
    .config("spark.eventLog.rolling.enabled", sys.argv[3])
    .config("spark.sql.shuffle.partitions", "3").config("spark.sql.adaptive.enabled", "false")
    .getOrCreate()
)
with job_step(spark, "summary", "sum per bucket"):
    df = spark.range(0, 1000, 1, 2).groupBy((F.col("id") % 5).alias("b")).agg(F.sum("id"))
    df.write.format("noop").mode("overwrite").save()
with job_step(spark, "count"):
    spark.range(0, 100, 1, 4).write.format("noop").mode("overwrite").save()
from datetime import date
from millrace.generate import events, volume
from millrace.plans import temporal
from millrace.sources.artifacts import Artifact
plan = volume.VolumePlan(
    date(2026, 1, 1), date(2026, 1, 2), 500, {date(2026, 1, 2): 10}, target_rows_per_partition=1000
)
source = sys.argv[1].replace("/logs", "/data") + "/events" + sys.argv[3]
events.generate_events(volume.plan_volumes(spark, plan)).write.partitionBy("event_date").parquet(source)
stored = spark.read.parquet(source)
for day in (plan.start, plan.end):
    temporal.backfill_day(spark, stored, day, Artifact(source + "-activity"))
spark.range(10).write.format("noop").mode("overwrite").save()
spark.stop()
"""


@pytest.fixture(scope="module")
def log_folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("app")
    folder = base / "logs"
    folder.mkdir()
    script = base / "logged_app.py"
    script.write_text(APP)
    root = str(Path(__file__).resolve().parent.parent)
    for rolling in ("false", "true"):
        subprocess.run(
            [sys.executable, str(script), f"file:{folder}", root, rolling],
            check=True,
            timeout=180,
            capture_output=True,
            env={**os.environ, "PYTHONDONTWRITEBYTECODE": "1"},
        )
    return str(folder)


def test_tasks_stages_and_steps(spark, log_folder):
    logged = eventlog.read_event_logs(spark, log_folder).cache()
    tasks = eventlog.task_metrics(logged)
    logs = [r.log for r in tasks.select("log").distinct().collect()]
    assert len(logs) == 2 and sum(log.startswith("eventlog_v2_") for log in logs) == 1
    assert tasks.where("not successful").isEmpty()
    for log in logs:
        runs = {r.step: r for r in eventlog.stage_aggregate(logged.where(F.col("log") == log)).collect()}
        assert set(runs) == {"summary", "count", "backfill 2026-01-01", "backfill 2026-01-02", None}
        assert (runs["summary"].numStages, runs["summary"].numTasks) == (2, 5)
        assert (runs["count"].numStages, runs["count"].numTasks) == (1, 4)
        assert runs["summary"].shuffleBytesWritten > 0
        assert runs["summary"].shuffleTotalBytesRead == runs["summary"].shuffleBytesWritten
        by_step = eventlog.tasks_by_step(logged.where(F.col("log") == log))
        described = {r.description for r in by_step.where("step = 'summary'").collect()}
        assert described == {"sum per bucket"}
        assert by_step.where("step = 'summary'").agg(F.sum("shuffleRecordsRead")).first()[0] == 10


def test_logged_runs_can_be_classified(spark, log_folder):
    runs = eventlog.stage_aggregate(eventlog.read_event_logs(spark, log_folder)).withColumn(
        "run_id", F.concat_ws("/", "log", F.coalesce("step", F.lit("other")))
    )
    assert with_usefulness(runs).where("not valid").isEmpty()
    found = fingerprint_runs(runs, ["run_id"])["fingerprints"].collect()
    assert len(found) == 10
    for row in found:
        # The profile depends on how fast the machine was; the counters do not.
        assert row.recommended_next_step == NEXT_STEPS[row.workload_profile]
        assert row.num_tasks >= row.num_stages >= 1 and row.shuffle_bytes_written < 2**20


def test_logged_backfills_show_the_spike(spark, log_folder):
    plan = spark.createDataFrame(
        [(date(2026, 1, 1), 500, 1, "NORMAL"), (date(2026, 1, 2), 5000, 10, "MEDIUM_SPIKE")],
        "event_date date, expected_rows long, volume_multiplier long, spike_label string",
    )
    raw = temporal.logged_backfills(eventlog.read_event_logs(spark, log_folder))
    identity = ["run_id", "date_run_id", "filter_strategy", "processing_date"]
    rates = history.backfill_rates(raw, plan, identity).collect()
    assert len(rates) == 4 and len({r.run_id for r in rates}) == 2
    for run in {r.run_id for r in rates}:
        by_label = {r.spike_label: r for r in rates if r.run_id == run}
        # Only the wanted date's files were read.
        assert by_label["NORMAL"].records_read == 500
        assert by_label["MEDIUM_SPIKE"].records_read == 5000
        assert by_label["NORMAL"].tasks_per_million_rows > by_label["MEDIUM_SPIKE"].tasks_per_million_rows
