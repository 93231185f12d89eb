"""Golden vectors for run metrics, fingerprints and usefulness."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import stagemetrics as sm
from millrace.operators.stagemetrics import FingerprintRules

FULL = dict(
    run_id="r1",
    numStages=4,
    numTasks=25,
    executorRunTime=5000,
    bytesRead=1000,
    shuffleTotalBytesRead=1500,
    shuffleBytesWritten=2500,
    memoryBytesSpilled=100,
    diskBytesSpilled=50,
    jvmGCTime=500,
)
RAW_SCHEMA = """run_id string, numStages long, numTasks long, executorRunTime long, bytesRead long,
    shuffleTotalBytesRead long, shuffleBytesWritten long, memoryBytesSpilled long,
    diskBytesSpilled long, jvmGCTime long"""


def raw(spark, **changes):
    return spark.createDataFrame([{**FULL, **changes}], RAW_SCHEMA)


def test_ratios(spark):
    row = sm.normalized_metrics(raw(spark), ["run_id"]).first()
    assert row.shuffle_total_bytes == 4000
    assert row.shuffle_amplification_ratio == 4.0
    assert row.gc_time_ratio == 0.1
    assert row.spill_ratio == 0.0375
    assert row.task_density_score == 6.25


def test_unknown_input_has_no_amplification(spark):
    row = sm.normalized_metrics(raw(spark, bytesRead=None), ["run_id"]).first()
    assert row.input_bytes == 0 and row.shuffle_amplification_ratio is None


def test_required_columns_only(spark):
    slim = raw(spark).select("run_id", *sm.REQUIRED)
    row = sm.contract_ready(slim, ["run_id"]).first().asDict()
    assert all(row[name] == 0 and row[f"{name}_available"] is False for name in sm.OPTIONAL_METRICS)


def test_emitted_zero_is_available(spark):
    row = sm.contract_ready(raw(spark, bytesRead=0), ["run_id"]).first()
    assert row.input_bytes == 0 and row.input_bytes_available is True


def test_missing_required_column_is_rejected(spark):
    with pytest.raises(ValueError, match="numStages"):
        sm.run_metrics(raw(spark).drop("numStages"), ["run_id"])


def test_useless_rows_are_left_out(spark):
    assert sm.run_metrics(raw(spark, numTasks=0), ["run_id"]).isEmpty()
    assert sm.run_metrics(raw(spark, executorRunTime=None), ["run_id"]).isEmpty()


def test_rejected_runs_are_reported_and_reach_the_gate(spark):
    bad = raw(spark, run_id="a", numTasks=0).union(raw(spark, run_id="b", numStages=None))
    runs = bad.union(raw(spark))
    found = {r.run_id: r.rejection for r in sm.rejected_runs(runs, ["run_id"]).collect()}
    assert found == {"a": "no task", "b": "null: numStages"}
    ready = {r.run_id: r for r in sm.contract_ready(runs, ["run_id"]).collect()}
    assert set(ready) == {"a", "b", "r1"}
    assert ready["a"].num_tasks == 0 and ready["b"].num_stages is None


@pytest.mark.parametrize(
    ("changes", "reason"),
    [
        ({}, None),
        ({"numStages": None, "numTasks": None}, "Missing required metrics: numStages, numTasks"),
        ({"numStages": 0}, "Metric numStages must be greater than zero"),
        ({"numTasks": -1}, "Metric numTasks must be greater than zero"),
        ({"executorRunTime": -1}, "Metric executorRunTime must be non-negative"),
        (
            {"shuffleTotalBytesRead": None, "shuffleBytesWritten": None},
            "Expected at least one shuffle metric",
        ),
        ({"shuffleTotalBytesRead": None}, None),
    ],
)
def test_usefulness(spark, changes, reason):
    row = sm.with_usefulness(raw(spark, **changes)).first()
    assert (row.reason, row.valid) == (reason, reason is None)


def test_numeric_metrics_leave_out_flags_and_text(spark):
    df = raw(spark).withColumn("flag", F.lit(True)).withColumn("note", F.lit("x"))
    kept = sm.numeric_metrics(df, ["run_id"]).columns
    assert "flag" not in kept and "note" not in kept and "numTasks" in kept


CLASSIFIED = """executor_run_time_ms long, input_bytes long, shuffle_total_bytes long,
    memory_bytes_spilled long, disk_bytes_spilled long, gc_time_ratio double, num_stages long,
    num_tasks long, shuffle_amplification_ratio double, task_density_score double"""


@pytest.mark.parametrize(
    ("values", "rules", "profile", "flags"),
    [
        (
            (20000, 10000, 600, 0, 0, 0.005, 4, 100, 6.0, 25.0),
            FingerprintRules(minimum_reliable_input_bytes=1000),
            "SHUFFLE_HEAVY",
            "HIGH_SHUFFLE_AMPLIFICATION",
        ),
        (
            (20000, 100, 600, 0, 0, 0.005, 4, 100, 6.0, 25.0),
            FingerprintRules(minimum_reliable_input_bytes=1000, high_shuffle_total_bytes=1000000),
            "BALANCED_OR_LOW_SIGNAL",
            "INPUT_BYTES_LOW_CONFIDENCE_FOR_RATIO,LOW_SIGNAL",
        ),
        (
            (20000, 10000, 600, 1, 0, 0.005, 4, 100, 6.0, 25.0),
            FingerprintRules(minimum_reliable_input_bytes=1000),
            "MEMORY_PRESSURE",
            "HIGH_SHUFFLE_AMPLIFICATION,SPILL_DETECTED",
        ),
        (
            (10000, 0, 0, 0, 0, 0.2, 4, 100, None, 25.0),
            FingerprintRules(),
            "GC_PRESSURE",
            "INPUT_BYTES_UNAVAILABLE_FOR_RATIO,HIGH_GC_RATIO",
        ),
        (
            (10000, 0, 0, 0, 0, 0.0, 4, 2000, None, 500.0),
            FingerprintRules(),
            "MANY_SMALL_TASKS",
            "INPUT_BYTES_UNAVAILABLE_FOR_RATIO,TASK_OVERHEAD_SIGNAL",
        ),
        (
            (100, 0, 0, 0, 0, 0.0, 1, 1, None, 1.0),
            FingerprintRules(),
            "BALANCED_OR_LOW_SIGNAL",
            "INPUT_BYTES_UNAVAILABLE_FOR_RATIO,LOW_SIGNAL",
        ),
        (
            (5000, 200000000, 10, 0, 0, 0.0, 1, 50, 0.0, 50.0),
            FingerprintRules(),
            "IO_HEAVY_SCAN",
            "HIGH_INPUT_LOW_SHUFFLE",
        ),
        (
            (5000, 2000000, 2000000, 0, 0, 0.0, 1, 3, 1.0, 3.0),
            FingerprintRules(),
            "LOW_PARALLELISM_SIGNAL",
            "LOW_PARALLELISM_SIGNAL",
        ),
    ],
)
def test_fingerprint(spark, values, rules, profile, flags):
    df = spark.createDataFrame([values], CLASSIFIED)
    row = sm.workload_fingerprint(df, rules).first()
    assert (row.workload_profile, row.diagnostic_flags) == (profile, flags)
    assert row.recommended_next_step == sm.NEXT_STEPS[profile]


def test_records_have_the_stored_columns(spark):
    normalized = sm.normalized_metrics(raw(spark), ["run_id"])
    assert tuple(sm.stage_metric_records(normalized).columns) == sm.STAGE_METRIC_COLUMNS
    classified = sm.workload_fingerprint(normalized)
    assert tuple(sm.fingerprint_records(classified).columns) == sm.FINGERPRINT_COLUMNS
    assert sm.stage_metric_records(normalized).first().collector_type == "stage"
