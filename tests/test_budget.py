"""Golden vectors for the runtime budget and the output comparison."""

import json

import pytest

from millrace.operators import budget
from millrace.operators.budget import BudgetRules, Thresholds

DEFAULTS = dict(
    executor_run_time_ms=5000,
    shuffle_bytes_written=1000,
    shuffle_bytes_read=1000,
    memory_bytes_spilled=0,
    disk_bytes_spilled=0,
    jvm_gc_time_ms=0,
    num_stages=4,
    num_tasks=100,
    input_bytes=0,
    records_read=0,
    records_written=0,
)
SIGNAL = dict(min_executor_runtime_ms=100, min_shuffle_bytes=100)


def pairs(spark, baseline, candidate):
    columns = ", ".join(f"{name} long" for name in budget.BUDGET_METRICS)
    schema = f"workload_name string, workload_variant string, run_id string, created_at string, {columns}"
    rows = [
        {**DEFAULTS, **changes, "workload_name": "w", "workload_variant": v, "run_id": v, "created_at": "1"}
        for v, changes in (("base", baseline), ("cand", candidate))
    ]
    return budget.pair_runs(spark.createDataFrame(rows, schema), "base", "cand")


def decide(spark, baseline, candidate, rules):
    return budget.budget_decisions(pairs(spark, baseline, candidate), rules).first()


def test_growth(spark):
    row = budget.growth(
        pairs(
            spark,
            dict(executor_run_time_ms=1000, shuffle_bytes_written=100, shuffle_bytes_read=200, num_tasks=10),
            dict(
                executor_run_time_ms=1250,
                shuffle_bytes_written=150,
                shuffle_bytes_read=300,
                num_tasks=15,
                num_stages=5,
            ),
        )
    ).first()
    assert row.executor_run_time_delta_pct == 25.0
    assert row.shuffle_written_delta_pct == row.shuffle_read_delta_pct == row.num_tasks_delta_pct == 50.0
    assert row.num_stages_delta_pct == 25.0
    assert row.gc_time_delta_pct == row.spill_delta_pct == 0.0


def test_pass(spark):
    rules = BudgetRules(Thresholds(20.0, 20.0, 20.0, 20.0, 20.0), {}, **SIGNAL)
    row = decide(spark, {}, dict(executor_run_time_ms=5050, shuffle_bytes_written=1010), rules)
    assert (row.decision, row.failed_rules) == ("PASS", "")


def test_task_growth_fails(spark):
    rules = BudgetRules(Thresholds(max_num_tasks_growth_pct=10.0), {}, **SIGNAL)
    row = decide(spark, {}, dict(num_tasks=200), rules)
    assert (row.decision, row.failed_rules) == ("FAIL", "MAX_NUM_TASKS_GROWTH_PCT")


def test_growth_equal_to_the_limit_passes(spark):
    rules = BudgetRules(Thresholds(max_num_tasks_growth_pct=100.0), {}, **SIGNAL)
    assert decide(spark, {}, dict(num_tasks=200), rules).decision == "PASS"


def test_low_signal_outranks_failure(spark):
    row = decide(
        spark,
        dict(executor_run_time_ms=100, shuffle_bytes_written=100, num_tasks=1),
        dict(executor_run_time_ms=120, shuffle_bytes_written=200, num_tasks=3),
        BudgetRules(),
    )
    assert row.decision == "WARNING_LOW_SIGNAL" and row.warning_flags == "LOW_SIGNAL_LOCAL_RUN"
    assert "MAX_NUM_TASKS_GROWTH_PCT" in row.failed_rules


def test_shuffle_heavy_profile_is_stricter(spark):
    rules = BudgetRules(profiles={"SHUFFLE_HEAVY": {"max_shuffle_written_growth_pct": 10.0}})
    big, bigger = 1_000_000, 1_200_000
    row = decide(
        spark,
        dict(shuffle_bytes_written=big, shuffle_bytes_read=big),
        dict(shuffle_bytes_written=bigger, shuffle_bytes_read=bigger),
        rules,
    )
    assert (row.workload_profile, row.decision) == ("SHUFFLE_HEAVY", "FAIL")
    assert row.failed_rules == "MAX_SHUFFLE_WRITTEN_GROWTH_PCT"


def test_new_spill_fails(spark):
    row = decide(spark, {}, dict(memory_bytes_spilled=1), BudgetRules())
    assert (row.workload_profile, row.decision) == ("MEMORY_PRESSURE", "FAIL")
    assert row.failed_rules == "MEMORY_SPILL_BYTES_ABOVE_BUDGET"


def test_old_spill_is_no_regression(spark):
    spill = dict(memory_bytes_spilled=100, disk_bytes_spilled=50, shuffle_bytes_written=2_000_000)
    row = decide(spark, spill, spill, BudgetRules())
    assert (row.workload_profile, row.decision, row.failed_rules) == ("SHUFFLE_HEAVY", "PASS", "")


def test_profiles_inherit_defaults():
    rules = BudgetRules()
    assert rules.thresholds("MEMORY_PRESSURE") == Thresholds(max_executor_runtime_growth_pct=15.0)
    assert rules.thresholds("OTHER") == Thresholds()


def test_latest_run_of_each_variant_is_compared(spark):
    columns = ", ".join(f"{name} long" for name in budget.BUDGET_METRICS)
    schema = f"workload_name string, workload_variant string, run_id string, created_at string, {columns}"
    rows = [
        {**DEFAULTS, "workload_name": "w", "workload_variant": v, "run_id": f"{v}{t}", "created_at": str(t)}
        for v in ("base", "cand", "other")
        for t in (1, 3, 2)
    ] + [{**DEFAULTS, "workload_name": "alone", "workload_variant": "base", "run_id": "x", "created_at": "1"}]
    found = budget.pair_runs(spark.createDataFrame(rows, schema), "base", "cand")
    both = found.where("candidate IS NOT NULL").collect()
    assert [(r.workload_name, r.baseline.run_id, r.candidate.run_id) for r in both] == [
        ("w", "base3", "cand3")
    ]
    alone = budget.budget_decisions(found).where("workload_name = 'alone'").first()
    assert (alone.decision, alone.failed_rules, alone.warning_flags) == ("MISSING_CANDIDATE", "", "")
    assert alone.executor_run_time_delta_pct is None and alone.workload_profile is None


def test_decision_record_keeps_both_metric_sets(spark):
    decisions = budget.budget_decisions(pairs(spark, {}, dict(num_tasks=200)), BudgetRules())
    row = budget.decision_records(decisions, run_id="d1", app_name="guard").first()
    assert (row.run_id, row.app_name) == ("d1", "guard") and row.created_at
    assert json.loads(row.baseline_metrics) == DEFAULTS
    assert json.loads(row.candidate_metrics)["num_tasks"] == 200


OUTPUT = "order_month string, region string, category string, gross_revenue double, order_count long, customer_count long"


@pytest.mark.parametrize(
    ("change", "compatible", "differing"),
    [
        (None, True, 0),
        (("2026-02", "EU", "category_02", 20.5, 3, 2), False, 2),
        (("2026-02", "EU", "category_02", 20.01, 2, 2), True, 2),
    ],
)
def test_output_compatibility(spark, change, compatible, differing):
    rows = [("2026-01", "US", "category_01", 10.25, 1, 1), ("2026-02", "EU", "category_02", 20.0, 2, 2)]
    baseline = spark.createDataFrame(rows, OUTPUT)
    candidate = spark.createDataFrame([rows[0], change or rows[1]], OUTPUT)
    row = budget.output_compatibility(baseline, candidate).first()
    assert (row.compatible, row.differing_rows) == (compatible, differing)
    assert row.identical == (differing == 0)
    assert row.baseline_total_revenue == 30.25


def test_output_with_other_types_or_rows_is_incompatible(spark):
    rows = [("2026-01", "US", "category_01", 10.25, 1, 1)]
    baseline = spark.createDataFrame(rows, OUTPUT)
    other_type = baseline.withColumn("customer_count", baseline.customer_count.cast("int"))
    assert budget.output_compatibility(baseline, other_type).first().compatible is False
    assert budget.output_compatibility(baseline, baseline.union(baseline)).first().compatible is False
    other = budget.output_compatibility(baseline, baseline.drop("gross_revenue")).first()
    assert other.same_schema is False and other.compatible is False
