"""Contract rules on a clean row and its broken copies."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import contract
from millrace.operators.contract import Contract
from millrace.plans.observability import gate_metrics
from millrace.sources.artifacts import Artifact, read_artifact
from millrace.sources.scratch import scratch_folder

CLEAN = {
    "run_id": "run-1",
    "app_name": "app",
    "application_id": "application-1",
    "lab_id": "area-1",
    "workload_name": "retail_contract",
    "workload_variant": "stage",
    "collector_name": "sparkmeasure_stage_metrics",
    "metric_scope": "stage",
    "contract_version": "1.0.0",
    "created_at": "2026-07-03T00:00:00+00:00",
    "num_stages": 2,
    "num_tasks": 8,
    "executor_run_time_ms": 100,
    "shuffle_bytes_written": 20,
    "shuffle_bytes_read": 30,
    "jvm_gc_time_ms": 5,
    "memory_bytes_spilled": 0,
    "disk_bytes_spilled": 0,
    "input_bytes": 10,
    **{f"{name}_available": True for name in contract.OPTIONAL_METRICS},
}


def clean(spark):
    kinds = {str: "string", bool: "boolean", int: "long"}
    schema = ", ".join(f"{name} {kinds[type(value)]}" for name, value in CLEAN.items())
    return spark.createDataFrame([CLEAN], schema)


def by_rule(results):
    return {row.rule_id: row for row in results.collect()}


def test_clean_row_passes_all_ten_rules(spark):
    jobs = gate_metrics(clean(spark), validation_run_id="v", source_path="p", created_at="t")
    rows = by_rule(jobs["results"])
    assert len(rows) == 10 and all(r.decision == "PASS" and r.failed_count == 0 for r in rows.values())
    summary = jobs["summary"].first()
    assert (summary.total_rules, summary.passed_rules, summary.decision) == (10, 10, "PASS")


def test_broken_copies(spark):
    copies = contract.with_broken_copies(clean(spark))
    assert copies.count() == 8 and copies.columns == list(CLEAN)
    jobs = gate_metrics(copies)
    failed = {name: row.failed_count for name, row in by_rule(jobs["results"]).items()}
    assert failed == {
        "SCHEMA_REQUIRED_COLUMNS": 0,
        "SCHEMA_OPTIONAL_METRIC_AVAILABILITY_COLUMNS": 0,
        "SEMANTIC_REFERENCED_COLUMNS_EXIST": 0,
        "SEMANTIC_NUM_STAGES_GT_ZERO": 1,
        "SEMANTIC_NUM_TASKS_GT_ZERO": 1,
        "SEMANTIC_NON_NEGATIVE_METRICS": 1,
        "SEMANTIC_CREATED_AT_NOT_NULL": 1,
        "CORRELATION_IDENTITY_NOT_NULL": 2,
        "CORRELATION_EXPECTED_VALUES": 1,
        "CORRELATION_UNIQUENESS_KEY": 1,
    }
    layers = {row.rule_type: row.decision for row in jobs["layers"].collect()}
    assert layers == {"SCHEMA": "PASS", "SEMANTIC": "FAIL", "CORRELATION": "FAIL"}
    summary = jobs["summary"].first()
    assert (summary.passed_rules, summary.failed_rules, summary.decision) == (3, 7, "FAIL")


def test_samples_are_keys_with_their_nulls(spark):
    rows = by_rule(contract.contract_results(contract.with_broken_copies(clean(spark))))
    keys = [json.loads(k) for k in rows["CORRELATION_IDENTITY_NOT_NULL"].sample_failed_keys.split(";")]
    assert keys == [
        {
            "metric_scope": "stage",
            "run_id": run,
            "workload_name": "retail_contract",
            "workload_variant": "stage",
        }
        for run in ("run-1-null-created-at", None)
    ]


def test_at_most_five_samples_in_key_order(spark):
    many = spark.range(500).join(clean(spark).drop("run_id"), how="cross").select(
        F.format_string("run-%03d", "id").alias("run_id"), "*"
    )
    row = by_rule(contract.contract_results(many.withColumn("num_tasks", F.lit(0))))[
        "SEMANTIC_NUM_TASKS_GT_ZERO"
    ]
    assert row.failed_count == 500
    assert [json.loads(k)["run_id"] for k in row.sample_failed_keys.split(";")] == [
        f"run-00{i}" for i in range(5)
    ]


def test_null_keys_are_duplicates_of_each_other(spark):
    two = clean(spark).withColumn("run_id", F.lit(None).cast("string"))
    row = by_rule(contract.contract_results(two.union(two)))["CORRELATION_UNIQUENESS_KEY"]
    assert row.failed_count == 1


def test_switched_off_columns_are_listed_but_not_counted(spark):
    rules = Contract(require_columns=False)
    row = by_rule(contract.contract_results(clean(spark).drop("lab_id"), rules))[
        "SCHEMA_REQUIRED_COLUMNS"
    ]
    assert (row.failed_count, row.decision, row.sample_failed_keys) == (0, "PASS", "lab_id")


def test_stage_and_task_switches_touch_only_the_reference_rule(spark):
    rules = Contract(num_stages_gt_zero=False, num_tasks_gt_zero=False)
    df = clean(spark).drop("num_stages").withColumn("num_tasks", F.lit(0))
    rows = by_rule(contract.contract_results(df, rules))
    assert rows["SEMANTIC_REFERENCED_COLUMNS_EXIST"].failed_count == 0
    assert rows["SEMANTIC_NUM_STAGES_GT_ZERO"].sample_failed_keys == "missing_column=num_stages"
    assert rows["SEMANTIC_NUM_TASKS_GT_ZERO"].failed_count == 1


def test_created_at_switch(spark):
    df = clean(spark).withColumn("created_at", F.lit(None).cast("string"))
    rows = by_rule(contract.contract_results(df, Contract(created_at_not_null=False)))
    assert rows["SEMANTIC_CREATED_AT_NOT_NULL"].failed_count == 0


def test_severity_does_not_decide(spark):
    rules = Contract(severity={"zero_stage_or_task": "WARN"})
    row = by_rule(contract.contract_results(clean(spark).withColumn("num_tasks", F.lit(0)), rules))[
        "SEMANTIC_NUM_TASKS_GT_ZERO"
    ]
    assert (row.severity, row.decision) == ("WARN", "FAIL")


def test_table_without_any_key_column(spark):
    df = clean(spark).drop(*Contract().uniqueness_key)
    row = by_rule(contract.contract_results(df))["CORRELATION_UNIQUENESS_KEY"]
    assert row.failed_count == 4 and row.sample_failed_keys.startswith("missing_column=run_id,")


def test_empty_table_passes_the_value_rules(spark):
    rows = by_rule(contract.contract_results(clean(spark).limit(0)))
    assert len(rows) == 10 and all(row.failed_count == 0 for row in rows.values())


# --- judged while written -------------------------------------------------------------


def stored_results(spark, df, **options):
    target = Artifact(scratch_folder(spark, "checked"), **options)
    checked = contract.write_checked(df, target, source_path="p", created_at="t")
    return checked, read_artifact(spark, target, df.schema)


@pytest.mark.parametrize("lost", [(), ("num_tasks", "input_bytes"), ("run_id",), Contract.uniqueness_key])
def test_written_table_gives_the_same_rule_rows(spark, lost):
    copies = contract.with_broken_copies(clean(spark)).drop(*lost)
    copies = copies.unionByName(copies).repartition(5)
    checked, stored = stored_results(spark, copies)
    plain = contract.contract_results(copies, source_path="p", created_at="t")
    assert checked.schema.names == plain.schema.names
    assert sorted(checked.collect()) == sorted(plain.collect())
    assert sorted(map(str, stored.collect())) == sorted(map(str, copies.collect()))


def test_partitioned_target_and_partitions_without_rows(spark):
    copies = contract.with_broken_copies(clean(spark)).repartition(16)
    checked, stored = stored_results(spark, copies, partition_by=("lab_id",))
    plain = contract.contract_results(copies, source_path="p", created_at="t")
    assert sorted(checked.collect()) == sorted(plain.collect())
    assert stored.count() == 8


@pytest.mark.parametrize("known_empty", [True, False])
def test_written_table_without_rows(spark, known_empty):
    none = clean(spark).limit(0) if known_empty else clean(spark).where("run_id = 'other'")
    checked, stored = stored_results(spark, none)
    assert all(r.decision == "PASS" for r in checked.collect()) and stored.count() == 0


def test_source_is_worked_out_once_and_a_clean_table_is_read_by_its_keys(spark, plan_of):
    touched = spark.sparkContext.accumulator(0)

    def touch(batches):
        for batch in batches:
            touched.add(batch.num_rows)
            yield batch

    df = clean(spark)
    checked, _ = stored_results(spark, df.mapInArrow(touch, df.schema))
    assert all(r.decision == "PASS" and r.sample_failed_keys == "" for r in checked.collect())
    assert touched.value == 1
    read = [line for line in plan_of(checked).splitlines() if line.startswith("ReadSchema")]
    assert read and all("num_tasks" not in line and "run_id" in line for line in read)


def test_counts_and_samples_of_a_written_table_share_one_shuffle(spark, plan_of):
    copies = contract.with_broken_copies(clean(spark)).repartition(4)
    checked, _ = stored_results(spark, copies)
    failed = {r.rule_id: r.failed_count for r in checked.collect() if r.failed_count}
    assert failed == {
        r.rule_id: r.failed_count
        for r in contract.contract_results(copies).collect()
        if r.failed_count
    }
    plan = plan_of(checked).split("== Initial Plan ==")[0]
    assert len(failed) > 5 and plan.count("ReusedExchange (") == 1


def test_appending_is_refused(spark):
    with pytest.raises(ValueError):
        contract.write_checked(clean(spark), Artifact("/nowhere", mode="append"))
