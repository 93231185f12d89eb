"""Metric jobs: from metric tables to diagnoses and decisions, for all runs at once."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.operators import budget, contract, stagemetrics, taskstats


def fingerprint_runs(
    raw_metrics: DataFrame,
    identity: list[str],
    rules: stagemetrics.FingerprintRules = stagemetrics.FingerprintRules(),
) -> dict[str, DataFrame]:
    """Stage-metric rows and fingerprint rows of every useful run, and the rejected runs."""
    normalized = stagemetrics.normalized_metrics(raw_metrics, identity)
    return {
        "stage_metrics": stagemetrics.stage_metric_records(normalized),
        "fingerprints": stagemetrics.fingerprint_records(
            stagemetrics.workload_fingerprint(normalized, rules)
        ),
        "rejected": stagemetrics.rejected_runs(raw_metrics, identity),
    }


def guard_runtime(
    raw_metrics: DataFrame,
    identity: list[str],
    baseline_variant: str,
    candidate_variant: str,
    rules: budget.BudgetRules = budget.BudgetRules(),
    baseline_output: DataFrame | None = None,
    candidate_output: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Budget decisions for every workload measured in either variant, the rejected runs, and
    the output comparison when both outputs are given."""
    runs = stagemetrics.run_metrics(raw_metrics, identity)
    pairs = budget.pair_runs(runs, baseline_variant, candidate_variant)
    result = {
        "stage_metrics": stagemetrics.stage_metric_records(runs),
        "decisions": budget.decision_records(budget.budget_decisions(pairs, rules)),
        "rejected": stagemetrics.rejected_runs(raw_metrics, identity),
    }
    if baseline_output is not None and candidate_output is not None:
        result["compatibility"] = budget.output_compatibility(baseline_output, candidate_output)
    return result


def gate_metrics(
    metrics: DataFrame,
    rules: contract.Contract = contract.Contract(),
    validation_run_id: str = "",
    source_path: str = "",
    created_at: str | None = None,
) -> dict[str, DataFrame]:
    """Contract results, layer decisions and summary of one metrics table."""
    results = contract.contract_results(metrics, rules, validation_run_id, source_path, created_at)
    return {
        "results": results,
        "layers": contract.layer_decisions(results),
        "summary": contract.contract_summary(results),
    }


def _of_stage(df: DataFrame, stages: DataFrame, run: list[str]) -> DataFrame:
    """Rows of the chosen stages. There is one stage per run, so the right side is
    small next to the tasks and AQE can broadcast it."""
    keys = [*run, "stageId"]
    return df.join(stages.select(*keys), keys, "left_semi")


def diagnose_skew(tasks: DataFrame, run: list[str]) -> dict[str, DataFrame]:
    """The most skewed stage per run with its metric summaries and heaviest tasks."""
    stage = taskstats.skewed_stage(tasks, run)
    chosen = _of_stage(tasks, stage, run)
    return {
        "stage": stage,
        "summaries": taskstats.metric_summary(chosen, run).where("max > 0"),
        "outliers": taskstats.heaviest_tasks(chosen, [*run, "stageId"]),
    }


def diagnose_starvation(
    tasks: DataFrame, run: list[str], preferred_task_count: int | None = None
) -> dict[str, DataFrame]:
    """The most starved stage per run with its metric summaries and emptiest tasks."""
    stage = taskstats.starved_stage(tasks, run, preferred_task_count)
    chosen = _of_stage(tasks, stage, run)
    return {
        "stage": stage,
        "summaries": taskstats.metric_summary(chosen, run).where("max > 0"),
        "outliers": taskstats.emptiest_tasks(chosen, [*run, "stageId"]),
    }
