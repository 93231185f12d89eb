"""Runtime budget: a candidate run against the approved run of the same workload."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.labels import joined_names
from millrace.functions.money import from_cents, to_cents
from millrace.functions.ratios import pct_growth

# Metrics of one run as stored in a decision.
BUDGET_METRICS = (
    "disk_bytes_spilled",
    "executor_run_time_ms",
    "input_bytes",
    "jvm_gc_time_ms",
    "memory_bytes_spilled",
    "num_stages",
    "num_tasks",
    "records_read",
    "records_written",
    "shuffle_bytes_read",
    "shuffle_bytes_written",
)
MEMORY_PRESSURE = "MEMORY_PRESSURE"
SHUFFLE_HEAVY = "SHUFFLE_HEAVY"
BALANCED = "BALANCED_OR_LOW_SIGNAL"
SHUFFLE_HEAVY_BYTES = 1048576


@dataclass(frozen=True)
class Thresholds:
    """Allowed growth in percent and allowed spill; the defaults are fixed values."""

    max_executor_runtime_growth_pct: float = 20.0
    max_shuffle_written_growth_pct: float = 25.0
    max_shuffle_read_growth_pct: float = 25.0
    max_num_tasks_growth_pct: float = 35.0
    max_num_stages_growth_pct: float = 25.0
    fail_on_memory_spill_bytes_above: int = 0
    fail_on_disk_spill_bytes_above: int = 0


def default_profiles() -> dict[str, dict[str, float]]:
    """What a profile changes in the default thresholds."""
    return {
        SHUFFLE_HEAVY: {
            "max_shuffle_written_growth_pct": 15.0,
            "max_shuffle_read_growth_pct": 15.0,
            "max_executor_runtime_growth_pct": 25.0,
            "max_num_tasks_growth_pct": 25.0,
        },
        MEMORY_PRESSURE: {
            "fail_on_memory_spill_bytes_above": 0,
            "fail_on_disk_spill_bytes_above": 0,
            "max_executor_runtime_growth_pct": 15.0,
        },
        BALANCED: {
            "max_executor_runtime_growth_pct": 30.0,
            "max_shuffle_written_growth_pct": 40.0,
            "max_num_tasks_growth_pct": 50.0,
        },
    }


@dataclass(frozen=True)
class BudgetRules:
    default: Thresholds = Thresholds()
    profiles: dict[str, dict[str, float]] = field(default_factory=default_profiles)
    min_executor_runtime_ms: int = 1000
    min_shuffle_bytes: int = 1048576

    def thresholds(self, profile: str) -> Thresholds:
        """A profile inherits every threshold it does not set."""
        return replace(self.default, **self.profiles.get(profile, {}))

    def limit(self, name: str) -> Column:
        """The threshold that applies to the row's ``workload_profile``."""
        chosen = F.lit(getattr(self.default, name))
        for profile in self.profiles:
            chosen = F.when(
                F.col("workload_profile") == profile, F.lit(getattr(self.thresholds(profile), name))
            ).otherwise(chosen)
        return chosen


def pair_runs(
    runs: DataFrame,
    baseline_variant: str,
    candidate_variant: str,
    latest_by: str = "created_at",
) -> DataFrame:
    """One row per workload with the latest run (by ``latest_by``) of each variant as
    ``baseline`` and ``candidate`` structs, null where a variant was not measured. One shuffle
    with map-side reduction, no self-join."""
    run = F.struct("run_id", *BUDGET_METRICS)
    order = F.struct(latest_by, "run_id")

    def latest(variant: str) -> Column:
        chosen = F.col("workload_variant") == variant
        return F.max_by(run, F.when(chosen, order))

    return (
        runs.where(F.col("workload_variant").isin(baseline_variant, candidate_variant))
        .groupBy("workload_name")
        .agg(latest(baseline_variant).alias("baseline"), latest(candidate_variant).alias("candidate"))
    )


def _total(side: str, first: str, second: str) -> Column:
    return F.col(f"{side}.{first}") + F.col(f"{side}.{second}")


def _shuffle(side: str) -> Column:
    return _total(side, "shuffle_bytes_read", "shuffle_bytes_written")


def _spill(side: str) -> Column:
    return _total(side, "memory_bytes_spilled", "disk_bytes_spilled")


def budget_profile() -> Column:
    """New spill is memory pressure; else a candidate that shuffles enough is shuffle-heavy."""
    return (
        F.when((_spill("baseline") == 0) & (_spill("candidate") > 0), F.lit(MEMORY_PRESSURE))
        .when(_shuffle("candidate") >= SHUFFLE_HEAVY_BYTES, F.lit(SHUFFLE_HEAVY))
        .otherwise(F.lit(BALANCED))
    )


# Names of the stored growth columns.
GROWTH = {
    "executor_run_time_delta_pct": "executor_run_time_ms",
    "shuffle_written_delta_pct": "shuffle_bytes_written",
    "shuffle_read_delta_pct": "shuffle_bytes_read",
    "num_tasks_delta_pct": "num_tasks",
    "num_stages_delta_pct": "num_stages",
    "gc_time_delta_pct": "jvm_gc_time_ms",
}


def growth(pairs: DataFrame) -> DataFrame:
    """Adds the seven growth percentages, null without both runs."""
    deltas = {
        name: pct_growth(F.col(f"baseline.{metric}"), F.col(f"candidate.{metric}"))
        for name, metric in GROWTH.items()
    }
    deltas["spill_delta_pct"] = pct_growth(_spill("baseline"), _spill("candidate"))
    return pairs.withColumns({name: F.when(_both(), delta) for name, delta in deltas.items()})


def _both() -> Column:
    return F.col("baseline").isNotNull() & F.col("candidate").isNotNull()


def _new_spill(metric: str, limit: Column) -> Column:
    """Above the budget now and not before: old spill is no regression."""
    return (F.col(f"baseline.{metric}") <= limit) & (F.col(f"candidate.{metric}") > limit)


def budget_decisions(pairs: DataFrame, rules: BudgetRules = BudgetRules()) -> DataFrame:
    """Profile, growth, failed rules and decision per pair. Growth must exceed the
    limit to fail, and a pair with too little signal is a warning whatever failed. A
    workload without one of the runs is ``MISSING_BASELINE`` or ``MISSING_CANDIDATE``, with
    no profile, rule or flag."""
    judged = growth(pairs).withColumn("workload_profile", F.when(_both(), budget_profile()))
    low_signal = (
        F.greatest("baseline.executor_run_time_ms", "candidate.executor_run_time_ms")
        < rules.min_executor_runtime_ms
    ) & (F.greatest(_shuffle("baseline"), _shuffle("candidate")) < rules.min_shuffle_bytes)
    failed = joined_names(
        *[
            (rule, F.col(delta) > rules.limit(rule.lower()))
            for rule, delta in (
                ("MAX_EXECUTOR_RUNTIME_GROWTH_PCT", "executor_run_time_delta_pct"),
                ("MAX_SHUFFLE_WRITTEN_GROWTH_PCT", "shuffle_written_delta_pct"),
                ("MAX_SHUFFLE_READ_GROWTH_PCT", "shuffle_read_delta_pct"),
                ("MAX_NUM_TASKS_GROWTH_PCT", "num_tasks_delta_pct"),
                ("MAX_NUM_STAGES_GROWTH_PCT", "num_stages_delta_pct"),
            )
        ],
        (
            "MEMORY_SPILL_BYTES_ABOVE_BUDGET",
            _new_spill("memory_bytes_spilled", rules.limit("fail_on_memory_spill_bytes_above")),
        ),
        (
            "DISK_SPILL_BYTES_ABOVE_BUDGET",
            _new_spill("disk_bytes_spilled", rules.limit("fail_on_disk_spill_bytes_above")),
        ),
    )
    return (
        judged.withColumn("failed_rules", F.when(_both(), failed).otherwise(F.lit("")))
        .withColumn(
            "warning_flags", joined_names(("LOW_SIGNAL_LOCAL_RUN", _both() & low_signal))
        )
        .withColumn(
            "decision",
            F.when(F.col("baseline").isNull(), F.lit("MISSING_BASELINE"))
            .when(F.col("candidate").isNull(), F.lit("MISSING_CANDIDATE"))
            .when(F.col("warning_flags") != "", F.lit("WARNING_LOW_SIGNAL"))
            .when(F.col("failed_rules") != "", F.lit("FAIL"))
            .otherwise(F.lit("PASS")),
        )
    )


def metrics_json(side: str) -> Column:
    return F.to_json(F.struct(*[F.col(f"{side}.{name}").alias(name) for name in BUDGET_METRICS]))


def decision_records(decisions: DataFrame, **identity: str) -> DataFrame:
    """The stored decision: outcome, growth and both metric sets as JSON, led by
    identity values such as ``run_id``, ``app_name`` and ``application_id``."""
    return decisions.select(
        *[F.lit(value).alias(name) for name, value in identity.items()],
        F.col("baseline.run_id").alias("baseline_run_id"),
        F.col("candidate.run_id").alias("candidate_run_id"),
        "workload_name",
        "workload_profile",
        "decision",
        "failed_rules",
        "warning_flags",
        *GROWTH,
        "spill_delta_pct",
        metrics_json("baseline").alias("baseline_metrics"),
        metrics_json("candidate").alias("candidate_metrics"),
        F.current_timestamp().cast("string").alias("created_at"),
    )


def output_compatibility(
    baseline: DataFrame, candidate: DataFrame, revenue_tolerance: float = 0.01
) -> DataFrame:
    """One row: do two business outputs agree in schema, rows, revenue and orders, and
    in how many rows they differ as bags; ``identical`` asks for equal rows, ``compatible``
    for equal totals. A column only one side has is not compared, and its totals are 0.
    Both sides go through one union, so there is one shuffle and no join."""
    same_schema = [(f.name, f.dataType) for f in baseline.schema.fields] == [
        (f.name, f.dataType) for f in candidate.schema.fields
    ]
    shared = [name for name in baseline.columns if name in candidate.columns]
    sides = baseline.select(*shared, F.lit(1).alias("side")).unionByName(
        candidate.select(*shared, F.lit(-1).alias("side"))
    )
    per_row = sides.groupBy(*shared).agg(
        F.count_if(F.col("side") == 1).alias("b"), F.count_if(F.col("side") == -1).alias("c")
    )
    none = F.lit(None).cast("long")
    cents = to_cents(F.col("gross_revenue")) if "gross_revenue" in shared else none
    orders = F.col("order_count") if "order_count" in shared else none

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0).cast("long"))

    sums = per_row.agg(
        total(F.col("b")).alias("baseline_row_count"),
        total(F.col("c")).alias("candidate_row_count"),
        total(cents * F.col("b")).alias("b_cents"),
        total(cents * F.col("c")).alias("c_cents"),
        total(orders * F.col("b")).alias("baseline_total_order_count"),
        total(orders * F.col("c")).alias("candidate_total_order_count"),
        total(F.abs(F.col("b") - F.col("c"))).alias("differing_rows"),
    )
    compatible = (
        F.lit(same_schema)
        & (F.col("baseline_row_count") == F.col("candidate_row_count"))
        & (
            F.abs(F.col("b_cents") - F.col("c_cents")).cast("double")
            <= F.lit(revenue_tolerance * 100.0)
        )
        & (F.col("baseline_total_order_count") == F.col("candidate_total_order_count"))
    )
    return sums.select(
        "baseline_row_count",
        "candidate_row_count",
        from_cents(F.col("b_cents")).alias("baseline_total_revenue"),
        from_cents(F.col("c_cents")).alias("candidate_total_revenue"),
        "baseline_total_order_count",
        "candidate_total_order_count",
        "differing_rows",
        F.lit(same_schema).alias("same_schema"),
        compatible.alias("compatible"),
        (F.lit(same_schema) & (F.col("differing_rows") == 0)).alias("identical"),
    )
