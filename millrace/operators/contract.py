"""Data contract over a stage-metrics table: ten rules in three layers.

The table is reduced once to counts per uniqueness key. Rule counts, duplicate keys
and the sample keys all come from that one shuffle. A table that is about to be written is
judged while it is written, see `write_checked`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from millrace.functions.labels import any_of
from millrace.operators.ranking import top_n
from millrace.operators.stagemetrics import OPTIONAL_METRICS
from millrace.sources.artifacts import Artifact, read_artifact, write_artifact

SCHEMA = "SCHEMA"
SEMANTIC = "SEMANTIC"
CORRELATION = "CORRELATION"
LAYERS = (SCHEMA, SEMANTIC, CORRELATION)
SAMPLE_KEYS = 5
UNIQUENESS = "CORRELATION_UNIQUENESS_KEY"


@dataclass(frozen=True)
class Contract:
    """Rule parameters; the defaults are fixed values."""

    version: str = "1.0.0"
    required_columns: tuple[str, ...] = (
        "run_id",
        "app_name",
        "lab_id",
        "workload_name",
        "workload_variant",
        "collector_name",
        "metric_scope",
        "contract_version",
        "created_at",
        "num_stages",
        "num_tasks",
        "executor_run_time_ms",
    )
    optional_metrics: tuple[str, ...] = OPTIONAL_METRICS
    require_columns: bool = True
    num_stages_gt_zero: bool = True
    num_tasks_gt_zero: bool = True
    created_at_not_null: bool = True
    non_negative_metrics: tuple[str, ...] = (
        "executor_run_time_ms",
        "shuffle_bytes_written",
        "shuffle_bytes_read",
        "jvm_gc_time_ms",
        "memory_bytes_spilled",
        "disk_bytes_spilled",
        "input_bytes",
    )
    identity_columns: tuple[str, ...] = (
        "run_id",
        "app_name",
        "lab_id",
        "workload_name",
        "workload_variant",
        "collector_name",
        "metric_scope",
        "created_at",
    )
    expected_values: dict[str, str] = field(
        default_factory=lambda: {
            "collector_name": "sparkmeasure_stage_metrics",
            "metric_scope": "stage",
        }
    )
    uniqueness_key: tuple[str, ...] = ("run_id", "workload_name", "workload_variant", "metric_scope")
    severity: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Rule:
    rule_id: str
    layer: str
    severity_key: str
    name: str
    recommendation: str


# The rules in report order.
RULES = (
    Rule(
        "SCHEMA_REQUIRED_COLUMNS",
        SCHEMA,
        "missing_required_column",
        "required columns must exist",
        "Keep the StageMetrics data product schema stable for downstream automation.",
    ),
    Rule(
        "SCHEMA_OPTIONAL_METRIC_AVAILABILITY_COLUMNS",
        SCHEMA,
        "missing_metric_availability_column",
        "optional metrics must expose value and availability columns",
        "Preserve the difference between an emitted zero and a metric that was not emitted by the collector.",
    ),
    Rule(
        "SEMANTIC_REFERENCED_COLUMNS_EXIST",
        SEMANTIC,
        "semantic_referenced_column_missing",
        "columns referenced by semantic rules must exist",
        "If a metric is evaluated by a semantic rule, model it explicitly instead of allowing it to disappear silently.",
    ),
    Rule(
        "SEMANTIC_NUM_STAGES_GT_ZERO",
        SEMANTIC,
        "zero_stage_or_task",
        "num_stages must be greater than zero",
        "Check whether the StageMetrics collector captured a real Spark action.",
    ),
    Rule(
        "SEMANTIC_NUM_TASKS_GT_ZERO",
        SEMANTIC,
        "zero_stage_or_task",
        "num_tasks must be greater than zero",
        "Check whether the workload created executable Spark tasks.",
    ),
    Rule(
        "SEMANTIC_NON_NEGATIVE_METRICS",
        SEMANTIC,
        "non_negative_metric_violation",
        "numeric metrics must be non-negative",
        "Reject negative counters before they feed budgets, dashboards, or drift analysis.",
    ),
    Rule(
        "SEMANTIC_CREATED_AT_NOT_NULL",
        SEMANTIC,
        "null_created_at",
        "created_at must be present",
        "Timestamp every metrics row so it can support audit and historical analysis.",
    ),
    Rule(
        "CORRELATION_IDENTITY_NOT_NULL",
        CORRELATION,
        "null_identity_column",
        "identity columns must not be null",
        "Preserve correlation keys so metrics can be joined, grouped, and audited.",
    ),
    Rule(
        "CORRELATION_EXPECTED_VALUES",
        CORRELATION,
        "invalid_expected_value",
        "collector identity fields must match expected values",
        "Do not mix stage metrics with task metrics or unknown collectors in the same contract.",
    ),
    Rule(
        "CORRELATION_UNIQUENESS_KEY",
        CORRELATION,
        "duplicate_uniqueness_key",
        "metrics identity key must be unique",
        "Use unique run identity so automation does not double-count the same workload evidence.",
    ),
)


@dataclass(frozen=True)
class _Finding:
    """What a rule found without reading rows, and the condition for bad rows."""

    missing: tuple[str, ...] = ()
    counted: int = 0
    bad_row: Column | None = None
    as_list: bool = False

    @property
    def note(self) -> str:
        """Schema rules list the names; value rules say which column they missed."""
        if self.as_list:
            return ",".join(self.missing)
        return ",".join(f"missing_column={name}" for name in self.missing)


def _absent(df: DataFrame, names) -> tuple[str, ...]:
    return tuple(name for name in names if name not in df.columns)


def _over(df: DataFrame, names, bad) -> _Finding:
    """Missing names count one each; a row is bad when any present column is."""
    missing = _absent(df, names)
    present = [name for name in names if name in df.columns]
    condition = any_of([bad(name) for name in present]) if present else None
    return _Finding(missing, len(missing), condition)


def _not_positive(name: str) -> Column:
    return F.col(name).isNull() | (F.col(name) <= 0)


def _findings(df: DataFrame, contract: Contract) -> dict[str, _Finding]:
    required = _absent(df, contract.required_columns)
    paired = _absent(
        df, [name for m in contract.optional_metrics for name in (m, f"{m}_available")]
    )
    referenced = set(contract.non_negative_metrics)
    referenced |= {"num_stages"} if contract.num_stages_gt_zero else set()
    referenced |= {"num_tasks"} if contract.num_tasks_gt_zero else set()
    referenced |= {"created_at"} if contract.created_at_not_null else set()
    unreferenced = _absent(df, sorted(referenced))
    unkeyed = _absent(df, contract.uniqueness_key)
    return {
        "SCHEMA_REQUIRED_COLUMNS": _Finding(
            required, len(required) if contract.require_columns else 0, as_list=True
        ),
        "SCHEMA_OPTIONAL_METRIC_AVAILABILITY_COLUMNS": _Finding(paired, len(paired), as_list=True),
        "SEMANTIC_REFERENCED_COLUMNS_EXIST": _Finding(
            unreferenced, len(unreferenced), as_list=True
        ),
        "SEMANTIC_NUM_STAGES_GT_ZERO": _over(df, ["num_stages"], _not_positive),
        "SEMANTIC_NUM_TASKS_GT_ZERO": _over(df, ["num_tasks"], _not_positive),
        "SEMANTIC_NON_NEGATIVE_METRICS": _over(
            df, contract.non_negative_metrics, lambda n: F.col(n).isNull() | (F.col(n) < 0)
        ),
        "SEMANTIC_CREATED_AT_NOT_NULL": _over(
            df, ["created_at"], lambda n: F.col(n).isNull()
        )
        if contract.created_at_not_null
        else _Finding(),
        "CORRELATION_IDENTITY_NOT_NULL": _over(
            df, contract.identity_columns, lambda n: F.col(n).isNull()
        ),
        "CORRELATION_EXPECTED_VALUES": _over(
            df,
            list(contract.expected_values),
            lambda n: F.col(n).isNull() | (F.col(n) != F.lit(contract.expected_values[n])),
        ),
        UNIQUENESS: _Finding(unkeyed, len(unkeyed)),
    }


def _per_key(df: DataFrame, key: list[str], bad_rows: dict[str, Column]) -> DataFrame:
    """Rows and bad rows per uniqueness key: the only pass over the table. The row count
    stands last, where both readers keep it, so that they share one shuffle."""
    return df.groupBy(*key).agg(
        *[F.count_if(condition).alias(name) for name, condition in bad_rows.items()],
        F.count(F.lit(1)).alias("_rows"),
    )


def _counts(per_key: DataFrame, bad_rows: dict[str, Column]) -> DataFrame:
    """One row: bad rows per rule and the number of duplicate keys."""
    zero = F.lit(0).cast("long")
    return per_key.agg(
        F.count_if(F.col("_rows") > 1).alias(UNIQUENESS),
        *[F.coalesce(F.sum(name), zero).alias(name) for name in bad_rows],
    )


def _samples(
    per_key: DataFrame, key: list[str], bad_rows: dict[str, Column], unique_checked: bool
) -> DataFrame:
    """First failing keys per rule. Each task cuts its keys to five per rule before
    they are shuffled."""
    failing = {name: F.col(name) > 0 for name in bad_rows}
    if unique_checked:
        failing[UNIQUENESS] = F.col("_rows") > 1
    broken = F.array_compact(
        F.array(*[F.when(condition, F.lit(name)) for name, condition in failing.items()])
    )
    text = F.to_json(F.struct(*sorted(key)), {"ignoreNullFields": "false"})
    keys = per_key.where(any_of(list(failing.values()))).select(
        text.alias("key"), F.explode(broken).alias("rule_id")
    )
    kept = top_n(keys, ["rule_id"], [F.asc("key")], SAMPLE_KEYS)
    return kept.groupBy("rule_id").agg(
        F.concat_ws(";", F.sort_array(F.collect_list("key"))).alias("sample")
    )


def _statements(contract: Contract, findings: dict[str, _Finding], counted: set[str]) -> Column:
    """The rule rows over the one row of counts."""
    return F.array(
        *[
            F.struct(
                F.lit(rule.rule_id).alias("rule_id"),
                F.lit(rule.name).alias("rule_name"),
                F.lit(rule.layer).alias("rule_type"),
                F.lit(contract.severity.get(rule.severity_key, "ERROR")).alias("severity"),
                (
                    F.lit(findings[rule.rule_id].counted).cast("long")
                    + (F.col(rule.rule_id) if rule.rule_id in counted else F.lit(0))
                ).alias("failed_count"),
                F.lit(findings[rule.rule_id].note).alias("note"),
                F.lit(rule.recommendation).alias("recommendation"),
            )
            for rule in RULES
        ]
    )


def contract_results(
    df: DataFrame,
    contract: Contract = Contract(),
    validation_run_id: str = "",
    source_path: str = "",
    created_at: str | None = None,
) -> DataFrame:
    """One row per rule. A rule fails when its count is above zero, whatever its
    severity. Samples are the first five failing keys in key order."""
    findings = _findings(df, contract)
    bad_rows = _bad_rows(findings)
    per_key = _per_key(df, _present_key(df, contract), bad_rows)
    counts = _counts(per_key, bad_rows)
    return _rule_rows(
        contract, findings, per_key, counts, bad_rows, (validation_run_id, source_path, created_at)
    )


def write_checked(
    df: DataFrame,
    target: Artifact,
    contract: Contract = Contract(),
    validation_run_id: str = "",
    source_path: str | None = None,
    created_at: str | None = None,
) -> DataFrame:
    """Writes df and returns the rows of `contract_results` for it; `df` is worked out once.

    Which rules fail is seen by an observation of the rows on their way to the files, in the
    tasks that write them. Whether keys repeat is read from the key columns of the written
    table, and its other columns only for the rules that failed. Their counts and sample keys
    come from the same shuffle as the repeated keys. A table without rows passes the value rules.

    The target holds this table alone: appending is refused, as the rules would be judged over
    rows that were not observed.
    """
    if target.mode == "append":
        raise ValueError("a checked table is written alone; append it after it passed")
    findings = _findings(df, contract)
    bad_rows = _bad_rows(findings)
    seen = Observation()
    rows = F.count(F.lit(1)).alias("_rows")
    marks = [F.count_if(condition).alias(name) for name, condition in bad_rows.items()]
    write_artifact(df.observe(seen, rows, *marks), target)
    counted = seen.get
    failed = {name: bad for name, bad in bad_rows.items() if counted[name]}
    stored = read_artifact(df.sparkSession, target, df.schema)
    per_key = _per_key(stored, _present_key(df, contract), failed)
    passed = [F.lit(0).cast("long").alias(name) for name in bad_rows if name not in failed]
    counts = _counts(per_key, failed).select("*", *passed)
    source = target.path if source_path is None else source_path
    return _rule_rows(
        contract, findings, per_key, counts, failed, (validation_run_id, source, created_at)
    )


def _bad_rows(findings: dict[str, _Finding]) -> dict[str, Column]:
    return {name: f.bad_row for name, f in findings.items() if f.bad_row is not None}


def _present_key(df: DataFrame, contract: Contract) -> list[str]:
    return [name for name in contract.uniqueness_key if name in df.columns]


def _rule_rows(
    contract: Contract,
    findings: dict[str, _Finding],
    per_key: DataFrame,
    counts: DataFrame,
    sampled: dict[str, Column],
    identity: tuple[str, str, str | None],
) -> DataFrame:
    """The rule rows from the one row of counts, with sample keys of the rules in `sampled`."""
    validation_run_id, source_path, created_at = identity
    key = [name for name in contract.uniqueness_key if name in per_key.columns]
    unique_checked = not findings[UNIQUENESS].missing
    counted = set(_bad_rows(findings)) | ({UNIQUENESS} if unique_checked else set())
    results = counts.select(F.inline(_statements(contract, findings, counted)))
    if key and (sampled or unique_checked):
        samples = _samples(per_key, key, sampled, unique_checked)
        results = results.join(samples, on="rule_id", how="left")
    else:
        results = results.withColumn("sample", F.lit(None).cast("string"))
    sample = F.when(F.col("note") == "", F.coalesce("sample", F.lit(""))).otherwise(
        F.concat_ws(";", "note", "sample")
    )
    stamp = F.lit(created_at) if created_at else F.current_timestamp().cast("string")
    return results.select(
        F.lit(validation_run_id).alias("validation_run_id"),
        F.lit(source_path).alias("source_path"),
        F.lit(contract.version).alias("contract_version"),
        "rule_id",
        "rule_name",
        "rule_type",
        "severity",
        F.when(F.col("failed_count") > 0, F.lit("FAIL")).otherwise(F.lit("PASS")).alias("decision"),
        "failed_count",
        sample.alias("sample_failed_keys"),
        "recommendation",
        stamp.alias("created_at"),
    )


def layer_decisions(results: DataFrame) -> DataFrame:
    """PASS or FAIL per layer; a layer without rules passes."""
    layers = F.array(*[F.lit(layer) for layer in LAYERS])
    failing = results.agg(
        F.collect_set(F.when(F.col("decision") == "FAIL", F.col("rule_type"))).alias("failed")
    )
    return failing.select(F.explode(layers).alias("rule_type"), "failed").select(
        "rule_type",
        F.when(F.array_contains("failed", F.col("rule_type")), F.lit("FAIL"))
        .otherwise(F.lit("PASS"))
        .alias("decision"),
    )


def contract_summary(results: DataFrame) -> DataFrame:
    failed = F.count_if(F.col("decision") == "FAIL")
    total = F.count(F.lit(1))
    return results.groupBy("validation_run_id", "source_path", "contract_version").agg(
        total.alias("total_rules"),
        (total - failed).alias("passed_rules"),
        failed.alias("failed_rules"),
        F.when(failed > 0, F.lit("FAIL")).otherwise(F.lit("PASS")).alias("decision"),
        F.max("created_at").alias("created_at"),
    )


# The broken copies made of a clean metrics row.
BREAKAGES = (
    "clean",
    "null-run-id",
    "zero-stages",
    "zero-tasks",
    "negative-shuffle",
    "null-created-at",
    "invalid-scope",
    "duplicate",
)


def with_broken_copies(metrics: DataFrame) -> DataFrame:
    """Each row eight times: clean, six ways broken, and once more as a duplicate."""
    copies = metrics.withColumn(
        "_copy", F.explode(F.array(*[F.lit(label) for label in BREAKAGES]))
    )
    breaks = {
        "run_id": ("null-run-id", F.lit(None).cast("string")),
        "num_stages": ("zero-stages", F.lit(0)),
        "num_tasks": ("zero-tasks", F.lit(0)),
        "shuffle_bytes_written": ("negative-shuffle", F.lit(-1)),
        "created_at": ("null-created-at", F.lit(None)),
        "metric_scope": ("invalid-scope", F.lit("task")),
    }
    untouched = F.col("_copy").isin("clean", "duplicate")
    renamed = copies.withColumn(
        "run_id",
        F.when(untouched, F.col("run_id")).otherwise(F.concat_ws("-", F.col("run_id"), F.col("_copy"))),
    )
    broken = {
        name: F.when(F.col("_copy") == label, value).otherwise(F.col(name))
        for name, (label, value) in breaks.items()
    }
    return renamed.withColumns(broken).drop("_copy")
