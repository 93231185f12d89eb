"""Source, key and contract checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import aggregates, contract, profile, star
from millrace.operators.stagemetrics import contract_ready
from millrace.queries.sql import STAR, bigint
from millrace.sources.files import table_file_stats
from millrace.sources.tables import (
    ALL_TABLES,
    RUN_IDENTITY,
    line_tables,
    read_table,
    retail_tables,
    run_counters,
)

CREATED_AT = "2026-01-01 00:00:00"


def source_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.source_profile({name: read_table(spark, folder, name) for name in ALL_TABLES})


def file_stats(spark: SparkSession, folder: str) -> DataFrame:
    return table_file_stats(spark, {name: f"{folder}/{name}.parquet" for name in ALL_TABLES})


def fk_violations(spark: SparkSession, folder: str) -> DataFrame:
    return star.fk_violations(retail_tables(spark, folder))


def _in_credit(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The star with only the suppliers in credit, large parts and building customers."""
    tables = retail_tables(spark, folder)
    kept = {
        "vendors": read_table(spark, folder, "supplier").where("s_acctbal > 0").select(
            F.col("s_suppkey").alias("vendor_id")
        ),
        "products": read_table(spark, folder, "part").where("p_size > 10").select(
            F.col("p_partkey").alias("product_id")
        ),
        "customers": read_table(spark, folder, "customer").where(
            "c_mktsegment <> 'BUILDING'"
        ).select(F.col("c_custkey").alias("customer_id")),
    }
    return {"sales": tables["sales"], **kept}


def fk_violations_narrowed(spark: SparkSession, folder: str) -> DataFrame:
    return star.fk_violations(_in_credit(spark, folder))


def inventory_gate(spark: SparkSession, folder: str) -> DataFrame:
    tables = _in_credit(spark, folder)
    return profile.inventory_gate(profile.source_profile(tables), star.fk_violations(tables))


def key_imbalance(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.top_key(line_tables(spark, folder)["sales"], "vendor_id")


def hot_key_share(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.key_rows_share(line_tables(spark, folder)["sales"], "vendor_id", 1)


def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem")
    return aggregates.duplicate_groups(lines, ["l_orderkey", "l_linenumber"])


def _contract_rows(counters: DataFrame) -> DataFrame:
    metrics = contract_ready(counters, RUN_IDENTITY)
    return metrics.withColumns(
        {
            "lab_id": F.lit("area-1"),
            "collector_name": F.lit("sparkmeasure_stage_metrics"),
            "metric_scope": F.lit("stage"),
            "contract_version": F.lit("1.0.0"),
        }
    )


def contract_ready_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _contract_rows(run_counters(spark, folder))


def _results(metrics: DataFrame) -> DataFrame:
    return contract.contract_results(
        metrics, validation_run_id="check", source_path="runs", created_at=CREATED_AT
    )


def contract_results(spark: SparkSession, folder: str) -> DataFrame:
    return _results(contract.with_broken_copies(_contract_rows(run_counters(spark, folder))))


def contract_results_clean(spark: SparkSession, folder: str) -> DataFrame:
    return _results(_contract_rows(run_counters(spark, folder)))


def contract_results_observed(spark: SparkSession, folder: str) -> DataFrame:
    """Bad runs as they come from the collector: no stage, no count of tasks, no run time."""
    small = F.col("numTasks")
    counters = run_counters(spark, folder).withColumns(
        {
            "numStages": F.when(small != 7, F.col("numStages")).otherwise(0),
            "numTasks": F.when(small != 9, F.col("numTasks")),
            "executorRunTime": F.when(small != 11, F.col("executorRunTime")),
        }
    )
    return _results(_contract_rows(counters))


def contract_results_narrow(spark: SparkSession, folder: str) -> DataFrame:
    """The same rules over a table that lost some of its columns."""
    metrics = contract.with_broken_copies(_contract_rows(run_counters(spark, folder)))
    return _results(metrics.drop("num_tasks", "input_bytes", "lab_id", "workload_variant"))


def contract_layers(spark: SparkSession, folder: str) -> DataFrame:
    return contract.layer_decisions(contract_results(spark, folder))


def contract_summary(spark: SparkSession, folder: str) -> DataFrame:
    return contract.contract_summary(contract_results(spark, folder))


QUERIES = {
    query.__name__: query
    for query in (
        source_profile,
        file_stats,
        fk_violations,
        fk_violations_narrowed,
        inventory_gate,
        key_imbalance,
        hot_key_share,
        duplicate_keys,
        contract_ready_metrics,
        contract_results_observed,
        contract_results,
        contract_results_clean,
        contract_results_narrow,
        contract_layers,
        contract_summary,
    )
}


def _profile_sql() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS rows, "
        f"(SELECT CAST(count(*) AS INTEGER) FROM (DESCRIBE {name})) AS columns FROM {name}"
        for name in ALL_TABLES
    )


_FK = f"""WITH {STAR}
SELECT 'vendor' AS relationship,
       count(*) FILTER (WHERE vendor_id IS NULL OR vendor_id NOT IN (SELECT s_suppkey FROM supplier)) AS violations
FROM sales
UNION ALL SELECT 'product',
       count(*) FILTER (WHERE product_id IS NULL OR product_id NOT IN (SELECT p_partkey FROM part))
FROM sales
UNION ALL SELECT 'customer',
       count(*) FILTER (WHERE customer_id IS NULL OR customer_id NOT IN (SELECT c_custkey FROM customer))
FROM sales"""

_FK_NARROWED = (
    _FK.replace("FROM supplier)", "FROM supplier WHERE s_acctbal > 0)")
    .replace("FROM part)", "FROM part WHERE p_size > 10)")
    .replace("FROM customer)", "FROM customer WHERE c_mktsegment <> 'BUILDING')")
)

RUNS = f"""lines AS (
    SELECT strftime(l_shipdate, '%Y-%m') AS month, *,
           CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
           CAST(l_quantity AS BIGINT) AS qty FROM lineitem),
runs AS (
    SELECT concat_ws('-', month, l_suppkey, l_linestatus) AS run_id,
           'supplier-lines' AS app_name, 'supplier-' || l_suppkey AS workload_name,
           CASE WHEN l_linestatus = 'F' THEN 'approved_baseline' ELSE 'candidate' END AS workload_variant,
           count(DISTINCT l_returnflag) AS stages, count(*) AS tasks,
           {bigint('sum(qty)')} * 20 AS run_ms,
           {bigint('sum(cents) FILTER (WHERE l_tax > 0.02)')} AS input,
           {bigint('sum(qty)')} AS records_read, count(*) AS records_written,
           {bigint("sum(cents) FILTER (WHERE l_returnflag = 'R')")} AS sh_read,
           {bigint("sum(cents) FILTER (WHERE l_returnflag = 'A')")} AS sh_written,
           {bigint('sum(cents) FILTER (WHERE l_discount >= 0.095 AND l_linenumber > 3)')} AS mem,
           {bigint('sum(cents) FILTER (WHERE l_discount >= 0.095 AND l_linenumber <= 3)')} AS disk,
           {bigint('sum(l_linenumber)')} * 5 AS gc_ms,
           strftime(max(l_shipdate), '%Y-%m-%d') AS created_at
    FROM lines GROUP BY month, l_suppkey, l_linestatus)"""

_READY = """SELECT run_id, app_name, workload_name, workload_variant, created_at,
       coalesce(sh_written, 0) AS shuffle_bytes_written, coalesce(sh_read, 0) AS shuffle_bytes_read,
       gc_ms AS jvm_gc_time_ms, coalesce(mem, 0) AS memory_bytes_spilled,
       coalesce(disk, 0) AS disk_bytes_spilled, coalesce(input, 0) AS input_bytes,
       run_ms AS executor_run_time_ms, stages AS num_stages, tasks AS num_tasks,
       sh_written IS NOT NULL AS shuffle_bytes_written_available,
       sh_read IS NOT NULL AS shuffle_bytes_read_available,
       gc_ms IS NOT NULL AS jvm_gc_time_ms_available,
       mem IS NOT NULL AS memory_bytes_spilled_available,
       disk IS NOT NULL AS disk_bytes_spilled_available, input IS NOT NULL AS input_bytes_available,
       'area-1' AS lab_id, 'sparkmeasure_stage_metrics' AS collector_name, 'stage' AS metric_scope,
       '1.0.0' AS contract_version
FROM runs"""

_BROKEN = """ready AS ({ready}),
broken AS (
    SELECT CASE copy WHEN 'clean' THEN run_id WHEN 'duplicate' THEN run_id
                WHEN 'null-run-id' THEN NULL ELSE run_id || '-' || copy END AS run_id,
           workload_name, workload_variant,
           CASE WHEN copy = 'invalid-scope' THEN 'task' ELSE metric_scope END AS metric_scope,
           CASE WHEN copy = 'zero-stages' THEN 0 ELSE num_stages END AS num_stages,
           CASE WHEN copy = 'zero-tasks' THEN 0 ELSE num_tasks END AS num_tasks,
           CASE WHEN copy = 'negative-shuffle' THEN -1 ELSE shuffle_bytes_written END AS sh_written,
           CASE WHEN copy <> 'null-created-at' THEN created_at END AS created_at,
           executor_run_time_ms, shuffle_bytes_read, jvm_gc_time_ms, memory_bytes_spilled,
           disk_bytes_spilled, input_bytes, app_name, lab_id, collector_name
    FROM ready CROSS JOIN (SELECT unnest([{copies}]) AS copy))"""

_FULL_KEY = (
    "json_object('metric_scope', metric_scope, 'run_id', run_id, "
    "'workload_name', workload_name, 'workload_variant', workload_variant)"
)
_NARROW_KEY = "json_object('metric_scope', metric_scope, 'run_id', run_id, 'workload_name', workload_name)"

# rule id, condition of a bad row (or NULL), counted columns, note, layer, name, recommendation
_VALUE_RULES = {
    "SEMANTIC_NUM_STAGES_GT_ZERO": "num_stages IS NULL OR num_stages <= 0",
    "SEMANTIC_NUM_TASKS_GT_ZERO": "num_tasks IS NULL OR num_tasks <= 0",
    "SEMANTIC_NON_NEGATIVE_METRICS": " OR ".join(
        f"{name} IS NULL OR {name} < 0"
        for name in (
            "executor_run_time_ms",
            "sh_written",
            "shuffle_bytes_read",
            "jvm_gc_time_ms",
            "memory_bytes_spilled",
            "disk_bytes_spilled",
            "input_bytes",
        )
    ),
    "SEMANTIC_CREATED_AT_NOT_NULL": "created_at IS NULL",
    "CORRELATION_IDENTITY_NOT_NULL": " OR ".join(
        f"{name} IS NULL"
        for name in (
            "run_id",
            "app_name",
            "lab_id",
            "workload_name",
            "workload_variant",
            "collector_name",
            "metric_scope",
            "created_at",
        )
    ),
    "CORRELATION_EXPECTED_VALUES": "collector_name IS DISTINCT FROM 'sparkmeasure_stage_metrics' "
    "OR metric_scope IS DISTINCT FROM 'stage'",
}


def _rule_table(notes: dict[str, str], counted: dict[str, int]) -> str:
    return ", ".join(
        f"('{rule.rule_id}', '{rule.layer}', '{rule.name}', '{rule.recommendation}', "
        f"'{notes.get(rule.rule_id, '')}', {counted.get(rule.rule_id, 0)})"
        for rule in contract.RULES
    )


def _contract_sql(
    source: str,
    key: str,
    group: str | None,
    skipped: tuple[str, ...] = (),
    notes: dict[str, str] | None = None,
    counted: dict[str, int] | None = None,
    dropped: tuple[str, ...] = (),
) -> str:
    conditions = {}
    for rule, condition in _VALUE_RULES.items():
        if rule in skipped:
            continue
        parts = [p for p in condition.split(" OR ") if not any(p.startswith(d) for d in dropped)]
        conditions[rule] = " OR ".join(parts)
    bad = "\nUNION ALL ".join(
        f"SELECT '{rule}' AS rule_id, {key} AS key FROM broken WHERE {condition}"
        for rule, condition in conditions.items()
    )
    if group:
        bad += (
            f"\nUNION ALL SELECT 'CORRELATION_UNIQUENESS_KEY', {key} FROM broken "
            f"GROUP BY {group} HAVING count(*) > 1"
        )
    return f"""{source},
bad AS ({bad}),
per_key AS (SELECT rule_id, CAST(key AS VARCHAR) AS key, count(*) AS n FROM bad GROUP BY ALL),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY key) AS place FROM per_key),
evidence AS (
    SELECT rule_id, sum(n) AS n,
           string_agg(key, ';' ORDER BY key) FILTER (WHERE place <= 5) AS sample
    FROM numbered GROUP BY 1),
rules(rule_id, rule_type, rule_name, recommendation, note, counted) AS (
    VALUES {_rule_table(notes or {}, counted or {})}),
results AS (
    SELECT 'check' AS validation_run_id, 'runs' AS source_path, '1.0.0' AS contract_version,
           rule_id, rule_name, rule_type, 'ERROR' AS severity,
           CASE WHEN counted + coalesce(n, 0) > 0 THEN 'FAIL' ELSE 'PASS' END AS decision,
           CAST(counted + coalesce(n, 0) AS BIGINT) AS failed_count,
           CASE WHEN note = '' THEN coalesce(sample, '') ELSE concat_ws(';', note, sample) END
             AS sample_failed_keys,
           recommendation, '{CREATED_AT}' AS created_at
    FROM rules LEFT JOIN evidence USING (rule_id))"""


_COPIES = ", ".join(f"'{label}'" for label in contract.BREAKAGES)
_GROUP = "run_id, workload_name, workload_variant, metric_scope"
_BROKEN_SOURCE = f"WITH {RUNS}, " + _BROKEN.format(ready=_READY, copies=_COPIES)
_RESULTS = _contract_sql(_BROKEN_SOURCE, _FULL_KEY, _GROUP)
_CLEAN = _contract_sql(
    f"WITH {RUNS}, " + _BROKEN.format(ready=_READY, copies="'clean'"), _FULL_KEY, _GROUP
)
_OBSERVED = _contract_sql(
    f"""WITH {RUNS}, ready AS ({_READY}),
broken AS (
    SELECT *, shuffle_bytes_written AS sh_written FROM (SELECT * REPLACE (
        CASE WHEN num_tasks <> 7 THEN num_stages ELSE 0 END AS num_stages,
        CASE WHEN num_tasks <> 9 THEN num_tasks END AS num_tasks,
        CASE WHEN num_tasks <> 11 THEN executor_run_time_ms END AS executor_run_time_ms) FROM ready))""",
    _FULL_KEY,
    _GROUP,
)
_NARROW = _contract_sql(
    _BROKEN_SOURCE,
    _NARROW_KEY,
    None,
    skipped=("SEMANTIC_NUM_TASKS_GT_ZERO",),
    notes={
        "SCHEMA_REQUIRED_COLUMNS": "lab_id,workload_variant,num_tasks",
        "SCHEMA_OPTIONAL_METRIC_AVAILABILITY_COLUMNS": "input_bytes",
        "SEMANTIC_REFERENCED_COLUMNS_EXIST": "input_bytes,num_tasks",
        "SEMANTIC_NUM_TASKS_GT_ZERO": "missing_column=num_tasks",
        "SEMANTIC_NON_NEGATIVE_METRICS": "missing_column=input_bytes",
        "CORRELATION_IDENTITY_NOT_NULL": "missing_column=lab_id,missing_column=workload_variant",
        "CORRELATION_UNIQUENESS_KEY": "missing_column=workload_variant",
    },
    counted={
        "SCHEMA_REQUIRED_COLUMNS": 3,
        "SCHEMA_OPTIONAL_METRIC_AVAILABILITY_COLUMNS": 1,
        "SEMANTIC_REFERENCED_COLUMNS_EXIST": 2,
        "SEMANTIC_NUM_TASKS_GT_ZERO": 1,
        "SEMANTIC_NON_NEGATIVE_METRICS": 1,
        "CORRELATION_IDENTITY_NOT_NULL": 2,
        "CORRELATION_UNIQUENESS_KEY": 1,
    },
    dropped=("num_tasks", "input_bytes", "lab_id", "workload_variant"),
)

SQL = {
    "source_profile": _profile_sql(),
    "fk_violations": _FK,
    "fk_violations_narrowed": _FK_NARROWED,
    "inventory_gate": f"""WITH violations AS ({_FK_NARROWED}),
sizes AS (
    SELECT 'vendors' AS t, count(*) AS n FROM supplier WHERE s_acctbal > 0
    UNION ALL SELECT 'products', count(*) FROM part WHERE p_size > 10
    UNION ALL SELECT 'customers', count(*) FROM customer WHERE c_mktsegment <> 'BUILDING'
    UNION ALL SELECT 'sales', count(*) FROM lineitem),
found AS (
    SELECT coalesce((SELECT string_agg(t, ',' ORDER BY t) FROM sizes WHERE n = 0), '') AS empty_tables,
           coalesce((SELECT string_agg(relationship, ',' ORDER BY relationship) FROM violations
                     WHERE violations <> 0), '') AS broken_relationships)
SELECT *, empty_tables = '' AND broken_relationships = '' AS passed FROM found""",
    "key_imbalance": """SELECT l_suppkey AS top_vendor_id, count(*) AS top_rows,
       count(*) / CAST((SELECT count(*) FROM lineitem) AS DOUBLE) AS top_share
FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
    "hot_key_share": """SELECT CAST(1 AS BIGINT) AS vendor_id,
       count(*) FILTER (WHERE l_suppkey = 1) AS hot_rows, count(*) AS total_rows,
       count(*) FILTER (WHERE l_suppkey = 1) / CAST(count(*) AS DOUBLE) AS hot_share FROM lineitem""",
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS row_count
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "contract_ready_metrics": f"WITH {RUNS} {_READY}",
    "contract_results_observed": f"{_OBSERVED} SELECT * FROM results",
    "contract_results": f"{_RESULTS} SELECT * FROM results",
    "contract_results_clean": f"{_CLEAN} SELECT * FROM results",
    "contract_results_narrow": f"{_NARROW} SELECT * FROM results",
    "contract_layers": f"""{_RESULTS}
SELECT rule_type, CASE WHEN bool_or(decision = 'FAIL') THEN 'FAIL' ELSE 'PASS' END AS decision
FROM results GROUP BY 1""",
    "contract_summary": f"""{_RESULTS}
SELECT validation_run_id, source_path, contract_version, count(*) AS total_rules,
       count(*) FILTER (WHERE decision = 'PASS') AS passed_rules,
       count(*) FILTER (WHERE decision = 'FAIL') AS failed_rules,
       CASE WHEN bool_or(decision = 'FAIL') THEN 'FAIL' ELSE 'PASS' END AS decision,
       max(created_at) AS created_at
FROM results GROUP BY 1, 2, 3""",
}
