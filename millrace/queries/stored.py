"""Queries over tables that the job stores first and reads again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.generate import volume
from millrace.operators import contract, history, ranking
from millrace.plans import retail
from millrace.queries.events import PLAN, _planned
from millrace.queries.metrics import _HISTORY, _LATEST_RUN, SQL as METRICS_SQL, _history
from millrace.queries.quality import CREATED_AT, SQL as QUALITY_SQL, _contract_rows
from millrace.queries.retail import _ENRICHED
from millrace.queries.sql import STAR, total
from millrace.sources import eventlog
from millrace.sources.artifacts import Artifact, read_artifact, write_artifact
from millrace.sources.files import byte_size, file_sizes, file_stats, scanned_files
from millrace.sources.scratch import scratch_folder
from millrace.sources.tables import (
    ALL_TABLES,
    event_log_lines,
    read_table,
    retail_tables,
    run_counters,
    temporal_events,
)

FORMATS = ("parquet", "json", "orc")


def sales_ranked(spark: SparkSession, folder: str) -> DataFrame:
    """All sales in one order, largest first, with their place in it."""
    sales = retail.sales_enriched(retail_tables(spark, folder))
    ties = ("sale_id", "product_id", "vendor_id", "sale_date", "customer_id", "quantity")
    order = [F.desc("sale_amount"), *map(F.asc, ties)]
    return ranking.global_rank(sales, order, Artifact(scratch_folder(spark, "sales-ranked")))


def _stored_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs, appended one after the other; the first again, as after a failure."""
    rows = _history(spark, folder)
    store = Artifact(scratch_folder(spark, "metrics-history"))
    for run in ("batch-0", "batch-1", "batch-0"):
        history.append_run(rows.where(F.col("run_id") == run), store)
    return history.stored_history(spark, store, rows.schema)


def stored_history(spark: SparkSession, folder: str) -> DataFrame:
    return _stored_runs(spark, folder).drop("created_at")


def stored_latest_run(spark: SparkSession, folder: str) -> DataFrame:
    _stored_runs(spark, folder)
    return history.stored_latest_run(spark).drop("created_at")


def eventlog_stored_stages(spark: SparkSession, folder: str) -> DataFrame:
    """Logs in files, a folder an application, folded in one scan by the application's id."""
    lines = event_log_lines(spark, folder)
    started = F.to_json(
        F.struct(
            F.lit(eventlog.APPLICATION_START).alias("Event"), F.col("log").alias("App ID")
        )
    )
    named = lines.select("log").distinct().select("log", started.alias("value"))
    path = scratch_folder(spark, "event-logs")
    # The folder of a rolling log has this prefix.
    logs = lines.unionByName(named).withColumnRenamed("log", "eventlog_v2_app")
    logs.repartition("eventlog_v2_app").write.partitionBy("eventlog_v2_app").text(path)
    return eventlog.stage_aggregate(eventlog.read_event_logs(spark, path))


def volume_check_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The spike days of the plan against events stored by date."""
    store = Artifact(scratch_folder(spark, "events"), partition_by=("event_date",))
    events = temporal_events(spark, folder)
    write_artifact(events.repartition("event_date"), store)
    spikes = _planned(spark, folder).where("volume_multiplier > 1")
    return volume.volume_check(spikes, read_artifact(spark, store, events.schema))


def contract_results_on_write(spark: SparkSession, folder: str) -> DataFrame:
    """The rules over a metrics table with broken copies, counted while it is written."""
    metrics = contract.with_broken_copies(_contract_rows(run_counters(spark, folder)))
    store = Artifact(scratch_folder(spark, "checked-metrics"))
    return contract.write_checked(
        metrics, store, validation_run_id="check", source_path="runs", created_at=CREATED_AT
    )


def scanned_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each table, and whether the scan met the files and bytes that are listed."""
    paths = {name: f"{folder}/{name}.parquet" for name in ALL_TABLES}
    listed = None
    for name, path in paths.items():
        found = file_stats(file_sizes(spark, path)).select(
            F.lit(name).alias("table_name"), F.col("file_count").alias("files"), F.col("total_bytes").alias("bytes")
        )
        listed = found if listed is None else listed.unionByName(found)
    same = (F.col("file_count") == F.col("files")) & (F.col("total_bytes") == F.col("bytes"))
    return scanned_files(spark, paths).join(listed, "table_name").select(
        "table_name", "row_count", same.alias("as_listed")
    )


def rebalanced_write(spark: SparkSession, folder: str) -> DataFrame:
    """Sales stored by vendor region in files of bounded size: rows per region, and its files
    of more than twice the size aimed at."""
    store = Artifact(scratch_folder(spark, "sales-by-region"), partition_by=("vendor_region",))
    sales = retail.sales_enriched(retail_tables(spark, folder))
    write_artifact(sales, store, rebalance=True)
    aimed = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = (
        read_artifact(spark, store, sales.schema)
        .groupBy("vendor_region", "_metadata.file_path")
        .agg(F.count(F.lit(1)).alias("rows"), F.max("_metadata.file_size").alias("bytes"))
    )
    return files.groupBy("vendor_region").agg(
        F.sum("rows").alias("sale_count"),
        F.count_if(F.col("bytes") > 2 * byte_size(aimed)).alias("oversized_files"),
    )


def artifact_formats(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written in every format, at most 5,000 rows a file, and read with their schema."""
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("o_orderdate")
    )
    result = None
    for kind in FORMATS:
        store = Artifact(scratch_folder(spark, f"orders-{kind}"), kind, partition_by=("o_orderstatus",))
        write_artifact(orders, store, max_records_per_file=5000)
        stored = read_artifact(spark, store, orders.schema)
        counted = stored.groupBy("o_orderstatus", "_metadata.file_path").agg(
            F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"), F.max("o_orderdate").alias("day")
        )
        found = counted.groupBy("o_orderstatus").agg(
            F.sum("n").alias("row_count"),
            F.sum("keys").alias("key_sum"),
            F.max("day").alias("last_date"),
            (F.max("n") <= 5000).alias("bounded"),
        )
        found = found.select(F.lit(kind).alias("format"), "*")
        result = found if result is None else result.unionByName(found)
    return result


QUERIES = {
    query.__name__: query
    for query in (
        sales_ranked,
        stored_history,
        stored_latest_run,
        eventlog_stored_stages,
        volume_check_stored,
        contract_results_on_write,
        scanned_tables,
        rebalanced_write,
        artifact_formats,
    )
}

SQL = {
    "sales_ranked": f"""WITH {STAR}, enriched AS ({_ENRICHED})
SELECT *, row_number() OVER (ORDER BY sale_amount DESC, sale_id, product_id, vendor_id, sale_date,
                             customer_id NULLS FIRST, quantity) AS global_rank
FROM enriched""",
    "stored_history": f"WITH {_HISTORY} SELECT * EXCLUDE (created_at) FROM history",
    "stored_latest_run": f"""WITH {_HISTORY}
SELECT * EXCLUDE (created_at) FROM history WHERE run_id IN {_LATEST_RUN}""",
    "eventlog_stored_stages": METRICS_SQL["eventlog_stage_aggregate"],
    "volume_check_stored": f"""WITH {PLAN},
actual AS (SELECT event_date, count(*) AS n FROM typed GROUP BY 1)
SELECT event_date, expected_rows, coalesce(n, 0) AS actual_rows,
       coalesce(n, 0) = expected_rows AS matches
FROM planned LEFT JOIN actual USING (event_date) WHERE volume_multiplier > 1""",
    "contract_results_on_write": QUALITY_SQL["contract_results"],
    "scanned_tables": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, true AS as_listed FROM {name}"
        for name in ALL_TABLES
    ),
    "rebalanced_write": f"""WITH {STAR}
SELECT vendor_region, count(*) AS sale_count, CAST(0 AS BIGINT) AS oversized_files
FROM star GROUP BY 1""",
    "artifact_formats": f"""SELECT format, o_orderstatus, count(*) AS row_count,
       {total('o_orderkey')} AS key_sum, max(CAST(o_orderdate AS DATE)) AS last_date, true AS bounded
FROM orders, (VALUES {", ".join(f"('{kind}')" for kind in FORMATS)}) f(format) GROUP BY 1, 2""",
}
