"""The TPC-H-like test tables seen as the library's retail, event and metric tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.hashing import pick
from millrace.functions.labels import month_of, year_month
from millrace.functions.money import from_cents, half_up_div, to_cents

ALL_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)
# Stating the schema saves a job that would read file footers for it.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": """
        c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string""",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": """
        p_partkey long, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
    "orders": """
        o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """
        l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string,
        l_linestatus string, l_shipdate timestamp_ntz""",
    "events": """
        event_id long, ts timestamp_ntz, user_id long, event_type string, value double,
        props string""",
}
REGIONS = ("BR_SP", "BR_RJ", "BR_MG", "BR_PR")
CHANNELS = ("APP", "WEB", "API")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def _region_by_nation(spark: SparkSession, folder: str, nation_key: str) -> Column:
    """Region name of a nation key, from the 25 nations as one scalar map. A dimension
    then is a plain projection of its own file, and Catalyst knows from the file's
    size whether to broadcast it; a join here would multiply the size estimates."""
    nation = read_table(spark, folder, "nation")
    region = read_table(spark, folder, "region")
    names = nation.join(region, nation.n_regionkey == region.r_regionkey, "left").agg(
        F.map_from_entries(F.collect_list(F.struct("n_nationkey", "r_name")))
    )
    return F.element_at(names.scalar(), F.col(nation_key)).alias("region")


def vendors(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("vendor_id"),
        F.col("s_name").alias("vendor_name"),
        _region_by_nation(spark, folder, "s_nationkey"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        _region_by_nation(spark, folder, "c_nationkey"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_size").cast("long").alias("category_id"),
    )


def line_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Sales without the customer, so that jobs which do not need one skip the join
    with orders. Two payload columns of varying width stand for the wide rows."""
    lines = read_table(spark, folder, "lineitem")
    price = from_cents(half_up_div(to_cents(F.col("l_extendedprice")), F.col("l_quantity").cast("long")))
    return lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sale_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_suppkey").alias("vendor_id"),
        F.col("l_partkey").alias("product_id"),
        F.to_date("l_shipdate").alias("sale_date"),
        F.col("l_quantity").cast("int").alias("quantity"),
        price.alias("unit_price"),
        F.col("l_extendedprice").alias("sale_amount"),
        F.col("l_orderkey").cast("string").alias("payload_1"),
        F.concat_ws("|", "l_returnflag", "l_linestatus", F.col("l_partkey").cast("string")).alias(
            "payload_2"
        ),
    )


def sales(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id")
    )
    return line_sales(spark, folder).join(orders, "order_id", "left").drop("order_id")


def line_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "sales": line_sales(spark, folder),
        "vendors": vendors(spark, folder),
        "products": products(spark, folder),
    }


def retail_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "sales": sales(spark, folder),
        "vendors": vendors(spark, folder),
        "products": products(spark, folder),
        "customers": customers(spark, folder),
    }


def temporal_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with a business date, a channel and a region taken from the payload."""
    code = F.get_json_object("props", "$.k").cast("long")
    return read_table(spark, folder, "events").select(
        "event_id",
        F.to_date("ts").alias("event_date"),
        F.col("ts").alias("event_ts"),
        F.col("user_id").alias("customer_id"),
        "event_type",
        pick(REGIONS, code % len(REGIONS)).alias("region"),
        pick(CHANNELS, code % len(CHANNELS)).alias("channel"),
        F.col("value").alias("gross_amount"),
    )


def _cents_when(condition: Column | None = None) -> Column:
    cents = to_cents(F.col("l_extendedprice"))
    counted = cents if condition is None else F.when(condition, cents)
    return F.coalesce(F.sum(counted), F.lit(0).cast("long"))


def task_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """One task per ship month and supplier: the month is the run, five groups of
    suppliers are its stages. Returned, open and discounted lines stand for
    shuffled, written and spilled data."""
    lines = read_table(spark, folder, "lineitem")
    returned = F.col("l_returnflag") == "R"
    accepted = F.col("l_returnflag") == "A"
    open_line = F.col("l_linestatus") == "O"
    deep_discount = F.col("l_discount") >= 0.095
    return (
        lines.groupBy(month_of(F.col("l_shipdate")).alias("month"), "l_suppkey")
        .agg(
            F.sum(F.col("l_quantity").cast("long")).alias("duration"),
            F.sum(F.col("l_quantity").cast("long") - F.col("l_linenumber")).alias("executorRunTime"),
            F.sum(F.col("l_linenumber").cast("long")).alias("jvmGCTime"),
            F.count(F.lit(1)).alias("recordsRead"),
            _cents_when().alias("bytesRead"),
            F.count_if(returned).alias("shuffleRecordsRead"),
            _cents_when(returned).alias("shuffleTotalBytesRead"),
            F.count_if(open_line).alias("recordsWritten"),
            _cents_when(accepted | returned).alias("shuffleBytesWritten"),
            _cents_when(deep_discount & open_line).alias("memoryBytesSpilled"),
            _cents_when(deep_discount & ~open_line).alias("diskBytesSpilled"),
        )
        .select(
            year_month(F.col("month")).alias("run_id"),
            (F.col("l_suppkey") % 5).alias("stageId"),
            F.call_function("div", F.col("l_suppkey"), F.lit(5)).alias("index"),
            F.concat(F.lit("executor-"), (F.col("l_suppkey") % 7).cast("string")).alias("executorId"),
            F.concat(F.lit("host-"), (F.col("l_suppkey") % 3).cast("string")).alias("host"),
            "duration",
            "executorRunTime",
            "jvmGCTime",
            "recordsRead",
            "bytesRead",
            "shuffleRecordsRead",
            "shuffleTotalBytesRead",
            "recordsWritten",
            "shuffleBytesWritten",
            "memoryBytesSpilled",
            "diskBytesSpilled",
        )
    )


def run_counters(spark: SparkSession, folder: str) -> DataFrame:
    """Raw stage counters of many runs: one run per ship month, supplier and line
    status. A supplier is a workload; shipped lines are its approved runs, open
    lines its candidates. Counters without lines behind them were not emitted."""
    lines = read_table(spark, folder, "lineitem")
    flag = F.col("l_returnflag")
    cents = to_cents(F.col("l_extendedprice"))
    quantity = F.col("l_quantity").cast("long")
    number = F.col("l_linenumber").cast("long")
    spilled = F.col("l_discount") >= 0.095

    def flag_seen(value: str) -> Column:
        return F.max(F.when(flag == value, 1).otherwise(0))

    per_run = lines.groupBy(
        month_of(F.col("l_shipdate")).alias("month"), "l_suppkey", "l_linestatus"
    ).agg(
        (flag_seen("A") + flag_seen("N") + flag_seen("R")).cast("long").alias("numStages"),
        F.count(F.lit(1)).alias("numTasks"),
        (F.sum(quantity) * 20).alias("executorRunTime"),
        F.sum(F.when(F.col("l_tax") > 0.02, cents)).alias("bytesRead"),
        F.sum(quantity).alias("recordsRead"),
        F.count(F.lit(1)).alias("recordsWritten"),
        F.sum(F.when(flag == "R", cents)).alias("shuffleTotalBytesRead"),
        F.sum(F.when(flag == "A", cents)).alias("shuffleBytesWritten"),
        F.sum(F.when(spilled & (number > 3), cents)).alias("memoryBytesSpilled"),
        F.sum(F.when(spilled & (number <= 3), cents)).alias("diskBytesSpilled"),
        (F.sum(number) * 5).alias("jvmGCTime"),
        F.date_format(F.max("l_shipdate"), "yyyy-MM-dd").alias("created_at"),
    )
    variant = F.when(F.col("l_linestatus") == "F", F.lit("approved_baseline")).otherwise(
        F.lit("candidate")
    )
    return per_run.select(
        F.concat_ws(
            "-", year_month(F.col("month")), F.col("l_suppkey").cast("string"), "l_linestatus"
        ).alias("run_id"),
        F.lit("supplier-lines").alias("app_name"),
        F.concat(F.lit("supplier-"), F.col("l_suppkey").cast("string")).alias("workload_name"),
        variant.alias("workload_variant"),
        *[
            name
            for name in per_run.columns
            if name not in ("month", "l_suppkey", "l_linestatus")
        ],
    )


RUN_IDENTITY = ["run_id", "app_name", "workload_name", "workload_variant", "created_at"]


def overhead_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark runs from orders: the year is the benchmark, the status the collector
    mode, low priority a warm-up and the price the time."""
    orders = read_table(spark, folder, "orders")
    mode = (
        F.when(F.col("o_orderstatus") == "F", F.lit("none"))
        .when(F.col("o_orderstatus") == "O", F.lit("stage"))
        .otherwise(F.lit("task"))
    )
    cents = to_cents(F.col("o_totalprice"))
    return orders.select(
        F.date_format("o_orderdate", "yyyy").alias("benchmark_id"),
        F.col("o_orderkey").cast("string").alias("run_id"),
        mode.alias("mode"),
        (F.col("o_orderpriority") == "5-LOW").alias("is_warmup"),
        F.call_function("div", cents, F.lit(100)).alias("workload_wall_ms"),
        F.col("o_custkey").alias("num_tasks"),
        cents.alias("shuffle_bytes_written"),
    )


def daily_counters(spark: SparkSession, folder: str) -> DataFrame:
    """Raw stage counters by business date: two batches of a daily job over the events."""
    code = F.get_json_object("props", "$.k").cast("long")
    cents = to_cents(F.col("value"))
    kind = F.col("event_type")

    def cents_of(*kinds: str) -> Column:
        return F.coalesce(F.sum(F.when(kind.isin(*kinds), cents)), F.lit(0).cast("long"))

    return (
        read_table(spark, folder, "events")
        .groupBy(
            F.concat(F.lit("batch-"), (code % 2).cast("string")).alias("run_id"),
            F.to_date("ts").alias("processing_date"),
        )
        .agg(
            F.count_if(kind == "purchase").alias("recordsWritten"),
            F.count(F.lit(1)).alias("recordsRead"),
            F.sum(cents).alias("executorRunTime"),
            F.sum(cents + code).alias("bytesRead"),
            cents_of("click").alias("shuffleTotalBytesRead"),
            cents_of("view", "signup").alias("shuffleBytesWritten"),
            cents_of("error").alias("memoryBytesSpilled"),
            cents_of("purchase").alias("diskBytesSpilled"),
            F.sum(code).alias("jvmGCTime"),
            (F.max(code) + 1).alias("numTasks"),
            (F.max(code) % 5 + 1).alias("numStages"),
            F.max("ts").alias("created_at"),
        )
        .withColumn(
            "date_run_id", F.concat_ws("-", "run_id", F.date_format("processing_date", "yyyyMMdd"))
        )
        .withColumn("filter_strategy", F.lit("early_partition_filter"))
    )


DAILY_IDENTITY = ["run_id", "date_run_id", "filter_strategy", "processing_date", "created_at"]


def volume_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """First and last event date and the average events of a day."""
    events = read_table(spark, folder, "events")
    first, last = F.to_date(F.min("ts")), F.to_date(F.max("ts"))
    days = (F.datediff(last, first) + 1).cast("long")
    return events.agg(
        first.alias("first_date"),
        last.alias("last_date"),
        F.call_function("div", F.count(F.lit(1)), days).alias("base_rows"),
    )


def volume_spikes(spark: SparkSession, folder: str) -> DataFrame:
    """Days with an unusual share of events over 100: ten or a hundred times the volume."""
    heavy = F.call_function(
        "div", F.count_if(F.col("value") > 100) * F.lit(1000), F.count(F.lit(1))
    )
    return (
        read_table(spark, folder, "events")
        .groupBy(F.to_date("ts").alias("event_date"))
        .agg(heavy.alias("heavy"))
        .where(F.col("heavy") >= 140)
        .select(
            "event_date",
            F.when(F.col("heavy") >= 155, F.lit(100)).otherwise(F.lit(10)).alias("volume_multiplier"),
        )
    )


def event_log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Event-log lines for the runs of ``task_metrics``: one event per finished task, one
    per completed stage, and two jobs per run that both list stage 2."""
    tasks = task_metrics(spark, folder)
    finished = tasks.select(
        F.col("run_id").alias("log"),
        F.to_json(
            F.struct(
                F.lit("SparkListenerTaskEnd").alias("Event"),
                F.col("stageId").alias("Stage ID"),
                F.lit(0).alias("Stage Attempt ID"),
                F.struct(
                    (F.col("index") * 5 + F.col("stageId")).alias("Task ID"),
                    F.col("index").alias("Index"),
                    F.lit(1000).cast("long").alias("Launch Time"),
                    (F.col("duration") + 1000).alias("Finish Time"),
                    F.col("executorId").alias("Executor ID"),
                    F.col("host").alias("Host"),
                    F.lit(False).alias("Failed"),
                    F.lit(False).alias("Killed"),
                ).alias("Task Info"),
                F.struct(
                    F.col("executorRunTime").alias("Executor Run Time"),
                    F.col("jvmGCTime").alias("JVM GC Time"),
                    F.col("memoryBytesSpilled").alias("Memory Bytes Spilled"),
                    F.col("diskBytesSpilled").alias("Disk Bytes Spilled"),
                    F.struct(
                        F.col("bytesRead").alias("Bytes Read"),
                        F.col("recordsRead").alias("Records Read"),
                    ).alias("Input Metrics"),
                    F.struct(F.col("recordsWritten").alias("Records Written")).alias(
                        "Output Metrics"
                    ),
                    F.struct(
                        F.lit(7).cast("long").alias("Remote Bytes Read"),
                        F.col("shuffleTotalBytesRead").alias("Local Bytes Read"),
                        F.col("shuffleRecordsRead").alias("Total Records Read"),
                    ).alias("Shuffle Read Metrics"),
                    F.struct(
                        F.col("shuffleBytesWritten").alias("Shuffle Bytes Written")
                    ).alias("Shuffle Write Metrics"),
                ).alias("Task Metrics"),
            )
        ).alias("value"),
    )
    stages = tasks.groupBy("run_id", "stageId").agg(F.count(F.lit(1)).alias("tasks"))
    completed = stages.select(
        F.col("run_id").alias("log"),
        F.to_json(
            F.struct(
                F.lit("SparkListenerStageCompleted").alias("Event"),
                F.struct(
                    F.col("stageId").alias("Stage ID"),
                    F.lit(0).alias("Stage Attempt ID"),
                    F.col("tasks").alias("Number of Tasks"),
                ).alias("Stage Info"),
            )
        ).alias("value"),
    )
    jobs = F.array(
        F.struct(F.lit("load").alias("step"), F.lit(0).alias("job"), F.array(*map(F.lit, (0, 1, 2))).alias("stages")),
        F.struct(F.lit("report").alias("step"), F.lit(1).alias("job"), F.array(*map(F.lit, (2, 3, 4))).alias("stages")),
    )
    started = (
        tasks.select("run_id")
        .distinct()
        .select(F.col("run_id").alias("log"), F.inline(jobs))
        .select(
            "log",
            F.to_json(
                F.struct(
                    F.lit("SparkListenerJobStart").alias("Event"),
                    F.col("job").alias("Job ID"),
                    F.col("stages").alias("Stage IDs"),
                    F.struct(
                        F.col("step").alias("spark.jobGroup.id"),
                        F.concat(F.lit("step "), "step").alias("spark.job.description"),
                    ).alias("Properties"),
                )
            ).alias("value"),
        )
    )
    return finished.unionByName(completed).unionByName(started)
