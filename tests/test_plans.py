"""Plan shapes that matter at scale."""

import re

from millrace.operators import layout
from millrace.operators.ranking import top_n
from millrace.plans import retail, temporal
from millrace.queries import all_queries
from millrace.sources.tables import line_tables, read_table, retail_tables
from pyspark.sql import functions as F


def exchanges(plan: str) -> int:
    tree = plan.split("\n\n")[0]
    return len(re.findall(r"(?<!Broadcast)Exchange \(", tree)) - len(
        re.findall(r"ReusedExchange \(", tree)
    )


def final_plan(df, plan_of) -> str:
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


def test_regional_sales_shuffles_only_the_groups(spark, folder, plan_of):
    plan = plan_of(retail.regional_monthly_sales(line_tables(spark, folder)))
    main = plan.split("===== Subqueries =====")[0]
    assert exchanges(main) == 1
    assert "BroadcastHashJoin" in main and "SortMergeJoin" not in main
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_extendedprice:double,l_shipdate:timestamp_ntz>" in plan


def test_audit_fingerprint_needs_no_shuffle(spark, folder, plan_of):
    enriched = retail.sales_enriched(retail_tables(spark, folder))
    main = plan_of(retail.audit_fingerprint(enriched)).split("===== Subqueries =====")[0]
    assert exchanges(main) == 0


def test_audit_rows_are_hashed_before_a_keyed_exchange_piles_them_up(spark, folder, plan_of):
    enriched = retail.sales_enriched(retail_tables(spark, folder))
    exchange = layout.keyed("audit_bucket", partitions=16)
    df = retail.audit_fingerprint(enriched, exchange)
    main = plan_of(df).split("===== Subqueries =====")[0]
    assert main.index("sha2(") < main.index("REPARTITION_BY_NUM")
    plain = retail.audit_fingerprint(enriched)
    assert df.exceptAll(plain).isEmpty() and plain.exceptAll(df).isEmpty()
    assert plain.where(~F.col("audit_fingerprint").rlike("^[0-9a-f]{64}$")).isEmpty()


def test_two_level_summary_moves_raw_rows_once(spark, folder, plan_of):
    tables = retail_tables(spark, folder)
    for method in (retail.EXACT, retail.APPROXIMATE, retail.SKETCH):
        df = retail.fingerprint_workload(tables, 16, distinct=method)
        main = plan_of(df).split("===== Subqueries =====")[0]
        assert exchanges(main) == 2, method
        assert "Expand" not in main


def test_top_n_is_cut_before_the_shuffle(spark, folder, plan_of):
    lines = read_table(spark, folder, "lineitem")
    plan = plan_of(top_n(lines, ["l_suppkey"], [F.desc("l_extendedprice")], 5))
    assert plan.count("WindowGroupLimit") >= 2


def test_top_sales_keeps_only_top_rows_per_task(spark, folder, plan_of):
    plan = plan_of(all_queries()["top_sales"](spark, folder))
    assert "TakeOrderedAndProject" in plan


def test_contract_reads_the_table_once(spark, folder, plan_of):
    plan = final_plan(all_queries()["contract_results"](spark, folder), plan_of)
    assert "ReusedExchange" in plan
    assert len(set(re.findall(r"Scan parquet  \((\d+)\)", plan))) == 1


def test_one_processing_date_reads_one_partition(spark, tmp_path, plan_of):
    days = spark.range(60).select(
        F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 6).cast("int")).alias("event_date"),
        F.lit("BR_SP").alias("region"),
        F.lit("APP").alias("channel"),
        F.lit("ORDER_PAID").alias("event_type"),
        (F.col("id") % 7).alias("customer_id"),
        F.lit(1.25).alias("gross_amount"),
    )
    path = str(tmp_path / "events")
    days.write.partitionBy("event_date").parquet(path)
    from datetime import date

    one = temporal.daily_activity(spark.read.parquet(path), date(2026, 1, 3))
    plan = plan_of(one)
    assert "PartitionFilters: [isnotnull(event_date" in plan
    row = one.collect()
    assert [(r.event_count, r.customer_count, r.gross_revenue, r.avg_ticket) for r in row] == [
        (10, 7, 12.5, 1.25)
    ]
