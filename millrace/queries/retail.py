"""Retail queries on the star view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.hashing import MD5
from millrace.operators import budget, layout
from millrace.plans import retail
from millrace.queries.sql import SALES, STAR, bigint, md5_mod, mean_money, money, total
from millrace.sources.tables import line_tables, read_table, retail_tables

BUCKETS = 48
STAR_BUCKETS = 64
TOP = 100


def regional_monthly_sales(spark: SparkSession, folder: str) -> DataFrame:
    return retail.regional_monthly_sales(line_tables(spark, folder))


def regional_monthly_sales_keyed(spark: SparkSession, folder: str) -> DataFrame:
    exchange = layout.keyed("vendor_region", "sale_month")
    return retail.regional_monthly_sales(line_tables(spark, folder), exchange)


def regional_monthly_sales_round_robin(spark: SparkSession, folder: str) -> DataFrame:
    return retail.regional_monthly_sales(line_tables(spark, folder), layout.round_robin())


def sales_enriched(spark: SparkSession, folder: str) -> DataFrame:
    return retail.sales_enriched(retail_tables(spark, folder))


def payload_drill(spark: SparkSession, folder: str) -> DataFrame:
    return retail.payload_drill(line_tables(spark, folder))


def payload_drill_wide(spark: SparkSession, folder: str) -> DataFrame:
    return retail.payload_drill_wide(line_tables(spark, folder), layout.round_robin())


def vendor_summary(spark: SparkSession, folder: str) -> DataFrame:
    return retail.vendor_summary(line_tables(spark, folder))


def vendor_amount_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Median and high quantiles of a vendor's sales, however many one of them has."""
    return retail.vendor_amount_quantiles(line_tables(spark, folder))


def vendor_summary_salted(spark: SparkSession, folder: str) -> DataFrame:
    exchange = layout.salted(
        "vendor_id", hot=F.lit(True), spread_by=F.col("sale_id"), salts=8
    )
    return retail.vendor_summary(line_tables(spark, folder), exchange, salts=8)


def vendor_summary_copartitioned(spark: SparkSession, folder: str) -> DataFrame:
    return retail.vendor_summary_copartitioned(line_tables(spark, folder))


def bucket_summary(spark: SparkSession, folder: str) -> DataFrame:
    return retail.bucket_summary(line_tables(spark, folder), BUCKETS, algorithm=MD5)


def bucket_summary_overpartitioned(spark: SparkSession, folder: str) -> DataFrame:
    exchange = layout.keyed("partition_bucket", partitions=27)
    return retail.bucket_summary(line_tables(spark, folder), 3, exchange, MD5)


def star_summary_ranked(spark: SparkSession, folder: str) -> DataFrame:
    return retail.ranked_star_summary(
        retail_tables(spark, folder), STAR_BUCKETS, distinct=retail.EXACT, algorithm=MD5
    )


def star_summary_approximate(spark: SparkSession, folder: str) -> DataFrame:
    return retail.ranked_star_summary(retail_tables(spark, folder), STAR_BUCKETS)


def star_summary_sketch(spark: SparkSession, folder: str) -> DataFrame:
    return retail.ranked_star_summary(
        retail_tables(spark, folder), STAR_BUCKETS, distinct=retail.SKETCH
    )


def star_distincts(spark: SparkSession, folder: str) -> DataFrame:
    return retail.star_distincts(retail_tables(spark, folder))


def fingerprint_workload(spark: SparkSession, folder: str) -> DataFrame:
    return retail.fingerprint_workload(
        retail_tables(spark, folder), STAR_BUCKETS, distinct=retail.EXACT, algorithm=MD5
    )


def business_output(spark: SparkSession, folder: str) -> DataFrame:
    return retail.business_output(retail_tables(spark, folder))


def business_output_candidate(spark: SparkSession, folder: str) -> DataFrame:
    return retail.business_output_candidate(
        retail_tables(spark, folder), layout.round_robin(), layout.keyed("guardrail_bucket")
    )


def output_compatibility(spark: SparkSession, folder: str) -> DataFrame:
    """A candidate that lost the sales of a single piece."""
    tables = retail_tables(spark, folder)
    fewer = tables | {"sales": tables["sales"].where("quantity > 1")}
    return budget.output_compatibility(retail.business_output(tables), retail.business_output(fewer))


def output_compatibility_relabelled(spark: SparkSession, folder: str) -> DataFrame:
    """A candidate with the same totals that names one region otherwise."""
    output = business_output(spark, folder)
    region = F.when(F.col("region") == "ASIA", F.lit("EAST")).otherwise(F.col("region"))
    return budget.output_compatibility(output, output.withColumn("region", region))


def top_sales(spark: SparkSession, folder: str) -> DataFrame:
    enriched = retail.sales_enriched(retail_tables(spark, folder))
    return retail.top_sales(enriched, "product_id", "vendor_id", "sale_date", limit=TOP)


def sales_by_amount(spark: SparkSession, folder: str) -> DataFrame:
    return retail.top_sales(retail.sales_enriched(retail_tables(spark, folder)))


def _audited(spark: SparkSession, folder: str, exchange: layout.Exchange) -> DataFrame:
    # Both engines write a decimal the same way, but not a double.
    enriched = retail.sales_enriched(retail_tables(spark, folder)).withColumn(
        "sale_amount", F.col("sale_amount").cast("decimal(18,2)")
    )
    return retail.audit_fingerprint(enriched, exchange, MD5).select(
        "sale_id", "product_id", "vendor_id", "sale_date", "audit_bucket", "audit_fingerprint"
    )


def audit_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return _audited(spark, folder, layout.as_planned)


def audit_fingerprint_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    return _audited(
        spark, folder, layout.keyed("audit_bucket", partitions=retail.AUDIT_BUCKETS)
    )


def audit_fingerprint_salted(spark: SparkSession, folder: str) -> DataFrame:
    exchange = layout.salted(
        "audit_bucket",
        hot=F.col("audit_bucket") == retail.SLOW_AUDIT_BUCKET,
        spread_by=F.col("sale_id"),
        salts=8,
        partitions=64,
    )
    return _audited(spark, folder, exchange)


def smoke_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """The smoke aggregate: 32 groups whose counts add up to all rows."""
    return (
        read_table(spark, folder, "lineitem")
        .groupBy((F.col("l_orderkey") % 32).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum("l_orderkey").alias("id_sum"))
        .orderBy("bucket")
    )


QUERIES = {
    query.__name__: query
    for query in (
        regional_monthly_sales,
        regional_monthly_sales_keyed,
        regional_monthly_sales_round_robin,
        sales_enriched,
        payload_drill,
        payload_drill_wide,
        vendor_summary,
        vendor_summary_salted,
        vendor_amount_quantiles,
        vendor_summary_copartitioned,
        bucket_summary,
        bucket_summary_overpartitioned,
        star_summary_ranked,
        star_summary_approximate,
        star_summary_sketch,
        star_distincts,
        fingerprint_workload,
        business_output,
        business_output_candidate,
        output_compatibility,
        output_compatibility_relabelled,
        top_sales,
        sales_by_amount,
        audit_fingerprint,
        audit_fingerprint_bucketed,
        audit_fingerprint_salted,
        smoke_buckets,
    )
}

_GROSS = money(total("cents"))
_MEAN = mean_money(total("cents"), "count(*)")

_REGIONAL = f"""WITH {STAR}
SELECT coalesce(vendor_region, 'UNKNOWN') AS vendor_region, month AS sale_year_month,
       count(*) AS sale_count, {total('quantity')} AS total_quantity,
       {_GROSS} AS gross_sales_amount, {_MEAN} AS average_sale_amount
FROM star GROUP BY 1, 2"""

_ENRICHED = f"""SELECT sale_id, sale_date, month AS sale_year_month, vendor_id, vendor_name,
       vendor_region, product_id, product_name, category_id, customer_id, quantity,
       {mean_money('cents', 'quantity')} AS unit_price, sale_amount FROM star"""

_DRILL = f"""WITH {STAR}
SELECT coalesce(vendor_region, 'UNKNOWN') AS vendor_region, coalesce(category_id, -1) AS category_id,
       month AS sale_year_month, count(*) AS sale_count, {_GROSS} AS gross_sales_amount,
       {total('width')} AS payload_bytes_observed, {_MEAN} AS average_sale_amount
FROM star GROUP BY 1, 2, 3"""

_VENDOR = f"""WITH {STAR}
SELECT vendor_id, coalesce(vendor_region, 'UNKNOWN') AS vendor_region, count(*) AS sale_count,
       {_GROSS} AS gross_sales_amount, {total('width')} AS payload_bytes_observed,
       {_MEAN} AS average_sale_amount
FROM star GROUP BY 1, 2"""


def _bucket_sql(buckets: int) -> str:
    return f"""WITH {STAR}
SELECT CAST({md5_mod('CAST(sale_id AS VARCHAR)', buckets)} AS INTEGER) AS partition_bucket,
       count(*) AS sale_count, {_GROSS} AS gross_sales_amount,
       {total('width')} AS payload_bytes_observed, {_MEAN} AS average_sale_amount
FROM star GROUP BY 1"""


_STAR_BUCKET = md5_mod("concat_ws(':', sale_id, customer_id)", STAR_BUCKETS)
_TWO_LEVEL = f"""WITH {STAR},
per_bucket AS (
    SELECT vendor_region, customer_region, category_id, month AS sale_year_month,
           {_STAR_BUCKET} AS bucket, count(*) AS n, count(DISTINCT customer_id) AS people,
           count(DISTINCT product_id) AS goods, sum(quantity) AS quantity, sum(cents) AS cents,
           sum(width) AS width
    FROM star GROUP BY 1, 2, 3, 4, 5),
summed AS (
    SELECT vendor_region, customer_region, category_id, sale_year_month,
           {total('n')} AS sale_count, {total('people')} AS customer_count,
           {total('goods')} AS product_count, {total('quantity')} AS total_quantity,
           {_GROSS} AS gross_sales_amount,
           {mean_money(total('cents'), total('n'))} AS average_sale_amount,
           {total('width')} AS payload_bytes_observed, count(*) AS fingerprint_bucket_count
    FROM per_bucket GROUP BY 1, 2, 3, 4)"""

_BUSINESS = f"""SELECT month AS order_month, coalesce(vendor_region, 'UNKNOWN') AS region,
       'category_' || lpad(CAST(coalesce(category_id, -1) AS VARCHAR), 2, '0') AS category,
       {_GROSS} AS gross_revenue, count(*) AS order_count,
       count(DISTINCT customer_id) AS customer_count
FROM star GROUP BY 1, 2, 3"""



def _compared(candidate: str) -> str:
    return f"""WITH {STAR}, b AS ({_BUSINESS}), c AS ({candidate}),
sums AS (
    SELECT (SELECT count(*) FROM b) AS baseline_row_count, (SELECT count(*) FROM c) AS candidate_row_count,
           (SELECT {total('round(gross_revenue * 100)')} FROM b) AS b_cents,
           (SELECT {total('round(gross_revenue * 100)')} FROM c) AS c_cents,
           (SELECT {total('order_count')} FROM b) AS baseline_total_order_count,
           (SELECT {total('order_count')} FROM c) AS candidate_total_order_count,
           (SELECT count(*) FROM (FROM b EXCEPT ALL FROM c))
             + (SELECT count(*) FROM (FROM c EXCEPT ALL FROM b)) AS differing_rows)
SELECT * EXCLUDE (b_cents, c_cents), b_cents / 100.0 AS baseline_total_revenue,
       c_cents / 100.0 AS candidate_total_revenue, true AS same_schema,
       baseline_row_count = candidate_row_count AND abs(b_cents - c_cents) <= 1
         AND baseline_total_order_count = candidate_total_order_count AS compatible,
       differing_rows = 0 AS identical
FROM sums"""


_AUDIT_TEXT = (
    "concat_ws(':', sale_id, product_id, customer_id, CAST(sale_amount AS DECIMAL(18,2)), sale_date)"
)
_AUDIT = f"""WITH {STAR},
bucketed AS (
    SELECT *, CAST({md5_mod('CAST(sale_id AS VARCHAR)', 16)} AS INTEGER) AS audit_bucket FROM star)
SELECT sale_id, product_id, vendor_id, sale_date, audit_bucket,
       sha256(repeat({_AUDIT_TEXT}, CASE WHEN audit_bucket = 7 THEN 512 ELSE 1 END))
         AS audit_fingerprint
FROM bucketed"""

SQL = {
    "regional_monthly_sales": _REGIONAL,
    "regional_monthly_sales_keyed": _REGIONAL,
    "regional_monthly_sales_round_robin": _REGIONAL,
    "sales_enriched": f"WITH {STAR} {_ENRICHED}",
    "payload_drill": _DRILL,
    "payload_drill_wide": _DRILL,
    "vendor_summary": _VENDOR,
    "vendor_summary_salted": _VENDOR,
    "vendor_amount_quantiles": f"""WITH {SALES}
SELECT vendor_id, {money('quantile_disc(cents, 0.5)')} AS median_amount,
       {money('quantile_disc(cents, 0.95)')} AS p95_amount,
       {money('quantile_disc(cents, 0.99)')} AS p99_amount
FROM sales WHERE cents IS NOT NULL GROUP BY 1""",
    "vendor_summary_copartitioned": _VENDOR,
    "bucket_summary": _bucket_sql(BUCKETS),
    "bucket_summary_overpartitioned": _bucket_sql(3),
    "star_summary_ranked": f"""{_TWO_LEVEL}
SELECT * EXCLUDE (fingerprint_bucket_count),
       CAST(dense_rank() OVER (PARTITION BY vendor_region, customer_region, sale_year_month
            ORDER BY gross_sales_amount DESC, category_id) AS INTEGER) AS revenue_rank_in_region
FROM summed""",
    "star_distincts": f"""WITH {STAR}
SELECT CASE WHEN grouping(vendor_region) = 1 THEN 'all' WHEN grouping(month) = 1 THEN 'regions'
            ELSE 'region_month' END AS grain,
       vendor_region, customer_region, month AS sale_year_month,
       count(DISTINCT customer_id) AS customer_count, count(DISTINCT product_id) AS product_count,
       true AS within_5_pct
FROM star
GROUP BY GROUPING SETS ((vendor_region, customer_region, month), (vendor_region, customer_region), ())""",
    "fingerprint_workload": f"{_TWO_LEVEL} SELECT * EXCLUDE (payload_bytes_observed) FROM summed",
    "business_output": f"WITH {STAR} {_BUSINESS}",
    "business_output_candidate": f"WITH {STAR} {_BUSINESS}",
    "output_compatibility": _compared(
        _BUSINESS.replace("FROM star", "FROM star WHERE quantity > 1")
    ),
    "output_compatibility_relabelled": _compared(
        "SELECT * REPLACE (CASE region WHEN 'ASIA' THEN 'EAST' ELSE region END AS region) FROM b"
    ),
    "top_sales": f"""WITH {STAR} {_ENRICHED}
ORDER BY sale_amount DESC, sale_id, product_id, vendor_id, sale_date LIMIT {TOP}""",
    "sales_by_amount": f"WITH {STAR} {_ENRICHED} ORDER BY sale_amount DESC, sale_id",
    "audit_fingerprint": _AUDIT,
    "audit_fingerprint_bucketed": _AUDIT,
    "audit_fingerprint_salted": _AUDIT,
    "smoke_buckets": f"""SELECT l_orderkey % 32 AS bucket, count(*) AS row_count,
       {total('l_orderkey')} AS id_sum FROM lineitem GROUP BY 1 ORDER BY 1""",
}
