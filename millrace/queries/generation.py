"""Generated tables whose sizes come from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.hashing import MD5
from millrace.generate import events as event_generator
from millrace.generate import retail
from millrace.generate.rows import expand_rows
from millrace.generate.volume import planned_volumes
from millrace.operators.aggregates import key_rows_share
from millrace.operators.profile import row_counts
from millrace.operators.star import fk_violations
from millrace.queries.events import PLAN
from millrace.queries.sql import md5_mod
from millrace.sources.tables import read_table, volume_bounds, volume_spikes

PAYLOAD_COLUMNS = 2
PAYLOAD_WIDTH = 24
ROWS_PER_CHUNK = 5_000


def _sizes(spark: SparkSession, folder: str) -> DataFrame:
    """One row with the number of vendors, products per vendor, customers and sales."""
    counts = row_counts(
        {name: read_table(spark, folder, name) for name in ("supplier", "part", "customer", "lineitem")}
    )

    def rows(name: str):
        return F.max(F.when(F.col("table_name") == name, F.col("rows")))

    return counts.agg(
        rows("supplier").alias("vendors"),
        F.call_function("div", rows("part"), rows("supplier")).alias("products_per_vendor"),
        rows("customer").alias("customers"),
        rows("lineitem").alias("sales"),
    )


def _numbers(spark: SparkSession, folder: str, rows) -> DataFrame:
    return expand_rows(_sizes(spark, folder), rows, first=1, chunk=ROWS_PER_CHUNK)


def gen_vendors(spark: SparkSession, folder: str) -> DataFrame:
    return retail.generate_vendors(_numbers(spark, folder, F.col("vendors")))


def gen_products(spark: SparkSession, folder: str) -> DataFrame:
    rows = F.col("vendors") * F.col("products_per_vendor")
    return retail.generate_products(_numbers(spark, folder, rows), F.col("vendors"))


def gen_customers(spark: SparkSession, folder: str) -> DataFrame:
    return retail.generate_customers(_numbers(spark, folder, F.col("customers")))


def gen_sales(spark: SparkSession, folder: str) -> DataFrame:
    scale = retail.Scale(
        vendors=F.col("vendors"),
        products_per_vendor=F.col("products_per_vendor"),
        customers=F.col("customers"),
        sales=F.col("sales"),
        payload_columns=PAYLOAD_COLUMNS,
        payload_width=PAYLOAD_WIDTH,
    )
    return retail.generate_sales(_numbers(spark, folder, F.col("sales")), scale, algorithm=MD5)


def gen_fk_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Generated sales never miss a generated dimension row."""
    return fk_violations(
        {
            "sales": gen_sales(spark, folder),
            "vendors": gen_vendors(spark, folder),
            "products": gen_products(spark, folder),
            "customers": gen_customers(spark, folder),
        }
    )


def gen_hot_share(spark: SparkSession, folder: str) -> DataFrame:
    return key_rows_share(gen_sales(spark, folder), "vendor_id", retail.SalesShape().hot_vendor)


def gen_events(spark: SparkSession, folder: str) -> DataFrame:
    volumes = planned_volumes(volume_bounds(spark, folder), volume_spikes(spark, folder))
    dimensions = event_generator.EventDimensions(accounts=500, customers=2_000)
    return event_generator.generate_events(
        volumes, dimensions=dimensions, algorithm=MD5, rows_per_chunk=ROWS_PER_CHUNK
    ).withColumn("event_ts", F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss")).drop("created_at")


QUERIES = {
    query.__name__: query
    for query in (
        gen_vendors,
        gen_products,
        gen_customers,
        gen_sales,
        gen_fk_violations,
        gen_hot_share,
        gen_events,
    )
}

_SIZES = """sizes AS (
    SELECT (SELECT count(*) FROM supplier) AS vendors,
           (SELECT count(*) FROM part) // (SELECT count(*) FROM supplier) AS per_vendor,
           (SELECT count(*) FROM customer) AS customers, (SELECT count(*) FROM lineitem) AS sales)"""


def _ids(rows: str) -> str:
    return f"(SELECT unnest(range(1, {rows} + 1)) AS id, * FROM sizes)"


def _region(number: str) -> str:
    return (
        f"CASE WHEN {number} % 10 < 5 THEN 'US' WHEN {number} % 10 < 7 THEN 'BR' "
        f"WHEN {number} % 10 < 9 THEN 'EU' ELSE 'APAC' END"
    )


def _draw(step: int, modulo: str | int) -> str:
    return md5_mod(f"concat_ws(':', id, {42 + step})", modulo)


def _event_draw(step: int, modulo: int) -> str:
    return md5_mod(f"concat_ws(':', n, {77 + step})", modulo)


def _event_pick(step: int, values: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{value}'" for value in values)
    return f"([{listed}])[{_event_draw(step, len(values))} + 1]"


_PAYLOADS = ", ".join(
    f"substr(sha256(concat_ws(':', id, '{i}', '42')), 1, {PAYLOAD_WIDTH}) AS payload_{i + 1}"
    for i in range(PAYLOAD_COLUMNS)
)
_SALES = f"""drawn AS (
    SELECT *, {_draw(0, 10_000)} < 7000 AS hot, {_draw(1, '(vendors - 1)')} + 1 AS other,
           {_draw(6, 50_000)} + 100 AS unit_cents, {_draw(5, 5)} + 1 AS q FROM {_ids('sales')}),
made AS (
    SELECT id AS sale_id, CASE WHEN hot THEN 1 ELSE other + 1 END AS vendor_id,
           {_draw(2, 'per_vendor')} * vendors + CASE WHEN hot THEN 1 ELSE other + 1 END AS product_id,
           {_draw(3, 'customers')} + 1 AS customer_id,
           DATE '2026-01-01' + CAST({_draw(4, 30)} AS INTEGER) AS sale_date,
           CAST(q AS INTEGER) AS quantity, unit_cents / 100.0 AS unit_price,
           unit_cents * q / 100.0 AS sale_amount, {_PAYLOADS}
    FROM drawn)"""
_DIMENSIONS = event_generator.EventDimensions()

SQL = {
    "gen_vendors": f"""WITH {_SIZES}
SELECT id AS vendor_id, 'vendor_' || lpad(CAST(id AS VARCHAR), 6, '0') AS vendor_name,
       {_region('id')} AS region FROM {_ids('vendors')}""",
    "gen_products": f"""WITH {_SIZES}
SELECT id AS product_id, (id - 1) % vendors + 1 AS vendor_id,
       'product_' || lpad(CAST(id AS VARCHAR), 8, '0') AS product_name, id % 50 + 1 AS category_id
FROM {_ids('vendors * per_vendor')}""",
    "gen_customers": f"""WITH {_SIZES}
SELECT id AS customer_id, 'customer_' || lpad(CAST(id AS VARCHAR), 9, '0') AS customer_name,
       {_region('id')} AS region FROM {_ids('customers')}""",
    "gen_sales": f"WITH {_SIZES}, {_SALES} SELECT * FROM made",
    "gen_fk_violations": f"""WITH {_SIZES}, {_SALES}
SELECT 'vendor' AS relationship, count(*) AS violations FROM made, sizes
WHERE vendor_id < 1 OR vendor_id > vendors
UNION ALL SELECT 'product', count(*) FROM made, sizes
WHERE product_id < 1 OR product_id > vendors * per_vendor OR (product_id - 1) % vendors + 1 <> vendor_id
UNION ALL SELECT 'customer', count(*) FROM made, sizes WHERE customer_id < 1 OR customer_id > customers""",
    "gen_hot_share": f"""WITH {_SIZES}, {_SALES}
SELECT CAST(1 AS BIGINT) AS vendor_id, count(*) FILTER (WHERE vendor_id = 1) AS hot_rows,
       count(*) AS total_rows, count(*) FILTER (WHERE vendor_id = 1) / CAST(count(*) AS DOUBLE) AS hot_share
FROM made""",
    "gen_events": f"""WITH {PLAN},
numbered AS (SELECT event_date, unnest(range(0, expected_rows)) AS n FROM planned)
SELECT strftime(event_date, '%Y%m%d') || '-' || lpad(CAST(n AS VARCHAR), 12, '0') AS event_id, event_date,
       strftime(event_date + to_seconds(n % 86400), '%Y-%m-%d %H:%M:%S') AS event_ts,
       {_event_draw(1, 500)} + 1 AS account_id, {_event_draw(2, 2000)} + 1 AS customer_id,
       {_event_draw(3, 500)} + 1 AS vendor_id, {_event_draw(4, 5000)} + 1 AS product_id,
       {_event_pick(5, _DIMENSIONS.regions)} AS region, {_event_pick(6, _DIMENSIONS.channels)} AS channel,
       {_event_pick(7, _DIMENSIONS.event_types)} AS event_type,
       CAST({_event_draw(8, 5)} + 1 AS INTEGER) AS quantity,
       ({_event_draw(8, 5)} + 1) * ({_event_draw(9, 20_000)} + 500) / 100.0 AS gross_amount,
       {_event_pick(10, event_generator.SIZE_BUCKETS)} AS payload_size_bucket
FROM numbered""",
}
