"""Retail jobs over ``{"sales", "vendors", "products", "customers"}``.

Every job takes an ``exchange`` step (see ``operators.layout``). The default
leaves the shuffle to Catalyst; the others reproduce a chosen layout with the
same result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.functions.hashing import XXHASH64, hash_mod
from millrace.functions.labels import (
    category_label,
    month_of,
    or_no_category,
    or_unknown,
    payload_columns,
    payload_width,
    year_month,
)
from millrace.functions.money import from_cents, mean_amount, to_cents
from millrace.operators import aggregates as agg
from millrace.operators.distinct import distinct_rollup, within
from millrace.operators.layout import Exchange, as_planned
from millrace.operators.quantiles import exact_quantiles
from millrace.operators.ranking import revenue_rank, sales_by_amount
from millrace.operators.star import add_category, add_star, add_vendor_region, lookup, product_keys

Tables = Mapping[str, DataFrame]

# Fixed values of the audit job.
AUDIT_BUCKETS = 16
SLOW_AUDIT_BUCKET = 7
SLOW_AUDIT_REPEATS = 512


def _formatted_month(name: str) -> Column:
    return year_month(F.col("sale_month")).alias(name)


def amount_cents() -> Column:
    return to_cents(F.col("sale_amount")).alias("amount_cents")


# --- enriched sales -----------------------------------------------------------


def sales_enriched(tables: Tables) -> DataFrame:
    """Sales with vendor and product attributes: 13 ordered, typed columns."""
    with_vendor = lookup(
        tables["sales"],
        tables["vendors"],
        ["vendor_id"],
        vendor_name=F.col("vendor_name"),
        vendor_region=F.col("region"),
    )
    products = tables["products"]
    both = lookup(
        with_vendor,
        products,
        product_keys(products),
        product_name=F.col("product_name"),
        category_id=F.col("category_id"),
    )
    typed = {
        "sale_id": F.col("sale_id").cast("long"),
        "sale_date": F.col("sale_date"),
        "sale_year_month": year_month(F.col("sale_date")),
        "vendor_id": F.col("vendor_id").cast("long"),
        "vendor_name": F.col("vendor_name"),
        "vendor_region": F.col("vendor_region"),
        "product_id": F.col("product_id").cast("long"),
        "product_name": F.col("product_name"),
        "category_id": F.col("category_id").cast("long"),
        "customer_id": F.col("customer_id").cast("long"),
        "quantity": F.col("quantity").cast("int"),
        "unit_price": F.col("unit_price").cast("double"),
        "sale_amount": F.col("sale_amount").cast("double"),
    }
    return both.select(*[value.alias(name) for name, value in typed.items()])


def top_sales(enriched: DataFrame, *tie_breaks: str, limit: int | None = None) -> DataFrame:
    return sales_by_amount(enriched, *tie_breaks, limit=limit)


def audit_bucket(algorithm: str = XXHASH64) -> Column:
    return hash_mod(F.col("sale_id"), modulo=AUDIT_BUCKETS, algorithm=algorithm).cast("int")


def audit_fingerprint(
    enriched: DataFrame, exchange: Exchange = as_planned, algorithm: str = XXHASH64
) -> DataFrame:
    """SHA-256 of a key text, repeated 512 times in the slow bucket.

    It is a per-row computation, so the default plan has no shuffle at all. It is done
    before an exchange moves the rows, in the tasks that read them: a keyed exchange on
    ``audit_bucket`` would pile the costly rows into one task. The digest moves as 32 bytes.
    """
    text = F.concat_ws(
        ":",
        *[
            F.col(name).cast("string")
            for name in ("sale_id", "product_id", "customer_id", "sale_amount", "sale_date")
        ],
    )
    repeats = F.when(F.col("audit_bucket") == SLOW_AUDIT_BUCKET, F.lit(SLOW_AUDIT_REPEATS)).otherwise(
        F.lit(1)
    )
    return (
        enriched.withColumn("audit_bucket", audit_bucket(algorithm))
        .withColumn("audit_fingerprint", F.unhex(F.sha2(F.repeat(text, repeats), 256)))
        .transform(exchange)
        .withColumn("audit_fingerprint", F.lower(F.hex("audit_fingerprint")))
    )


# --- regional and category summaries -------------------------------------------


def regional_monthly_sales(tables: Tables, exchange: Exchange = as_planned) -> DataFrame:
    """Sales per vendor region and month; sales of unknown vendors are UNKNOWN."""
    fact = tables["sales"].select("vendor_id", "sale_date", "quantity", amount_cents())
    return (
        add_vendor_region(fact, tables["vendors"])
        .select(
            or_unknown(F.col("vendor_region")).alias("vendor_region"),
            month_of(F.col("sale_date")).alias("sale_month"),
            F.col("quantity").cast("long").alias("quantity"),
            "amount_cents",
        )
        .transform(exchange)
        .groupBy("vendor_region", "sale_month")
        .agg(*agg.sale_partials("quantity"))
        .select(
            "vendor_region",
            _formatted_month("sale_year_month"),
            "sale_count",
            F.col("quantity").alias("total_quantity"),
            agg.gross_amount(),
            agg.average_amount(),
        )
    )


def _drill_summary(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("vendor_region", "category_id", "sale_month")
        .agg(*agg.sale_partials("payload_width"))
        .select(
            "vendor_region",
            "category_id",
            _formatted_month("sale_year_month"),
            "sale_count",
            agg.gross_amount(),
            F.col("payload_width").alias("payload_bytes_observed"),
            agg.average_amount(),
        )
    )


def _drill_fact(joined: DataFrame, width: Column) -> DataFrame:
    return joined.select(
        or_unknown(F.col("vendor_region")).alias("vendor_region"),
        or_no_category(F.col("category_id")).alias("category_id"),
        month_of(F.col("sale_date")).alias("sale_month"),
        "amount_cents",
        width.alias("payload_width"),
    )


def payload_drill(tables: Tables, exchange: Exchange = as_planned) -> DataFrame:
    """Region, category and month with payload volume. Only the payload's width
    travels, never the payload."""
    sales = tables["sales"]
    fact = sales.select(
        "vendor_id",
        "product_id",
        "sale_date",
        amount_cents(),
        payload_width(sales).alias("payload_width"),
    )
    joined = add_category(add_vendor_region(fact, tables["vendors"]), tables["products"])
    return _drill_summary(_drill_fact(joined, F.col("payload_width")).transform(exchange))


def payload_drill_wide(tables: Tables, exchange: Exchange) -> DataFrame:
    """The same summary with whole payloads carried through the exchange."""
    sales = tables["sales"]
    fact = sales.select(
        "vendor_id", "product_id", "sale_date", amount_cents(), *payload_columns(sales)
    )
    joined = add_category(add_vendor_region(fact, tables["vendors"]), tables["products"])
    moved = joined.transform(exchange)
    return _drill_summary(_drill_fact(moved, payload_width(moved)))


def _vendor_fact(sales: DataFrame) -> DataFrame:
    return sales.select(
        F.col("vendor_id").cast("long").alias("vendor_id"),
        "sale_id",
        amount_cents(),
        payload_width(sales).alias("payload_width"),
    )


def _vendor_summary(merged: DataFrame) -> DataFrame:
    return merged.select(
        "vendor_id",
        "vendor_region",
        "sale_count",
        agg.gross_amount(),
        F.col("payload_width").alias("payload_bytes_observed"),
        agg.average_amount(),
    )


def vendor_summary(tables: Tables, exchange: Exchange = as_planned, salts: int = 1) -> DataFrame:
    """Sales per vendor. Sales are reduced to one row per vendor before the join,
    so a vendor with most of the sales is one row there. ``salts`` > 1 reduces
    in two steps, for an exchange that moves raw rows by vendor."""
    fact = _vendor_fact(tables["sales"]).transform(exchange)
    if salts > 1:
        per_vendor = agg.salted_aggregate(
            fact,
            ["vendor_id"],
            agg.sale_partials("payload_width"),
            agg.merge_partials("payload_width"),
            F.col("sale_id"),
            salts,
        )
    else:
        per_vendor = fact.groupBy("vendor_id").agg(*agg.sale_partials("payload_width"))
    merged = (
        add_vendor_region(per_vendor, tables["vendors"])
        .withColumn("vendor_region", or_unknown(F.col("vendor_region")))
        .groupBy("vendor_id", "vendor_region")
        .agg(*agg.merge_partials("payload_width"))
    )
    return _vendor_summary(merged)


def vendor_amount_quantiles(tables: Tables) -> DataFrame:
    """Exact median, 95 % and 99 % sale amount of each vendor with a sale of known amount."""
    fact = tables["sales"].select("vendor_id", amount_cents())
    names = {"median_amount": 500, "p95_amount": 950, "p99_amount": 990}
    found = exact_quantiles(fact, ["vendor_id"], "amount_cents", names)
    return found.select("vendor_id", *[from_cents(F.col(name)).alias(name) for name in names])


def vendor_summary_copartitioned(tables: Tables, partitions: int | None = None) -> DataFrame:
    """The skew study: both sides moved by vendor, joined raw by a shuffle join, then
    aggregated. One task receives every row of a hot vendor."""
    target = (partitions, "vendor_id") if partitions else ("vendor_id",)
    vendors = tables["vendors"].select(
        F.col("vendor_id").cast("long").alias("vendor_id"), "region"
    )
    joined = lookup(
        _vendor_fact(tables["sales"]).repartition(*target),
        vendors.repartition(*target),
        ["vendor_id"],
        strategy="merge",
        vendor_region=F.col("region"),
    )
    merged = (
        joined.withColumn("vendor_region", or_unknown(F.col("vendor_region")))
        .groupBy("vendor_id", "vendor_region")
        .agg(*agg.sale_partials("payload_width"))
    )
    return _vendor_summary(merged)


def bucket_summary(
    tables: Tables,
    active_buckets: int,
    exchange: Exchange = as_planned,
    algorithm: str = XXHASH64,
) -> DataFrame:
    """Sales per hash bucket. Few buckets in many keyed partitions leave empty tasks."""
    sales = tables["sales"]
    bucket = hash_mod(F.col("sale_id"), modulo=active_buckets, algorithm=algorithm).cast("int")
    return (
        sales.select(
            bucket.alias("partition_bucket"),
            amount_cents(),
            payload_width(sales).alias("payload_width"),
        )
        .transform(exchange)
        .groupBy("partition_bucket")
        .agg(*agg.sale_partials("payload_width"))
        .select(
            "partition_bucket",
            "sale_count",
            agg.gross_amount(),
            F.col("payload_width").alias("payload_bytes_observed"),
            agg.average_amount(),
        )
    )


# --- two-level star summaries ---------------------------------------------------

STAR_KEYS = ("vendor_region", "customer_region", "category_id", "sale_month")
APPROXIMATE = "approximate"
EXACT = "exact"
SKETCH = "sketch"


def by_group_and_bucket(fact: DataFrame) -> DataFrame:
    """Default layout of the two-level jobs: raw, narrow rows move once by group and
    bucket, and all first-level work is local after that. Aggregating before the
    shuffle would not shrink groups this fine, and it would move a sketch or an
    expanded row per distinct count. The bucket spreads a large group."""
    return fact.repartition(*STAR_KEYS, "bucket")


def _star_fact(tables: Tables, buckets: int, algorithm: str) -> DataFrame:
    sales = tables["sales"]
    bucket = hash_mod(
        F.col("sale_id"), F.col("customer_id"), modulo=buckets, algorithm=algorithm
    ).cast("int")
    fact = sales.select(
        *[F.col(name).cast("long").alias(name) for name in ("vendor_id", "product_id", "customer_id")],
        month_of(F.col("sale_date").cast("date")).alias("sale_month"),
        F.col("quantity").cast("long").alias("quantity"),
        amount_cents(),
        payload_width(sales).alias("payload_width"),
        bucket.alias("bucket"),
    )
    return add_star(fact, tables["vendors"], tables["products"], tables["customers"])


def _first_of_value(column: str) -> Column:
    """1 on one row per value inside a group and bucket, 0 on the others. Adding these up
    counts distinct values without multiplying the rows, and the sort is local to the
    partitions the rows are in already."""
    same_value = Window.partitionBy(*STAR_KEYS, "bucket", column).orderBy(F.lit(1))
    is_first = F.col(column).isNotNull() & (F.row_number().over(same_value) == 1)
    return is_first.cast("int")


def _distinct_in_bucket(entity: str, method: str) -> Column:
    if method == EXACT:
        return F.sum(f"first_{entity}")
    if method == SKETCH:
        return F.hll_sketch_agg(f"{entity}_id")
    return F.approx_count_distinct(f"{entity}_id")


def _distinct_over_buckets(column: str, method: str) -> Column:
    if method == SKETCH:
        return F.hll_sketch_estimate(F.hll_union_agg(column))
    return F.sum(column)


def _two_level(
    tables: Tables, buckets: int, exchange: Exchange, distinct: str, algorithm: str
) -> DataFrame:
    """Per bucket, then over the buckets.

    ``customer_count`` and ``product_count`` add up per-bucket counts, so one
    customer in many buckets counts many times. ``distinct="sketch"`` merges
    sketches instead and estimates the true number.
    """
    fact = _star_fact(tables, buckets, algorithm).transform(exchange)
    if distinct == EXACT:
        fact = fact.withColumns(
            {
                "first_customer": _first_of_value("customer_id"),
                "first_product": _first_of_value("product_id"),
            }
        )
    per_bucket = (
        fact.groupBy(*STAR_KEYS, "bucket")
        .agg(
            *agg.sale_partials("quantity", "payload_width"),
            _distinct_in_bucket("customer", distinct).alias("customer_count"),
            _distinct_in_bucket("product", distinct).alias("product_count"),
        )
    )
    return (
        per_bucket.groupBy(*STAR_KEYS)
        .agg(
            *agg.merge_partials("quantity", "payload_width"),
            _distinct_over_buckets("customer_count", distinct).alias("customer_count"),
            _distinct_over_buckets("product_count", distinct).alias("product_count"),
            F.count(F.lit(1)).alias("bucket_count"),
        )
        .select(
            "vendor_region",
            "customer_region",
            "category_id",
            _formatted_month("sale_year_month"),
            "sale_count",
            "customer_count",
            "product_count",
            F.col("quantity").alias("total_quantity"),
            agg.gross_amount(),
            _average_per_sale(),
            F.col("payload_width").alias("payload_bytes_observed"),
            "bucket_count",
        )
    )


def _average_per_sale() -> Column:
    """Here the divisor is the number of sales, not of known amounts."""
    return mean_amount(F.col("amount_cents"), F.col("sale_count")).alias("average_sale_amount")


# Fixed value: the grains of the distinct counts, from the finest to the whole table.
DISTINCT_GRAINS = {
    "region_month": ("vendor_region", "customer_region", "sale_month"),
    "regions": ("vendor_region", "customer_region"),
    "all": (),
}


def star_distincts(tables: Tables, share: float = 0.05) -> DataFrame:
    """True numbers of distinct customers and products per grain, where the two-level
    summaries add up per-bucket counts, and whether the merged sketches come within a share
    of them. Customers are keyed by their own range of ids, not by a bucket of sales, so
    counts of ranges add up; coarser grains merge bitmaps and read no sale again."""
    sales = tables["sales"]
    fact = sales.select(
        *[F.col(name).cast("long").alias(name) for name in ("vendor_id", "product_id", "customer_id")],
        month_of(F.col("sale_date").cast("date")).alias("sale_month"),
    )
    star = add_star(fact, tables["vendors"], tables["products"], tables["customers"])
    counts = distinct_rollup(star, DISTINCT_GRAINS, ("customer_id", "product_id"))
    near = [
        within(F.col(f"{name}_estimate"), F.col(f"{name}_count"), share)
        for name in ("customer_id", "product_id")
    ]
    return counts.select(
        "grain",
        "vendor_region",
        "customer_region",
        _formatted_month("sale_year_month"),
        F.col("customer_id_count").alias("customer_count"),
        F.col("product_id_count").alias("product_count"),
        (near[0] & near[1]).alias("within_5_pct"),
    )


def ranked_star_summary(
    tables: Tables,
    buckets: int = 256,
    exchange: Exchange = by_group_and_bucket,
    distinct: str = APPROXIMATE,
    algorithm: str = XXHASH64,
) -> DataFrame:
    """Two-level star summary with the revenue rank of each category."""
    return revenue_rank(_two_level(tables, buckets, exchange, distinct, algorithm).drop("bucket_count"))


def fingerprint_workload(
    tables: Tables,
    buckets: int = 512,
    exchange: Exchange = by_group_and_bucket,
    distinct: str = APPROXIMATE,
    algorithm: str = XXHASH64,
) -> DataFrame:
    """Two-level star summary with the number of buckets met."""
    return (
        _two_level(tables, buckets, exchange, distinct, algorithm)
        .drop("payload_bytes_observed")
        .withColumnRenamed("bucket_count", "fingerprint_bucket_count")
    )


# --- business output ------------------------------------------------------------


def _business_fact(joined: DataFrame, *extra: Column) -> DataFrame:
    return joined.select(
        month_of(F.col("sale_date")).alias("sale_month"),
        or_unknown(F.col("region")).alias("region"),
        # The label groups: numbers of three digits share the label of their first two.
        category_label(F.col("category_id")).alias("category"),
        F.col("customer_id").cast("long").alias("customer_id"),
        "amount_cents",
        *extra,
    )


def _business_totals(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("sale_month", "region", "category")
        .agg(
            F.sum("amount_cents").alias("amount_cents"),
            F.count(F.lit(1)).alias("order_count"),
            F.count_distinct("customer_id").alias("customer_count"),
        )
        .select(
            _formatted_month("order_month"),
            "region",
            "category",
            from_cents(F.col("amount_cents")).alias("gross_revenue"),
            "order_count",
            "customer_count",
        )
    )


def _with_region_and_category(fact: DataFrame, tables: Tables) -> DataFrame:
    with_region = lookup(
        fact, tables["vendors"], ["vendor_id"], region=or_unknown(F.col("region"))
    )
    return lookup(
        with_region,
        tables["products"],
        product_keys(tables["products"]),
        category_id=or_no_category(F.col("category_id")),
    )


def business_output(tables: Tables, exchange: Exchange = as_planned) -> DataFrame:
    """Revenue, orders and exact distinct customers per month, region, category.
    Also the output of the contract-gate job, which needs no customer attributes."""
    fact = tables["sales"].select(
        "vendor_id", "product_id", "customer_id", "sale_date", amount_cents()
    )
    return _business_totals(
        _business_fact(_with_region_and_category(fact, tables)).transform(exchange)
    )


def business_output_candidate(
    tables: Tables, wide_exchange: Exchange, bucket_exchange: Exchange
) -> DataFrame:
    """A costlier job with the same result, to be caught by the runtime budget: wide
    rows, an unused customer join, two extra shuffles and a hash per sale that
    never changes the revenue. ``bucket_exchange`` may use ``guardrail_bucket``."""
    sales = tables["sales"]
    fact = sales.select(
        "sale_id",
        "vendor_id",
        "product_id",
        "customer_id",
        "sale_date",
        amount_cents(),
        *payload_columns(sales),
    )
    joined = lookup(
        _with_region_and_category(fact, tables),
        tables["customers"],
        ["customer_id"],
        customer_region=or_unknown(F.col("region")),
    )
    moved = joined.transform(wide_exchange)
    burden_text = F.concat_ws(
        ":",
        *[F.col(name).cast("string") for name in ("sale_id", "customer_id", "product_id")],
        payload_width(moved).cast("string"),
    )
    burdened = _business_fact(
        moved,
        F.length(F.sha2(burden_text, 512)).alias("cpu_burden"),
        hash_mod(F.col("customer_id"), modulo=1024).cast("int").alias("guardrail_bucket"),
    ).transform(bucket_exchange)
    # The length of a digest is never negative, but the planner does not know that.
    kept = burdened.withColumn(
        "amount_cents",
        F.col("amount_cents") + F.when(F.col("cpu_burden") < 0, F.lit(1)).otherwise(F.lit(0)),
    )
    return _business_totals(kept)
