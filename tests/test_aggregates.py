"""Money, medians, keys and salting against brute force."""

import random
import statistics
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from millrace.functions import hashing, labels, money, ratios
from millrace.operators import aggregates as agg
from millrace.operators import star
from millrace.plans import retail


def test_money_is_exact_and_rounds_half_away_from_zero(spark):
    rows = [(1001, 2), (-1001, 2), (1000, 3), (5, 10), (-5, 10), (7, 0)]
    got = spark.createDataFrame(rows, "c long, n long").select(
        money.half_up_div(F.col("c"), F.col("n")).alias("x")
    )
    want = [
        None if n == 0 else int((Decimal(c) / n).quantize(Decimal(1), ROUND_HALF_UP)) for c, n in rows
    ]
    assert [r.x for r in got.collect()] == want


def test_sum_does_not_depend_on_partitions(spark):
    amounts = [(i, round(random.Random(i).uniform(-50, 50), 2)) for i in range(3000)]
    df = spark.createDataFrame(amounts, "sale_id long, sale_amount double")
    want = float(sum(Decimal(str(a)) for _, a in amounts))
    for parts in (1, 7, 64):
        total = df.repartition(parts).agg(F.sum(money.to_cents(F.col("sale_amount"))).alias("c"))
        assert total.select(money.from_cents(F.col("c")).alias("x")).first().x == want


def test_exact_median_with_one_dominant_key(spark):
    draw = random.Random(5)
    values = {
        "hot": [draw.randrange(0, 10**7) for _ in range(4001)],
        "ties": [4096] * 10 + [8192] * 10,
        "one": [17],
        "pair": [3, 50_000],
        "negative": [-5000, -1, 0, 9000],
    }
    rows = [(k, v) for k, vs in values.items() for v in vs] + [("hot", None), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(5)
    got = {r.k: r["median"] for r in agg.exact_median(df, ["k"], "v").collect()}
    assert got == {k: float(statistics.median(vs)) for k, vs in values.items()}


def test_top_key_breaks_ties_and_survives_nothing(spark):
    df = spark.createDataFrame([(3,), (3,), (1,), (1,), (2,)], "vendor_id long")
    row = agg.top_key(df, "vendor_id").first()
    assert (row.top_vendor_id, row.top_rows, row.top_share) == (1, 2, 0.4)
    assert tuple(agg.top_key(df.limit(0), "vendor_id").first()) == (None, 0, 0.0)


def test_share_of_a_missing_key_is_zero(spark):
    df = spark.createDataFrame([(3,)], "vendor_id long")
    assert agg.key_rows_share(df, "vendor_id", 9).first().hot_share == 0.0
    assert agg.key_rows_share(df.limit(0), "vendor_id", 9).first().hot_share == 0.0


def test_orphans_count_null_keys(spark):
    fact = spark.createDataFrame([(1,), (1,), (9,), (9,), (None,)], "vendor_id long")
    dim = spark.createDataFrame([(1,)], "vendor_id long")
    assert star.orphan_rows(fact, dim, ["vendor_id"]).first().violations == 3
    assert star.orphan_rows(fact.limit(0), dim, ["vendor_id"]).first().violations == 0


def test_fk_violations_in_one_pass(spark):
    sales = spark.createDataFrame(
        [(1, 10, 5), (1, 11, 5), (2, 10, None), (None, 10, 9), (7, 70, 5)],
        "vendor_id long, product_id long, customer_id long",
    )
    tables = {
        "sales": sales,
        "vendors": spark.createDataFrame([(1,), (2,), (2,)], "vendor_id long"),
        "products": spark.createDataFrame([(10, 1), (11, 1), (10, 3)], "product_id long, vendor_id long"),
        "customers": spark.createDataFrame([(5,)], "customer_id int"),
    }
    found = {r.relationship: r.violations for r in star.fk_violations(tables).collect()}
    assert found == {"vendor": 2, "product": 3, "customer": 2}
    for name, keys in {"vendor": ["vendor_id"], "product": ["product_id", "vendor_id"]}.items():
        assert star.orphan_rows(sales, tables[f"{name}s"], keys).first().violations == found[name]
    empty = star.fk_violations({**tables, "sales": sales.limit(0)}).collect()
    assert [r.violations for r in empty] == [0, 0, 0]


def retail_tables(spark, rows=4000):
    """Half the sales belong to vendor 1; some keys have no dimension row."""
    number = F.col("id")
    sales = spark.range(rows).select(
        number.alias("sale_id"),
        F.when(number % 2 == 0, 1).otherwise(number % 11).cast("long").alias("vendor_id"),
        (number % 13).alias("product_id"),
        (number % 17).alias("customer_id"),
        F.date_add(F.lit("2026-01-25").cast("date"), (number % 20).cast("int")).alias("sale_date"),
        (number % 5 + 1).cast("int").alias("quantity"),
        ((number % 997) / 4).alias("unit_price"),
        F.round((number % 997) * 1.01, 2).alias("sale_amount"),
        F.lpad((number % 1000).cast("string"), 5, "x").alias("payload_1"),
        F.when(number % 3 == 0, F.lit("ab")).alias("payload_2"),
    )
    vendors = spark.range(9).select(
        number.alias("vendor_id"),
        F.concat(F.lit("v"), number.cast("string")).alias("vendor_name"),
        F.when(number % 3 == 0, "EU").when(number % 3 == 1, "US").alias("region"),
    )
    products = spark.range(11 * 9).select(
        (number % 11).alias("product_id"),
        F.floor(number / 11).alias("vendor_id"),
        F.lit("p").alias("product_name"),
        F.when(number % 11 != 4, number % 11 * 10).alias("category_id"),
    )
    customers = spark.range(15).select(
        number.alias("customer_id"), F.lit("c").alias("customer_name"), F.lit("BR").alias("region")
    )
    return {"sales": sales, "vendors": vendors, "products": products, "customers": customers}


def same(left, right):
    assert sorted(map(repr, left.collect())) == sorted(map(repr, right.collect()))


def test_layouts_do_not_change_results(spark):
    from millrace.operators.layout import as_planned, keyed, round_robin, salted

    tables = retail_tables(spark)
    plain = retail.regional_monthly_sales(tables)
    same(plain, retail.regional_monthly_sales(tables, round_robin(9)))
    same(plain, retail.regional_monthly_sales(tables, keyed("vendor_region", partitions=3)))
    same(retail.payload_drill(tables), retail.payload_drill_wide(tables, round_robin(5)))
    vendor = retail.vendor_summary(tables)
    same(vendor, retail.vendor_summary_copartitioned(tables, 7))
    spread = salted("vendor_id", hot=F.col("vendor_id") == 1, spread_by=F.col("sale_id"), salts=4)
    same(vendor, retail.vendor_summary(tables, spread, salts=4))
    for exchange in (as_planned, keyed("bucket", partitions=3)):
        same(
            retail.ranked_star_summary(tables, 8, distinct=retail.EXACT),
            retail.ranked_star_summary(tables, 8, exchange, retail.EXACT),
        )
    same(
        retail.business_output(tables),
        retail.business_output_candidate(tables, round_robin(4), keyed("guardrail_bucket")),
    )


def test_unmatched_sales_are_kept(spark):
    tables = retail_tables(spark)
    regions = {r.vendor_region for r in retail.regional_monthly_sales(tables).collect()}
    assert regions == {"EU", "US", "UNKNOWN"}
    star_rows = retail.fingerprint_workload(tables, 4, distinct=retail.EXACT)
    # Filled on the dimension side: a known vendor without region is UNKNOWN, an unknown one null.
    assert {r.vendor_region for r in star_rows.collect()} == {"EU", "US", "UNKNOWN", None}
    assert star_rows.agg(F.sum("sale_count")).first()[0] == 4000
    drill = retail.payload_drill(tables)
    assert -1 in {r.category_id for r in drill.collect()}


def test_bucketed_distinct_counts_against_brute_force(spark):
    tables = retail_tables(spark, 600)
    rows = tables["sales"].withColumn(
        "bucket", hashing.hash_mod(F.col("sale_id"), F.col("customer_id"), modulo=4)
    ).collect()
    want = len({(r.vendor_id, r.product_id, r.sale_date.month, r.bucket, r.customer_id) for r in rows})
    vendors = tables["vendors"].withColumn("region", F.col("vendor_id").cast("string"))
    products = tables["sales"].select("product_id", "vendor_id").distinct().withColumn(
        "category_id", F.col("product_id")
    )
    customers = tables["customers"].withColumn("region", F.lit("BR"))
    every_vendor = spark.range(11).select(
        F.col("id").alias("vendor_id"), F.col("id").cast("string").alias("region")
    )
    every_customer = spark.range(17).select(
        F.col("id").alias("customer_id"), F.lit("BR").alias("region")
    )
    assert vendors.count() < every_vendor.count() and customers.count() < every_customer.count()
    whole = {
        "sales": tables["sales"],
        "vendors": every_vendor,
        "products": products,
        "customers": every_customer,
    }
    got = retail.fingerprint_workload(whole, 4, distinct=retail.EXACT)
    assert got.agg(F.sum("customer_count")).first()[0] == want


def test_sketch_estimates_true_distinct_customers(spark):
    tables = retail_tables(spark)
    exact = retail.business_output(tables)
    sketch = retail.fingerprint_workload(tables, 64, distinct=retail.SKETCH)
    summed = retail.fingerprint_workload(tables, 64, distinct=retail.EXACT)
    assert sketch.agg(F.max("customer_count")).first()[0] <= 17
    assert summed.agg(F.max("customer_count")).first()[0] > 17
    assert exact.agg(F.max("customer_count")).first()[0] <= 17


def test_salting_spreads_the_hot_rows(spark):
    from millrace.operators.layout import keyed, salted

    def largest(exchange):
        moved = tables["sales"].transform(exchange)
        return moved.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

    tables = retail_tables(spark)
    hot = F.col("vendor_id") == 1
    spread = salted("vendor_id", hot=hot, spread_by=F.col("sale_id"), salts=16, partitions=16)
    assert largest(spread) < largest(keyed("vendor_id", partitions=16)) / 2


def test_slow_audit_bucket_meets_every_salt(spark):
    hot = spark.range(5000).where(retail_bucket() == retail.SLOW_AUDIT_BUCKET)
    salt = hashing.hash_mod(F.col("id"), modulo=8, seed=8)
    assert hot.select(salt).distinct().count() == 8


def retail_bucket():
    return hashing.hash_mod(F.col("id"), modulo=retail.AUDIT_BUCKETS)


def test_hash_modulo_must_be_positive(spark):
    import pytest

    with pytest.raises(ValueError):
        hashing.hash_mod(F.lit(1), modulo=0)


def test_ratios(spark):
    rows = [(6.0, 2.0), (5.0, 0.0), (0.0, 0.0), (1.0, 3.0)]
    n, d = F.col("n"), F.col("d")
    got = spark.createDataFrame(rows, "n double, d double").select(
        ratios.sentinel_ratio(n, d).alias("s"),
        ratios.safe_ratio(n, d).alias("r"),
        ratios.pct_growth(d, n).alias("g"),
        ratios.gc_share_pct(n, d).alias("p"),
    ).collect()
    assert [r.s for r in got] == [3.0, 999999.0, 0.0, 1.0 / 3.0]
    assert [r.r for r in got] == [3.0, None, None, 0.333333]
    assert [r.g for r in got] == [200.0, 100.0, 0.0, -66.6667]
    assert [r.p for r in got] == [300.0, 0.0, 0.0, 1.0 / 3.0 * 100.0]


def test_skew_wording(spark):
    got = spark.createDataFrame([(10.0,), (9.9,), (2.9,)], "r double").select(
        ratios.skew_wording(F.col("r")).alias("w")
    )
    assert [r.w.split()[0] for r in got.collect()] == ["strong", "moderate", "low"]


def test_category_label(spark):
    got = spark.createDataFrame([(7,), (42,), (None,), (123,)], "c long").select(
        labels.category_label(F.col("c")).alias("l")
    )
    assert [r.l for r in got.collect()] == [
        "category_07",
        "category_42",
        "category_-1",
        "category_123",
    ]


def test_payload_width_without_payload_is_zero(spark):
    df = spark.range(1)
    assert df.select(labels.payload_width(df)).first()[0] == 0


def test_labels_keep_long_numbers(spark):
    from millrace.functions.labels import category_label, numbered

    df = spark.createDataFrame([(7,), (10,), (100,), (1_234_567,), (None,)], "n long")
    found = df.select(category_label(F.col("n")), numbered("vendor_", F.col("n"), 6)).collect()
    assert [r[0] for r in found[:4]] == [
        "category_07", "category_10", "category_100", "category_1234567",
    ]
    assert [r[1] for r in found[:4]] == [
        "vendor_000007", "vendor_000010", "vendor_000100", "vendor_1234567",
    ]


def test_top_key_may_be_null_or_text(spark):
    from millrace.operators.aggregates import top_key

    numbers = spark.createDataFrame([(None,), (None,), (5,)], "k long")
    assert tuple(top_key(numbers, "k").first()) == (None, 2, 2 / 3)
    tied = spark.createDataFrame([("b",), ("a",), (None,)], "k string")
    assert tuple(top_key(tied, "k").first()) == ("a", 1, 1 / 3)
    assert tuple(top_key(numbers.limit(0), "k").first()) == (None, 0, 0.0)
