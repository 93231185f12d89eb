"""Retail tables with a hot vendor and intact foreign keys.

The functions take a DataFrame with an ``id`` column and a ``Scale``. Scale sizes
are numbers, or columns of that DataFrame when they come from another table.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.hashing import XXHASH64, hash_mod
from millrace.functions.labels import numbered
from millrace.functions.money import from_cents
from millrace.generate.rows import ids
from millrace.operators.layout import Exchange, salted

DIGEST_WIDTH = 64
CATEGORIES = 50


@dataclass(frozen=True)
class Scale:
    vendors: int | Column
    products_per_vendor: int | Column
    customers: int | Column
    sales: int | Column
    partitions: int = 4
    max_records_per_file: int = 50_000
    payload_columns: int = 1
    payload_width: int = 32

    def row_counts(self) -> dict[str, int]:
        return {
            "vendors": self.vendors,
            "products": self.vendors * self.products_per_vendor,
            "customers": self.customers,
            "sales": self.sales,
        }


# The named scales.
SCALES = {
    "demo": Scale(20, 10, 10_000, 200_000),
    "xs": Scale(100, 20, 250_000, 5_000_000, 16, 250_000, 2, 64),
    "s": Scale(250, 40, 1_000_000, 50_000_000, 64, 500_000, 3, 96),
}


@dataclass(frozen=True)
class SalesShape:
    """Skew and time range; the defaults are fixed values."""

    seed: int = 42
    hot_vendor: int = 1
    hot_share: float = 0.70
    share_tolerance: float = 0.08
    start: date = date(2026, 1, 1)
    days: int = 30


def region_of(number: Column) -> Column:
    """Half US, a fifth each BR and EU, a tenth APAC."""
    last_digit = number % 10
    return (
        F.when(last_digit < 5, F.lit("US"))
        .when(last_digit < 7, F.lit("BR"))
        .when(last_digit < 9, F.lit("EU"))
        .otherwise(F.lit("APAC"))
    )


def generate_vendors(numbers: DataFrame) -> DataFrame:
    """``id`` counts from 1."""
    return numbers.select(
        F.col("id").alias("vendor_id"),
        numbered("vendor_", F.col("id"), 6).alias("vendor_name"),
        region_of(F.col("id")).alias("region"),
    )


def generate_products(numbers: DataFrame, vendors: int | Column) -> DataFrame:
    """``id`` counts from 1; products go round the vendors."""
    number = F.col("id")
    return numbers.select(
        number.alias("product_id"),
        ((number - 1) % F.lit(vendors) + 1).alias("vendor_id"),
        numbered("product_", number, 8).alias("product_name"),
        (number % CATEGORIES + 1).alias("category_id"),
    )


def generate_customers(numbers: DataFrame) -> DataFrame:
    """``id`` counts from 1."""
    return numbers.select(
        F.col("id").alias("customer_id"),
        numbered("customer_", F.col("id"), 9).alias("customer_name"),
        region_of(F.col("id")).alias("region"),
    )


def generate_sales(
    numbers: DataFrame, scale: Scale, shape: SalesShape = SalesShape(), algorithm: str = XXHASH64
) -> DataFrame:
    """``id`` counts from 1. Every value is a hash of the id, so the rows do not depend
    on the number of partitions."""
    number = F.col("id")

    def drawn(step: int, modulo: int | Column) -> Column:
        return hash_mod(number, modulo=modulo, seed=shape.seed + step, algorithm=algorithm)

    hot = F.lit(shape.hot_vendor).cast("long")
    is_hot = drawn(0, 10_000) < int(shape.hot_share * 10_000)
    # The other vendors are numbered without the hot one, then shifted past it.
    other = drawn(1, F.lit(scale.vendors) - 1) + 1
    vendor = F.when(is_hot, hot).when(other >= hot, other + 1).otherwise(other)
    priced = numbers.withColumns(
        {
            "vendor_id": vendor,
            "quantity": (drawn(5, 5) + 1).cast("int"),
            "_unit_cents": drawn(6, 50_000) + 100,
        }
    )
    if scale.payload_columns and scale.payload_width < 1:
        raise ValueError("payload_width must be at least 1")

    def digest(column: int, part: int) -> Column:
        name = [number.cast("string"), F.lit(str(column)), F.lit(str(shape.seed))]
        return F.sha2(F.concat_ws(":", *name, *([F.lit(str(part))] if part else [])), 256)

    parts = range(-(-scale.payload_width // DIGEST_WIDTH))
    payloads = [
        F.substring(F.concat(*[digest(i, part) for part in parts]), 1, scale.payload_width).alias(
            f"payload_{i + 1}"
        )
        for i in range(scale.payload_columns)
    ]
    return priced.select(
        number.alias("sale_id"),
        "vendor_id",
        (drawn(2, scale.products_per_vendor) * F.lit(scale.vendors) + F.col("vendor_id")).alias(
            "product_id"
        ),
        (drawn(3, scale.customers) + 1).alias("customer_id"),
        F.date_add(F.lit(shape.start), drawn(4, shape.days).cast("int")).alias("sale_date"),
        "quantity",
        from_cents(F.col("_unit_cents")).alias("unit_price"),
        from_cents(F.col("_unit_cents") * F.col("quantity")).alias("sale_amount"),
        *payloads,
    )


def by_vendor(shape: SalesShape, partitions: int) -> Exchange:
    """Write layout by vendor with the hot vendor spread in proportion to its share."""
    return salted(
        "vendor_id",
        hot=F.col("vendor_id") == shape.hot_vendor,
        spread_by=F.col("sale_id"),
        salts=max(1, round(shape.hot_share * partitions)),
        partitions=partitions,
    )


def generate_tables(
    spark: SparkSession, scale: Scale, shape: SalesShape = SalesShape(), algorithm: str = XXHASH64
) -> dict[str, DataFrame]:
    """All four tables of a scale given in numbers."""
    counts = scale.row_counts()

    def numbers(table: str) -> DataFrame:
        return ids(spark, 1, counts[table], min(scale.partitions, counts[table]))

    return {
        "vendors": generate_vendors(numbers("vendors")),
        "products": generate_products(numbers("products"), scale.vendors),
        "customers": generate_customers(numbers("customers")),
        "sales": generate_sales(numbers("sales"), scale, shape, algorithm).transform(
            by_vendor(shape, scale.partitions)
        ),
    }
