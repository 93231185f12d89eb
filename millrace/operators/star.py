"""Left lookups of dimension attributes and foreign-key checks."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.labels import or_no_category, or_unknown


def lookup(
    fact: DataFrame,
    dimension: DataFrame,
    keys: list[str],
    strategy: str | None = None,
    **attributes: Column,
) -> DataFrame:
    """Left join that adds only the named attributes.

    Without a strategy Catalyst broadcasts a dimension whose size is under the session
    threshold and otherwise shuffles, where AQE splits hot keys. A join hint such as
    ``merge`` forces the shuffle for a study.
    """
    wanted = dimension.select(*keys, *[value.alias(name) for name, value in attributes.items()])
    return fact.join(wanted.hint(strategy) if strategy else wanted, on=keys, how="left")


def product_keys(products: DataFrame) -> list[str]:
    """The composite key, or the product alone where products have no vendor."""
    return [name for name in ("product_id", "vendor_id") if name in products.columns]


def add_vendor_region(fact: DataFrame, vendors: DataFrame, name: str = "vendor_region") -> DataFrame:
    return lookup(fact, vendors, ["vendor_id"], **{name: F.col("region")})


def add_category(fact: DataFrame, products: DataFrame) -> DataFrame:
    return lookup(fact, products, product_keys(products), category_id=F.col("category_id").cast("long"))


def add_star(
    fact: DataFrame, vendors: DataFrame, products: DataFrame, customers: DataFrame
) -> DataFrame:
    """Three dimensions. Missing attributes are filled on the dimension side, so
    a sale without a matching dimension row keeps nulls."""
    with_vendor = lookup(fact, vendors, ["vendor_id"], vendor_region=or_unknown(F.col("region")))
    with_product = lookup(
        with_vendor, products, product_keys(products), category_id=or_no_category(F.col("category_id"))
    )
    return lookup(
        with_product, customers, ["customer_id"], customer_region=or_unknown(F.col("region"))
    )


def orphan_rows(fact: DataFrame, dimension: DataFrame, keys: list[str]) -> DataFrame:
    """One row with the number of fact rows whose key has no match; a null key
    has none. The fact is counted per key first, so a hot key is one row in
    the join."""
    per_key = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return per_key.join(dimension.select(*keys), on=keys, how="left_anti").agg(
        F.coalesce(F.sum("rows"), F.lit(0).cast("long")).alias("violations")
    )


RELATIONSHIPS = ("vendor", "product", "customer")


def fk_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Orphan counts of sales against its three dimensions, one row per relationship.

    Sales are read once: each row gives its three keys, which are counted before they
    are shuffled, and the counts meet all dimension keys in one join.
    """
    has_composite = "vendor_id" in tables["products"].columns
    second = F.col("vendor_id").cast("long") if has_composite else F.lit(0).cast("long")
    unused = F.lit(0).cast("long")

    def key(relationship: str, first: str, other: Column) -> Column:
        return F.struct(
            F.lit(relationship).alias("relationship"),
            F.col(first).cast("long").alias("k1"),
            other.alias("k2"),
        )

    keys = {
        "vendor": key("vendor", "vendor_id", unused),
        "product": key("product", "product_id", second),
        "customer": key("customer", "customer_id", unused),
    }
    counted = (
        tables["sales"]
        .select(F.inline(F.array(*keys.values())))
        .groupBy("relationship", "k1", "k2")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known = [
        tables[f"{name}s"].select(keys[name].alias("key")).select("key.*") for name in RELATIONSHIPS
    ]
    marked = reduce(DataFrame.unionByName, known).withColumn("found", F.lit(True))
    met = counted.join(marked, ["relationship", "k1", "k2"], "left")

    def orphans(name: str) -> Column:
        missing = (F.col("relationship") == name) & F.col("found").isNull()
        return F.coalesce(F.sum(F.when(missing, F.col("rows"))), F.lit(0).cast("long")).alias(name)

    return met.agg(*[orphans(name) for name in RELATIONSHIPS]).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("relationship"), F.col(name).alias("violations"))
                    for name in RELATIONSHIPS
                ]
            )
        )
    )
