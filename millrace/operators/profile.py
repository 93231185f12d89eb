"""Source profiles and acceptance checks."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.aggregates import key_rows_share


def _all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table in one query."""
    return _all(
        [
            df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
            for name, df in tables.items()
        ]
    )


def source_profile(tables: Mapping[str, DataFrame], files: DataFrame | None = None) -> DataFrame:
    """Rows and columns per table, with file statistics where given."""
    widths = F.create_map(
        *[item for name, df in tables.items() for item in (F.lit(name), F.lit(len(df.columns)))]
    )
    profile = row_counts(tables).withColumn("columns", widths[F.col("table_name")])
    return profile if files is None else profile.join(files, "table_name", "left")


def has_rows(df: DataFrame) -> bool:
    """Existence test; reads no more than one row."""
    return not df.limit(1).isEmpty()


def sample_rows(df: DataFrame, n: int = 10) -> DataFrame:
    """Any n rows, for a look at a table."""
    return df.limit(n)


def inventory_gate(profile: DataFrame, violations: DataFrame) -> DataFrame:
    """One row: no table is empty and no relationship is broken."""
    facts = profile.select(
        F.when(F.col("rows") <= 0, F.col("table_name")).alias("empty_table"),
        F.lit(None).cast("string").alias("broken_relationship"),
    ).unionByName(
        violations.select(
            F.lit(None).cast("string").alias("empty_table"),
            F.when(F.col("violations") != 0, F.col("relationship")).alias("broken_relationship"),
        )
    )
    return facts.agg(
        F.concat_ws(",", F.sort_array(F.collect_list("empty_table"))).alias("empty_tables"),
        F.concat_ws(",", F.sort_array(F.collect_list("broken_relationship"))).alias(
            "broken_relationships"
        ),
    ).withColumn("passed", (F.col("empty_tables") == "") & (F.col("broken_relationships") == ""))


def generation_checks(
    tables: Mapping[str, DataFrame],
    expected_rows: Mapping[str, int],
    violations: DataFrame,
    hot_vendor: int,
    hot_share: float,
    tolerance: float,
    files: DataFrame | None = None,
) -> DataFrame:
    """One row per check of generated tables: exact row counts, foreign keys, the hot
    vendor's share and at least one sales file."""
    expected = F.create_map(
        *[item for name, rows in expected_rows.items() for item in (F.lit(name), F.lit(rows))]
    )
    counts = row_counts(tables).select(
        F.concat(F.lit("rows:"), "table_name").alias("check"),
        expected[F.col("table_name")].cast("double").alias("expected"),
        F.col("rows").cast("double").alias("actual"),
        F.lit(0.0).alias("tolerance"),
    )
    orphans = violations.select(
        F.concat(F.lit("orphans:"), "relationship").alias("check"),
        F.lit(0.0).alias("expected"),
        F.col("violations").cast("double").alias("actual"),
        F.lit(0.0).alias("tolerance"),
    )
    share = key_rows_share(tables["sales"], "vendor_id", hot_vendor).select(
        F.lit("hot_vendor_share").alias("check"),
        F.lit(hot_share).alias("expected"),
        F.col("hot_share").alias("actual"),
        F.lit(tolerance).alias("tolerance"),
    )
    checks = [counts, orphans, share]
    if files is not None:
        checks.append(
            files.where(F.col("table_name") == "sales").select(
                F.lit("sales_has_files").alias("check"),
                F.lit(1.0).alias("expected"),
                F.least(F.col("file_count"), F.lit(1)).cast("double").alias("actual"),
                F.lit(0.0).alias("tolerance"),
            )
        )
    return _all(checks).withColumn(
        "passed", F.abs(F.col("actual") - F.col("expected")) <= F.col("tolerance")
    )
