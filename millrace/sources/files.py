"""Physical file statistics."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def byte_size(text: str) -> int:
    """A size as Spark writes it, such as 64MB, 67108864b or 64m, in bytes."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgt]?)i?b?\s*", text.lower()).groups()
    return int(number) << 10 * " kmgt".index(unit or " ")


def file_sizes(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """One row per data file. Only the listing is read, not the content."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", F.col("length").alias("file_bytes"))
    )


def file_stats(sizes: DataFrame) -> DataFrame:
    """Count, total, smallest, average and largest size; zeros without files."""
    return sizes.agg(
        F.count("file_bytes").alias("file_count"),
        *[
            F.coalesce(measure("file_bytes"), F.lit(0)).cast("long").alias(f"{name}_bytes")
            for name, measure in (("total", F.sum), ("min_file", F.min), ("max_file", F.max))
        ],
        F.coalesce(F.avg("file_bytes"), F.lit(0.0)).alias("avg_file_bytes"),
    )


def table_file_stats(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """File statistics of several tables, one row each."""
    frames = [
        file_stats(file_sizes(spark, path)).select(F.lit(name).alias("table_name"), "*")
        for name, path in paths.items()
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def scanned_files(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Rows, files and bytes of several tables from the scan itself: every row knows its
    file, so one pass without columns counts rows per file and reads the size once a file.
    A file without rows does not show up."""
    result = None
    for name, path in paths.items():
        files = (
            spark.read.parquet(path)
            .groupBy("_metadata.file_path")
            .agg(F.count(F.lit(1)).alias("rows"), F.max("_metadata.file_size").alias("bytes"))
        )
        facts = files.agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
            F.count(F.lit(1)).alias("file_count"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"),
        ).select(F.lit(name).alias("table_name"), "*")
        result = facts if result is None else result.unionByName(facts)
    return result
