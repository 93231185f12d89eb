"""Named tables on storage: where, in which format, written how."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

FORMATS = ("parquet", "json", "orc", "delta")


@dataclass(frozen=True)
class Artifact:
    """``merge_schema`` reads files of several schema versions as one table."""

    path: str
    format: str = "parquet"
    mode: str = "errorifexists"
    options: Mapping[str, str | bool | int] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    merge_schema: bool = False

    def __post_init__(self) -> None:
        if self.format not in FORMATS:
            raise ValueError(f"unsupported format {self.format!r}, expected one of {FORMATS}")
        if not self.path:
            raise ValueError("an artifact needs a path")


def read_artifact(
    spark: SparkSession, artifact: Artifact, schema: StructType | str | None = None
) -> DataFrame:
    reader = spark.read.format(artifact.format).options(**artifact.options)
    if artifact.merge_schema:
        reader = reader.option("mergeSchema", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(artifact.path)


def read_or_empty(spark: SparkSession, artifact: Artifact, schema: StructType | str) -> DataFrame:
    """The table, or no rows of the given schema when nothing was written yet."""
    try:
        return read_artifact(spark, artifact, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_artifact(
    df: DataFrame,
    artifact: Artifact,
    max_records_per_file: int | None = None,
    replace_partitions: bool = False,
    rebalance: bool = False,
) -> None:
    """``replace_partitions`` overwrites only the partitions met in ``df``, so a
    rerun of the same dates does not double them. ``rebalance`` moves rows to their
    partitions first: small ones share a task, and a large one is split into tasks, and
    so files, of about ``spark.sql.adaptive.advisoryPartitionSizeInBytes``."""
    if rebalance:
        df = df.hint("rebalance", *artifact.partition_by)
    writer = df.write.format(artifact.format).mode(artifact.mode).options(**artifact.options)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if replace_partitions:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if artifact.partition_by:
        writer = writer.partitionBy(*artifact.partition_by)
    writer.save(artifact.path)


def drop_partitions(
    spark: SparkSession, artifact: Artifact, column: str, values: list[str]
) -> None:
    """Removes the partition folders of the given values where they exist."""
    context = spark.sparkContext
    for value in values:
        folder = context._jvm.org.apache.hadoop.fs.Path(f"{artifact.path}/{column}={value}")
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def run_output(base: str) -> Artifact:
    """Outputs of benchmark runs: one table partitioned by run identity. Refuses to
    write over an existing run when the run's own partition path is used."""
    return Artifact(
        base, mode="append", partition_by=("benchmark_id", "mode", "iteration", "run_id")
    )


def single_run_output(base: str, benchmark_id: str, mode: str, iteration: int, run_id: str) -> Artifact:
    """The partition folder of one run. ``errorifexists`` refuses a second write."""
    return Artifact(
        f"{base.rstrip('/')}/benchmark_id={benchmark_id}/mode={mode}"
        f"/iteration={iteration}/run_id={run_id}"
    )
