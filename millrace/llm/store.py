"""Tables and files in the folder that driver and executors share."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parent.parent
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Sends the package to Python workers, which needn't have it on their path."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        target = Path(tempfile.mkdtemp(prefix="millrace-")) / PACKAGE.name
        context.addPyFile(
            shutil.make_archive(str(target), "zip", PACKAGE.parent, PACKAGE.name)
        )
        _shipped.add(context.applicationId)
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below spark.checkpoint.dir.

    Only a local session without that setting, as in tests, gets a local folder; executors
    elsewhere could not see one, so a cluster without the setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or "cluster" in master:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes the rows once and reads them back, so that later steps start from a table.

    Shuffle files of the write go when it ends; else they would stay on the executors' disks
    until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)
