"""Tables in the shared folder."""

import time

from pyspark.sql import functions as F

from millrace.llm.store import cut

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def test_a_written_table_leaves_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for f in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}
    before, setting = files(), spark.conf.get(CLEAN_UP)
    rows = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).agg(F.count("*").alias("n"))
    cut(rows.orderBy("k"), "counted")
    for _ in range(100):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert spark.conf.get(CLEAN_UP) == setting
