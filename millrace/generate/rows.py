"""Row sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.layout import session_partitions

# Fixed value: rows one generating step handles.
ROWS_PER_CHUNK = 250_000
#: Chunks that are listed at a time, so that no list grows with a day's rows.
CHUNKS_PER_BLOCK = 4096


def ids(spark: SparkSession, first: int, count: int, partitions: int) -> DataFrame:
    """Consecutive ids when the number of rows is known up front."""
    return spark.range(first, first + count, 1, numPartitions=partitions)


def expand_rows(
    volumes: DataFrame,
    rows: Column,
    name: str = "id",
    first: int = 0,
    chunk: int = ROWS_PER_CHUNK,
    partitions: int | None = None,
) -> DataFrame:
    """Each input row becomes ``rows`` output rows numbered from ``first``.

    The numbers are cut into blocks of chunks, the chunks are spread over the cluster and
    each task counts through its own. The partition count is explicit because the
    chunk rows are tiny and AQE would put them all into one task.
    """
    parts = partitions or session_partitions(volumes)
    size = F.lit(chunk).cast("long")
    last_chunk = F.call_function("div", rows.cast("long") - 1, size)
    block = F.lit(CHUNKS_PER_BLOCK).cast("long")
    last_block = F.call_function("div", last_chunk, block)
    first_chunk = F.col("_block") * block
    chunks = (
        volumes.withColumn("_rows", rows.cast("long"))
        .where(F.col("_rows") > 0)
        .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), last_block)))
        .withColumn(
            "_chunk",
            F.explode(F.sequence(first_chunk, F.least(first_chunk + block - 1, last_chunk))),
        )
        .drop("_block")
        .repartition(parts)
    )
    offset = F.lit(first).cast("long")
    start = F.col("_chunk") * size
    end = F.least(start + size, F.col("_rows")) - 1
    return chunks.withColumn(name, F.explode(F.sequence(start + offset, end + offset))).drop(
        "_rows", "_chunk"
    )
