"""Two-pass external shuffle into shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.store import cut

BUCKET_BYTES = 8 << 20
BUCKET_ROWS = 1024
#: Offsets of this many buckets, 16 bytes each, are sent to all tasks; more are joined by key.
OFFSETS_SENT = 200_000
#: Buckets whose offsets are summed up in one task.
BUCKETS_TOGETHER = 4096
#: Rows alike are numbered and scattered one by one from this many on, or from a share of a
#: bucket's bytes.
MANY_ALIKE = 64
#: Raw bytes of rows that a task of the first pass puts into buckets.
TASK_BYTES = 32 << 20


def fisher_yates(size: Column, seed: Column) -> Column:
    """A permutation of 0 to size - 1: from the last place down, each swaps with a seeded draw."""

    def swapped(places, i):
        j = F.pmod(F.xxhash64(seed, i), i + 1)
        ends = F.concat(
            F.slice(places, F.lit(1), j.cast("int")),
            F.slice(places, i + 1, F.lit(1)),
            F.slice(places, j.cast("int") + 2, i - j.cast("int") - 1),
            F.slice(places, j.cast("int") + 1, F.lit(1)),
            F.slice(places, i + 2, size),
        )
        return F.when(j < i, ends).otherwise(places)

    places = F.sequence(F.lit(0), size - 1)
    steps = F.when(size > 1, F.sequence(size - 1, F.lit(1), F.lit(-1))).otherwise(
        F.array().cast("array<int>")
    )
    return F.aggregate(steps, places, swapped)


def numbered(rows: DataFrame, alike: DataFrame) -> DataFrame:
    """rows (document, h) with `copy`: 0, but 0 to n - 1 for n equal rows with an h in alike.

    alike (h) holds the hashes of rows that many share. Such rows are counted by value, in each
    task first, and blocks of MANY_ALIKE numbers are dealt out before they become rows again,
    so that no task makes all copies of a row.
    """
    if alike.count() <= OFFSETS_SENT:
        alike = F.broadcast(alike)
    single = rows.join(alike, "h", "left_anti").withColumn("copy", F.lit(0).cast("long"))
    counted = rows.join(alike, "h", "left_semi").groupBy("h", "document")
    counted = counted.agg(F.count("*").alias("n"))
    last = F.floor((F.col("n") - 1) / MANY_ALIKE)
    blocks = counted.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    start = F.col("block") * MANY_ALIKE
    end = F.least(start + MANY_ALIKE, F.col("n")) - 1
    copies = blocks.repartition("h", "block").withColumn("copy", F.explode(F.sequence(start, end)))
    return single.unionByName(copies.select(*rows.columns, "copy"))


def shuffle(
    docs: DataFrame,
    shards: int = 40,
    seed: int = 7,
    bucket_bytes: int = BUCKET_BYTES,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """The columns of docs (with doc_id and text), and shard and slot of each row.

    First pass: each row goes to a bucket by a seeded hash of its columns, as many buckets as
    keep one within memory. So copies of a text, rows of a source and rows without a doc_id are
    scattered alike. Rows with the same hash are counted first; where they are many
    (MANY_ALIKE, or an eighth of a bucket's bytes), their number among equal rows is hashed
    too, so that they spread over all buckets. Second pass: each bucket is read, put in the
    order of its rows, Fisher-Yates shuffled with draws seeded by the bucket, and written, a
    row for each document, so that no page or batch of the files holds whole buckets. The
    buckets one after the other are the new order; its row p goes to shard p mod shards, slot
    p div shards. Row counts of shards differ by one at most, and slots have no gap.

    The result depends on the rows, the seed and the bucket sizes only. Null texts and ids are
    ordinary values, no rows give no rows. Only rows alike in all columns, and few of them,
    share a bucket for certain. A text larger than a bucket has the bucket to itself, more or
    less. Columns named shard or slot are replaced; others may have any name, but no maps.
    """
    docs = docs.drop("shard", "slot")
    names = [f"`{c}`" for c in docs.columns]
    keyed = docs.select(
        F.struct(*names).alias("document"),
        F.xxhash64(*names).alias("h"),
    )
    size = F.coalesce(F.octet_length("document.text"), F.lit(0)).cast("long")
    counts = cut(
        keyed.groupBy("h").agg(F.count("*").alias("n"), F.sum(size).alias("b")),
        "shuffle-counts",
    )
    total = counts.agg(F.sum("n").alias("n"), F.sum("b").alias("b")).first()
    n, held = total["n"] or 0, total["b"] or 0
    buckets = max(1, -(-n // bucket_rows), -(-held // bucket_bytes))
    many = (F.col("n") >= MANY_ALIKE) | ((F.col("n") > 1) & (F.col("b") > bucket_bytes // 8))
    alike = counts.where(many).select("h")
    if alike.isEmpty():
        rows = keyed.withColumn("copy", F.lit(0).cast("long"))
    else:
        rows = numbered(keyed, alike)
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, -(-held // TASK_BYTES))
    bucket = F.pmod(F.xxhash64(F.lit(seed), "h", "copy"), F.lit(buckets))
    scattered = rows.select(
        bucket.alias("bucket"),
        F.col("document.doc_id").alias("id"),
        F.xxhash64("document.text").alias("content"),
        "document",
    ).repartition(min(tasks, buckets), "bucket")
    inside = W.partitionBy("bucket")
    ordered = scattered.withColumns(
        {
            "from": F.row_number().over(inside.orderBy("id", "content", "document")) - 1,
            "n": F.count("*").over(inside).cast("int"),
        }
    )
    # The draws are made once a bucket, beside its first row, and shown to the others.
    drawn = F.when(
        F.col("from") == 0, fisher_yates(F.col("n"), F.xxhash64(F.lit(seed), "bucket"))
    )
    placed = ordered.withColumn("drawn", drawn).withColumn(
        "order", F.first("drawn", ignorenulls=True).over(inside)
    )
    place = F.array_position("order", F.col("from")) - 1
    written = cut(placed.select("bucket", "n", place.alias("place"), "document"), "shuffle-buckets")
    together = F.floor(F.col("bucket") / BUCKETS_TOGETHER)
    sizes = cut(written.where("place = 0").select("bucket", "n"), "shuffle-sizes")
    sizes = sizes.withColumn("range", together)
    ranges = sizes.groupBy("range").agg(F.sum("n").alias("n"))
    earlier = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.select("range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    before = W.partitionBy("range").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        sizes.withColumn("inner", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .join(ranges, "range")
        .select("bucket", (F.col("base") + F.col("inner")).alias("first"))
    )
    if buckets <= OFFSETS_SENT:
        offsets = F.broadcast(offsets)
    position = F.col("first") + F.col("place")
    mixed = written.join(offsets, "bucket").select("document", position.alias("position"))
    return mixed.select(
        "document.*",
        F.pmod("position", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("position") / shards).cast("long").alias("slot"),
    )


def write_shards(shuffled: DataFrame, folder: str) -> None:
    """One folder per shard; rows are sorted by slot inside each file."""
    (
        shuffled.repartition("shard", F.floor(F.col("slot") / BUCKET_ROWS))
        .sortWithinPartitions("shard", "slot")
        .write.mode("overwrite")
        .partitionBy("shard")
        .parquet(folder)
    )
