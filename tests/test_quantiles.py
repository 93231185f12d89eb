"""Exact quantiles against sorting."""

import random

from pyspark.sql import functions as F

from millrace.operators import taskstats
from millrace.operators.quantiles import exact_quantiles

SHARES = {"low": 0, "p25": 250, "median": 500, "p95": 950, "p999": 999, "high": 1000}


def by_sorting(values):
    values = sorted(values)
    return tuple(values[max(1, -(-len(values) * s // 1000)) - 1] for s in SHARES.values())


def test_against_sorting(spark):
    rng = random.Random(5)
    spread = {
        "a": lambda: rng.randint(-(1 << 63), (1 << 63) - 1),
        "b": lambda: rng.randint(-3, 3),
        "c": lambda: rng.randint(10**9, 10**9 + 10**5),
        None: lambda: int(rng.expovariate(1e-6)),
        "one": lambda: 7,
    }
    rows = [(key, draw()) for key, draw in spread.items() for _ in range(rng.randint(150, 400))]
    rows += [("two", -1), ("two", 1), ("b", None), ("none", None)]
    df = spark.createDataFrame(rows, "name string, v long")
    found = exact_quantiles(df, ["name"], "v", SHARES)
    assert found.columns == ["name", *SHARES]
    expected = {
        key: by_sorting([v for k, v in rows if k == key and v is not None])
        for key in [*spread, "two"]
    }
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == expected
    assert exact_quantiles(df.limit(0), ["name"], "v", SHARES).count() == 0


def test_one_group_with_many_values(spark):
    rows = spark.range(300_000).select(
        F.lit("hot").alias("name"), ((F.col("id") * 7919) % 300_000 * 1000).alias("v")
    )
    row = exact_quantiles(rows, ["name"], "v", {"median": 500, "p99": 990}).first()
    assert (row.median, row.p99) == (149_999_000, 296_999_000)


def test_summary_of_large_and_small_stages(spark):
    large = spark.range(100_000).select(
        F.lit("a").alias("run"),
        F.lit(1).cast("long").alias("stageId"),
        (F.col("id") + 1).alias("duration"),
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("recordsRead"),
    )
    small = spark.createDataFrame(
        [("a", 2, 5, None), ("a", 2, 9, None), (None, 3, 1, 1)],
        "run string, stageId long, duration long, recordsRead long",
    )
    found = taskstats.exact_metric_summary(large.union(small), ["run"]).collect()
    found = {(r.run, r.stageId, r.metric): r for r in found}
    assert len(found) == 6
    r = found["a", 1, "duration"]
    assert (r.taskCount, r.eligible, r.min, r.p25, r.median) == (100_000, True, 1, 25_000, 50_000)
    assert (r.p75, r.p95, r.max, r.zeroTaskCount) == (75_000, 95_000, 100_000, 0)
    # Quantiles pass over unknown values, extremes count them as no work.
    r = found["a", 1, "recordsRead"]
    assert (r.median, r.min, r.zeroTaskCount) == (49_998, 0, 50_001)
    r = found["a", 2, "recordsRead"]
    assert (r.eligible, r.median, r.max, r.zeroTaskCount) == (False, None, 0, 2)
    assert found[None, 3, "duration"].median == 1


def test_the_counts_are_shuffled_once(spark, folder, plan_of):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    found = exact_quantiles(lines, ["l_suppkey"], "l_partkey", {"median": 500})
    found.collect()
    plan = plan_of(found).split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange (") == 3
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_rows_are_grouped_and_joined_without_their_wanted_ranks(spark, plan_of):
    """Arrays and names in the keys of millions of groups took most of a task's memory."""
    df = spark.range(1000).select((F.col("id") % 7).alias("key"), F.col("id").alias("v"))
    plan = plan_of(exact_quantiles(df, ["key"], "v", {"median": 500, "p95": 950}))
    keys = [line for line in plan.splitlines() if line.startswith("Keys")]
    assert keys and not any("_ranks" in line for line in keys)
