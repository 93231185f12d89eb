"""Task statistics: golden inputs, fallbacks and ties."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import taskstats as ts
from millrace.plans.observability import diagnose_skew, diagnose_starvation


def tasks(spark, rows):
    return spark.createDataFrame(
        rows,
        "run string, stageId long, index long, duration long, executorRunTime long,"
        "shuffleRecordsRead long, shuffleTotalBytesRead long, recordsWritten long",
    )


def skewed_rows(stage=3, run="a"):
    """27 tasks: duration p75 3000 and max 30000, bytes p75 8192 and max 822272."""
    rows = [(run, stage, i, 3000, 2900, 10, 8192, 1) for i in range(26)]
    return rows + [(run, stage, 26, 30000, 29000, 900, 822272, 1)]


def even_rows(stage, count=8, run="a", duration=100):
    return [(run, stage, i, duration, 90, 10, 4096, 1) for i in range(count)]


def test_skewed_stage(spark):
    df = tasks(spark, skewed_rows() + even_rows(1) + even_rows(2))
    row = ts.skewed_stage(df, ["run"]).first()
    assert (row.stageId, row.taskCount) == (3, 27)
    assert (row.durationMaxToP75, row.dataMaxToP75) == (10.0, 100.375)
    assert (row.skewSignal, row.dataMetric) == ("strong skew signal", "shuffleTotalBytesRead")
    assert ts.skewed_stage(df.drop("run"), []).first().stageId == 3


def test_small_stages_are_ignored(spark):
    rows = [("a", 9, i, 10**i, 1, 1, 10**i, 1) for i in range(3)] + even_rows(1)
    assert ts.skewed_stage(tasks(spark, rows), ["run"]).first().stageId == 1
    assert ts.stage_stats(tasks(spark, rows[:3]), ["run"], "duration").isEmpty()


def test_without_shuffle_the_duration_decides(spark):
    slow = [("a", 5, i, 100 if i else 900, 90, 0, 0, 1) for i in range(8)]
    idle = [("a", 4, i, 100, 90, 0, 0, 1) for i in range(8)]
    df = tasks(spark, slow + idle)
    assert ts.skewed_stage(df, ["run"]).first().stageId == 5
    assert ts.skewed_stage(df.drop("shuffleTotalBytesRead"), ["run"]).first().dataMetric == "duration"


def test_one_stage_per_run(spark):
    df = tasks(spark, skewed_rows(3, "a") + even_rows(1, run="a") + even_rows(1, run="b"))
    found = {r.run: r.stageId for r in ts.skewed_stage(df, ["run"]).collect()}
    assert found == {"a": 3, "b": 1}


def starved(stage, empty, count, run="a"):
    return [(run, stage, i, 50, 40, 0 if i < empty else 7, 0, 0) for i in range(count)]


def test_starved_stage_prefers_the_expected_size(spark):
    df = tasks(spark, starved(1, 4, 10) + starved(2, 6, 20))
    assert ts.starved_stage(df, ["run"]).first().stageId == 2
    assert ts.starved_stage(df, ["run"], preferred_task_count=10).first().stageId == 1
    assert ts.starved_stage(df, ["run"], preferred_task_count=99).first().stageId == 2


def test_empty_tasks_give_the_sentinel_ratio(spark):
    row = ts.starved_stage(tasks(spark, starved(1, 4, 10)), ["run"]).first()
    assert (row.emptyTaskCount, row.minData, row.dataMedianToMin) == (4, 0.0, 999999.0)


def test_without_empty_tasks_the_duration_tail_decides(spark):
    mixed = [("a", 2, i, 10 if i else 1, 9, 5, 0, 0) for i in range(8)]
    df = tasks(spark, even_rows(1) + mixed)
    assert ts.starved_stage(df, ["run"]).first().stageId == 2
    assert ts.starved_stage(df, ["run"], preferred_task_count=8).first().stageId == 2


def test_percentiles_skip_unknown_values_but_extremes_count_them_as_zero(spark):
    rows = [("a", 1, i, 10, 9, None if i == 0 else i, 0, 0) for i in range(8)]
    row = ts.metric_summary(tasks(spark, rows), ["run"]).where("metric = 'shuffleRecordsRead'").first()
    assert (row.min, row.median, row.max, row.zeroTaskCount) == (0.0, 4.0, 7.0, 1)


@pytest.mark.parametrize(
    ("columns", "metric"),
    [
        (["shuffleRecordsRead", "recordsWritten"], "shuffleRecordsRead"),
        (["recordsRead", "recordsWritten"], "recordsWritten"),
        (["recordsRead", "duration"], "recordsRead"),
        (["duration"], "duration"),
    ],
)
def test_low_end_metric(spark, columns, metric):
    df = spark.range(1).select(*[F.lit(0).alias(name) for name in columns])
    assert ts.low_end_metric(df) == metric


def test_slowest_tasks_leave_out_idle_writers(spark):
    rows = [("a", 1, i, 10 * i, 9 * i, 0, 0, 0 if i == 9 else 1) for i in range(10)]
    found = ts.slowest_tasks(tasks(spark, rows), ["run"], 3).orderBy("outlier_rank").collect()
    assert [r["index"] for r in found] == [8, 7, 6]
    free = tasks(spark, rows).drop("recordsWritten")
    assert ts.slowest_tasks(free, ["run"], 1).first()["index"] == 9


def test_diagnoses(spark):
    df = tasks(spark, skewed_rows() + starved(1, 4, 10))
    skew = diagnose_skew(df, ["run"])
    assert skew["outliers"].orderBy("outlier_rank").first()["index"] == 26
    assert skew["outliers"].count() == 5
    assert "bytesRead" not in {r.metric for r in skew["summaries"].collect()}
    low = diagnose_starvation(df, ["run"], 10)
    assert {r["index"] for r in low["outliers"].collect()} == {0, 1, 2, 3, 4}
    assert {r.stageId for r in low["summaries"].collect()} == {1}
