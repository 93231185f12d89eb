"""Merged distinct counts, global ranks, stored history, folded event logs, sized writes."""

import json
import random
from collections import defaultdict
from datetime import date, datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from millrace.generate import rows as generated
from millrace.generate.volume import VolumePlan, volume_check
from millrace.operators import distinct, history, ranking
from millrace.plans import temporal
from millrace.sources import eventlog, files
from millrace.sources.artifacts import Artifact, read_artifact, write_artifact
from millrace.sources.scratch import scratch_folder


# --- distinct counts ----------------------------------------------------------------


def test_bitmap_counts_against_sets(spark):
    rng = random.Random(1)
    ids = [None, -1, 0, 32_767, 32_768, 10**12, -(10**9), *range(50)]
    rows = [
        (rng.choice(["a", "b", None]), rng.randint(0, 2), rng.choice(ids), rng.choice(ids)) for _ in range(2000)
    ]
    df = spark.createDataFrame(rows, "g string, h int, x long, y long")
    grains = {"fine": ("g", "h"), "g": ("g",), "all": ()}
    wanted = defaultdict(lambda: (set(), set()))
    for g, h, x, y in rows:
        for key in (("fine", g, h), ("g", g, None), ("all", None, None)):
            wanted[key][0].add(x)
            wanted[key][1].add(y)
    found = distinct.distinct_rollup(df, grains, ("x", "y")).collect()
    assert len(found) == len(wanted) == 9 + 3 + 1
    for r in found:
        x, y = wanted[r["grain"], r["g"], r["h"]]
        assert (r["x_count"], r["y_count"]) == (len(x - {None}), len(y - {None}))
        assert abs(r["x_estimate"] - r["x_count"]) <= 1


def test_bitmaps_of_parts_merge_to_those_of_the_whole(spark):
    df = spark.range(0, 100_000, 1, 7).selectExpr("id % 3 AS g", "id * 7 % 70001 AS x")
    parts = [distinct.id_bitmaps(df.where(f"x % 4 = {i}"), ["g"], ["x"]) for i in range(4)]
    merged = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    found = {r["g"]: r["x_count"] for r in distinct.merged_counts(merged, ["g"], ["x"]).collect()}
    assert found == {r["g"]: r["n"] for r in df.groupBy("g").agg(F.count_distinct("x").alias("n")).collect()}
    assert distinct.id_bitmaps(df.limit(0), ["g"], ["x"]).isEmpty()


def test_raw_rows_are_not_shuffled(spark, plan_of):
    df = spark.range(1000).selectExpr("id % 3 AS g", "id AS x")
    plan = plan_of(distinct.distinct_rollup(df, {"g": ("g",), "all": ()}, ("x",)))
    before = plan[: plan.index("Exchange")]
    assert "bitmap_construct_agg" in plan and "ObjectHashAggregate" in before or "partial" in plan


# --- global rank --------------------------------------------------------------------


def test_global_rank_over_many_tasks(spark, tmp_path):
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(5)]), rng.randint(0, 300), i) for i in range(5000)]
    rows += [(3, 7, -1)] * 3000  # a third of the rows are alike
    df = spark.createDataFrame(rows, "a int, b int, c int").repartition(6)
    ranked = ranking.global_rank(df, [F.desc("a"), F.asc("b"), F.asc("c")], Artifact(str(tmp_path / "r")))
    found = sorted(ranked.collect(), key=lambda r: r["global_rank"])
    assert [r["global_rank"] for r in found] == list(range(1, len(rows) + 1))
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1], r[2]))
    assert [tuple(r)[:3] for r in found] == order
    assert ranked.columns == ["a", "b", "c", "global_rank"]
    empty = ranking.global_rank(df.limit(0), [F.asc("a")], Artifact(str(tmp_path / "e")))
    assert empty.count() == 0


# --- stored history -----------------------------------------------------------------

RUNS = [
    ("r1", date(2026, 1, 1), 10.0, datetime(2026, 1, 5)),
    ("r1", date(2026, 1, 2), 20.0, datetime(2026, 1, 5)),
    ("r2", date(2026, 1, 1), 30.0, datetime(2026, 1, 6)),
    ("r3", date(2026, 1, 1), 40.0, datetime(2026, 1, 4)),
]


def test_a_run_that_is_appended_again_replaces_itself(spark, plan_of, tmp_path):
    rows = spark.createDataFrame(RUNS, "run_id string, processing_date date, records double, created_at timestamp")
    store = Artifact(str(tmp_path / "history"))
    for run in ("r1", "r2", "r3", "r1"):
        history.append_run(rows.where(F.col("run_id") == run), store)
    shorter = rows.where("run_id = 'r1' AND records < 15")
    history.append_run(shorter, store)
    stored = history.stored_history(spark, store, rows.schema, "runs_here")
    assert sorted((r["run_id"], r["records"]) for r in stored.collect()) == [("r1", 10.0), ("r2", 30.0), ("r3", 40.0)]
    latest = history.stored_latest_run(spark, "runs_here")
    assert [(r["run_id"], r["processing_date"]) for r in latest.collect()] == [("r2", date(2026, 1, 1))]
    assert "PartitionFilters: [isnotnull(run_id" in plan_of(latest)


# --- event logs ---------------------------------------------------------------------


def task(stage, ms, read):
    return {
        "Event": eventlog.TASK_END,
        "Stage ID": stage,
        "Stage Attempt ID": 0,
        "Task Info": {"Task ID": 1, "Failed": False, "Killed": False},
        "Task Metrics": {"Executor Run Time": ms, "Input Metrics": {"Records Read": read}},
    }


def completed(stage, tasks):
    return {"Event": eventlog.STAGE_COMPLETED, "Stage Info": {"Stage ID": stage, "Number of Tasks": tasks}}


def job(number, stages, step):
    return {"Event": eventlog.JOB_START, "Job ID": number, "Stage IDs": stages, "Properties": {"spark.jobGroup.id": step}}


def test_events_fold_into_stages_in_one_scan(spark, plan_of, tmp_path):
    named = {"Event": eventlog.APPLICATION_START, "App ID": "app-7"}
    lines = [named, job(1, [2, 3], "late"), job(0, [0, 1, 2], "early"), task(0, 5, 1), task(0, 6, None)]
    lines += [task(2, 7, 3), completed(0, 2), completed(2, 1), completed(2, 1), task(9, 1, 1)]
    lines += [{"Event": "SparkListenerBlockManagerAdded"}]
    (tmp_path / "a.log").write_text("\n".join(map(json.dumps, lines)))
    (tmp_path / "b.log").write_text("\n".join(map(json.dumps, [task(0, 100, 1), completed(0, 1)])))
    logged = eventlog.read_event_logs(spark, str(tmp_path))
    states = {(r["application"], r["stageId"]): r for r in eventlog.stage_states(logged).collect()}
    assert states["app-7", 0]["executorRunTime"] == 11 and states["app-7", 0]["recordsRead"] == 1
    assert states["app-7", 2]["job"]["step"] == "early" and states["app-7", 2]["numStages"] == 2
    assert states["app-7", 1]["numStages"] == 0 and states["app-7", 9]["job"] is None
    assert states["b.log", 0]["executorRunTime"] == 100
    found = {(r["log"], r["step"]): (r["numStages"], r["numTasks"], r["executorRunTime"]) for r in eventlog.stage_aggregate(logged).collect()}
    assert found == {("app-7", "early"): (3, 4, 18), ("b.log", None): (1, 1, 100)}
    assert plan_of(eventlog.stage_aggregate(logged)).count("Scan json") <= 2  # the node and its details


# --- sizes --------------------------------------------------------------------------


def test_a_huge_day_is_listed_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(generated, "CHUNKS_PER_BLOCK", 3)
    volumes = spark.createDataFrame([("a", 47), ("b", 1), ("c", 0), ("d", 6)], "d string, n long")
    found = generated.expand_rows(volumes, F.col("n"), first=5, chunk=2, partitions=3).collect()
    numbers = defaultdict(list)
    for r in found:
        numbers[r["d"]].append(r["id"])
    assert {d: sorted(n) for d, n in numbers.items()} == {
        "a": list(range(5, 52)), "b": [5], "d": list(range(5, 11))
    }


def test_an_appended_day_is_sized_by_its_own_rows(spark, tmp_path):
    day = date(2026, 1, 3)
    plan = VolumePlan(date(2026, 1, 1), date(2026, 1, 2), 100, {}, target_rows_per_partition=50)
    source = Artifact(str(tmp_path / "events"))
    temporal.generate_source(spark, plan, source)
    out = temporal.generate_source(spark, plan, source, temporal.APPEND_DAY, day, append_multiplier=2)
    assert out["check"].where("NOT matches").isEmpty()
    stored = read_artifact(spark, source, temporal.EVENT_SCHEMA).where(F.col("event_date") == F.lit(day))
    assert stored.count() == 200
    again = temporal.generate_source(spark, plan, source)
    assert again["audit"].where("write_status = 'generated'").isEmpty()


def test_checked_dates_prune_the_stored_events(spark, plan_of, tmp_path):
    events = spark.range(100).selectExpr("date_add(DATE '2026-01-01', CAST(id % 4 AS INT)) AS event_date", "id")
    store = Artifact(str(tmp_path / "events"), partition_by=("event_date",))
    write_artifact(events, store)
    days = [(date(2026, 1, 1), 25, 1), (date(2026, 1, 2), 24, 9), (date(2026, 1, 9), 0, 9)]
    planned = spark.createDataFrame(days, "event_date date, expected_rows long, volume_multiplier long")
    planned.write.parquet(str(tmp_path / "plan"))
    planned = spark.read.parquet(str(tmp_path / "plan")).where("volume_multiplier > 1")
    check = volume_check(planned, read_artifact(spark, store, events.schema))
    assert "dynamicpruning" in plan_of(check)
    found = {r["event_date"].day: (r["actual_rows"], r["matches"]) for r in check.collect()}
    assert found == {2: (25, False), 9: (0, True)}


def test_a_large_partition_is_written_in_several_files(spark, tmp_path):
    # Spark splits along the tasks rows come from; partitions enough keep vendors apart.
    wanted = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k", "spark.sql.shuffle.partitions": "64"}
    before = {key: spark.conf.get(key) for key in wanted}
    store = Artifact(str(tmp_path / "sales"), partition_by=("vendor",))
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        rows = spark.range(0, 60_000, 1, 24).selectExpr(
            "IF(id % 10 < 7, 'hot', concat('cold', id % 10)) AS vendor", "sha2(CAST(id AS STRING), 256) AS text"
        )
        write_artifact(rows, store, rebalance=True)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    sizes = files.file_sizes(spark, store.path).collect()
    by_vendor = defaultdict(list)
    for r in sizes:
        by_vendor[r["path"].split("vendor=")[1].split("/")[0]].append(r["file_bytes"])
    assert len(by_vendor["hot"]) > 4 and max(by_vendor["hot"]) < 2 * 256 * 1024
    assert max(len(v) for k, v in by_vendor.items() if k != "hot") < len(by_vendor["hot"])
    assert read_artifact(spark, store).count() == 60_000


def test_the_scan_tells_rows_files_and_bytes(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 90, 1, 3).write.parquet(path)
    (facts,) = files.scanned_files(spark, {"t": path}).collect()
    (listed,) = files.file_stats(files.file_sizes(spark, path)).collect()
    assert (facts["row_count"], facts["file_count"]) == (90, 3)
    assert facts["total_bytes"] == listed["total_bytes"]


@pytest.mark.parametrize(("text", "size"), [("64MB", 64 << 20), ("67108864b", 64 << 20), ("256k", 256 << 10), ("7", 7)])
def test_byte_sizes(text, size):
    assert files.byte_size(text) == size


def session(master, settings):
    conf = SimpleNamespace(get=settings.get, set=settings.__setitem__)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_scratch_folders_are_shared_or_refused():
    key = "spark.checkpoint.dir"
    for master in ("spark://cluster:1", "local-cluster[3,2,1000]"):
        with pytest.raises(ValueError, match="share"):
            scratch_folder(session(master, {}), "x")
        kept = session(master, {key: "hdfs://shared/checkpoints/"})
        assert scratch_folder(kept, "x").startswith("hdfs://shared/checkpoints/x-")
    local = {}
    assert scratch_folder(session("local[4]", local), "x").startswith(local[key])
