"""Task and stage metrics from Spark event logs.

Write the logs with ``spark.eventLog.compress=false`` and read them after the
application ended. Both single-file and rolling logs work.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

# Fixed value: the fields used, out of the many an event carries.
EVENT_SCHEMA = """
    `Event` string,
    `App ID` string,
    `Job ID` long,
    `Stage IDs` array<long>,
    `Stage ID` long,
    `Stage Attempt ID` long,
    `Properties` struct<`spark.jobGroup.id`: string, `spark.job.description`: string>,
    `Stage Info` struct<`Stage ID`: long, `Stage Attempt ID`: long, `Number of Tasks`: long>,
    `Task Info` struct<
        `Task ID`: long, `Index`: long, `Attempt`: long, `Launch Time`: long, `Finish Time`: long,
        `Executor ID`: string, `Host`: string, `Failed`: boolean, `Killed`: boolean>,
    `Task Metrics` struct<
        `Executor Run Time`: long, `JVM GC Time`: long,
        `Memory Bytes Spilled`: long, `Disk Bytes Spilled`: long,
        `Input Metrics`: struct<`Bytes Read`: long, `Records Read`: long>,
        `Output Metrics`: struct<`Records Written`: long>,
        `Shuffle Read Metrics`: struct<
            `Remote Bytes Read`: long, `Local Bytes Read`: long, `Total Records Read`: long>,
        `Shuffle Write Metrics`: struct<`Shuffle Bytes Written`: long>>
"""
TASK_END = "SparkListenerTaskEnd"
STAGE_COMPLETED = "SparkListenerStageCompleted"
JOB_START = "SparkListenerJobStart"
APPLICATION_START = "SparkListenerApplicationStart"


def read_event_logs(spark: SparkSession, path: str) -> DataFrame:
    """Parsed events of all logs under a path. ``log`` names the application: the
    file, or the folder of a rolling log. The schema is given, not inferred."""
    folder = F.regexp_extract("_metadata.file_path", r"/(eventlog_v2_[^/]+)/[^/]*$", 1)
    return (
        spark.read.schema(EVENT_SCHEMA)
        .option("recursiveFileLookup", True)
        .json(path)
        .withColumn("log", F.when(folder != "", folder).otherwise(F.col("_metadata.file_name")))
        .where(F.col("Event").isin(TASK_END, STAGE_COMPLETED, JOB_START, APPLICATION_START))
    )


def parse_events(lines: DataFrame, log: Column) -> DataFrame:
    """The same events from a ``value`` column of JSON lines. ``inline`` keeps the parsed
    struct in one place; as a plain column every field read would parse again."""
    return lines.select(
        F.inline(F.array(F.from_json("value", EVENT_SCHEMA))), log.alias("log")
    )


def _field(*path: str) -> Column:
    return F.col(".".join(f"`{name}`" for name in path))


def _task_counters() -> dict[str, Column]:
    """The counters of a finished task by their names."""
    metrics = "Task Metrics"
    read, wrote = "Shuffle Read Metrics", "Shuffle Write Metrics"
    return {
        "executorRunTime": _field(metrics, "Executor Run Time"),
        "jvmGCTime": _field(metrics, "JVM GC Time"),
        "recordsRead": _field(metrics, "Input Metrics", "Records Read"),
        "bytesRead": _field(metrics, "Input Metrics", "Bytes Read"),
        "recordsWritten": _field(metrics, "Output Metrics", "Records Written"),
        "shuffleRecordsRead": _field(metrics, read, "Total Records Read"),
        "shuffleTotalBytesRead": _field(metrics, read, "Local Bytes Read")
        + _field(metrics, read, "Remote Bytes Read"),
        "shuffleBytesWritten": _field(metrics, wrote, "Shuffle Bytes Written"),
        "memoryBytesSpilled": _field(metrics, "Memory Bytes Spilled"),
        "diskBytesSpilled": _field(metrics, "Disk Bytes Spilled"),
    }


def task_metrics(events: DataFrame) -> DataFrame:
    """One row per finished task."""
    info = "Task Info"
    columns = {
        "stageId": _field("Stage ID"),
        "stageAttempt": _field("Stage Attempt ID"),
        "taskId": _field(info, "Task ID"),
        "index": _field(info, "Index"),
        "executorId": _field(info, "Executor ID"),
        "host": _field(info, "Host"),
        "successful": ~(_field(info, "Failed") | _field(info, "Killed")),
        "duration": _field(info, "Finish Time") - _field(info, "Launch Time"),
    }
    return events.where(F.col("Event") == TASK_END).select(
        "log", *[value.alias(name) for name, value in (columns | _task_counters()).items()]
    )


def stage_steps(events: DataFrame) -> DataFrame:
    """The named step of each stage. A reused stage is listed by several jobs and
    belongs to the first of them."""
    listed = events.where(F.col("Event") == JOB_START).select(
        "log",
        F.explode("Stage IDs").alias("stageId"),
        F.struct(
            _field("Job ID").alias("jobId"),
            _field("Properties", "spark.jobGroup.id").alias("step"),
            _field("Properties", "spark.job.description").alias("description"),
        ).alias("job"),
    )
    return listed.groupBy("log", "stageId").agg(F.min("job").alias("job")).select(
        "log", "stageId", "job.step", "job.description"
    )


def tasks_by_step(events: DataFrame) -> DataFrame:
    return task_metrics(events).join(stage_steps(events), ["log", "stageId"], "left")


# Fixed value: the counters that are summed over a stage's finished tasks.
SUMMED = (
    "executorRunTime",
    "jvmGCTime",
    "recordsRead",
    "bytesRead",
    "recordsWritten",
    "shuffleTotalBytesRead",
    "shuffleBytesWritten",
    "memoryBytesSpilled",
    "diskBytesSpilled",
)


def stage_states(events: DataFrame) -> DataFrame:
    """One row per application and stage, from one scan of the events: the first job that
    lists it (``job``), how often it completed, its tasks, and the sums over finished tasks.

    Events of four kinds fold into the same state. A job start becomes a row for each stage
    it lists; the start of the application, which alone has its id, is a row without a stage
    and hands the id to the log's other rows once they are summed up. Logs without that event
    keep the log's name. Tasks are added up before anything is shuffled, so a stage of very
    many tasks is one row a reading task.
    """

    def of(kind: str, value: Column) -> Column:
        return F.when(F.col("Event") == kind, value)

    job = F.struct(
        _field("Job ID").alias("jobId"),
        _field("Properties", "spark.jobGroup.id").alias("step"),
        _field("Properties", "spark.job.description").alias("description"),
    )
    stages = F.coalesce(
        of(TASK_END, F.array("Stage ID")),
        of(STAGE_COMPLETED, F.array(_field("Stage Info", "Stage ID"))),
        of(JOB_START, F.col("`Stage IDs`")),
        of(APPLICATION_START, F.array(F.lit(None).cast("long"))),
    )
    counters = _task_counters()
    flat = events.select(
        "log",
        "Event",
        F.explode(stages).alias("stageId"),
        of(JOB_START, job).alias("job"),
        of(STAGE_COMPLETED, _field("Stage Info", "Number of Tasks")).alias("tasks"),
        of(APPLICATION_START, _field("App ID")).alias("id"),
        *[of(TASK_END, counters[name]).alias(name) for name in SUMMED],
    )
    states = flat.groupBy("log", "stageId").agg(
        F.min("job").alias("job"),
        F.count_if(F.col("Event") == STAGE_COMPLETED).alias("numStages"),
        F.sum("tasks").alias("numTasks"),
        F.max("id").alias("id"),
        *[F.sum(name).alias(name) for name in SUMMED],
    )
    same_log = Window.partitionBy("log")
    return (
        states.withColumn("application", F.coalesce(F.max("id").over(same_log), "log"))
        .where(F.col("stageId").isNotNull())
        .drop("id")
    )


def stage_aggregate(events: DataFrame) -> DataFrame:
    """Run-level counters per application and step: completed stages and their tasks, times
    and bytes summed over the finished tasks. ``log`` is the application's id, or the log's
    name where the log does not tell it."""
    done = stage_states(events).where(F.col("numStages") > 0)
    return done.groupBy(F.col("application").alias("log"), F.col("job.step").alias("step")).agg(
        *[F.sum(name).alias(name) for name in ("numStages", "numTasks", *SUMMED)]
    )


@contextmanager
def job_step(spark: SparkSession, step: str, description: str | None = None) -> Iterator[None]:
    """Labels the Spark jobs started inside, so that their stages can be told apart
    later. The label is removed at the end."""
    context = spark.sparkContext
    context.setJobGroup(step, description or step)
    try:
        yield
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)
        context.setLocalProperty("spark.job.interruptOnCancel", None)
