"""Compares partition layouts on generated sales with a hot vendor.

    python bench_layouts.py FOLDER [SCALE] [FACTOR] [JOB,JOB..]

Generates the tables of a scale (default xs: 5,000,000 sales, vendor 1 holds 70 %),
with FACTOR times the sales, under FOLDER unless they are there, runs each job with its own event log, and
prints one JSON line per job from those logs: tasks, summed executor time, shuffle
bytes, spill and the slowest task.
"""

from __future__ import annotations

import json
import subprocess
import sys
import tempfile
import time
from dataclasses import replace
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from millrace.generate.retail import SCALES  # noqa: E402
from millrace.operators import layout  # noqa: E402
from millrace.plans import inventory, retail  # noqa: E402
from millrace.sources import eventlog  # noqa: E402
from millrace.sources.artifacts import Artifact, read_artifact  # noqa: E402

TABLES = ("vendors", "products", "customers", "sales")


def jobs():
    """Job name and the function that builds it. Costly layouts sit next to the default."""
    hot_bucket = lambda: F.col("audit_bucket") == retail.SLOW_AUDIT_BUCKET
    return {
        "regional_round_robin": lambda t: retail.regional_monthly_sales(t, layout.round_robin(1024)),
        "regional_keyed": lambda t: retail.regional_monthly_sales(
            t, layout.keyed("vendor_region", "sale_month", partitions=32)
        ),
        "regional_default": retail.regional_monthly_sales,
        "drill_wide": lambda t: retail.payload_drill_wide(t, layout.round_robin(512)),
        "drill_default": retail.payload_drill,
        "vendor_copartitioned": lambda t: retail.vendor_summary_copartitioned(t, 27),
        "vendor_default": retail.vendor_summary,
        "audit_bucketed": lambda t: retail.audit_fingerprint(
            retail.sales_enriched(t), layout.keyed("audit_bucket", partitions=16)
        ),
        "audit_salted": lambda t: retail.audit_fingerprint(
            retail.sales_enriched(t),
            layout.salted(
                "audit_bucket", hot=hot_bucket(), spread_by=F.col("sale_id"), salts=8, partitions=64
            ),
        ),
        "audit_default": lambda t: retail.audit_fingerprint(retail.sales_enriched(t)),
        "star_by_bucket": lambda t: retail.ranked_star_summary(
            t, 2048, layout.keyed("bucket", partitions=384)
        ),
        "star_as_planned": lambda t: retail.ranked_star_summary(t, 2048, layout.as_planned),
        "star_default": lambda t: retail.ranked_star_summary(t, 2048),
        "business_candidate": lambda t: retail.business_output_candidate(
            t, layout.round_robin(192), layout.keyed("guardrail_bucket", partitions=192)
        ),
        "business_default": retail.business_output,
    }


def session(log_folder: str | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "32")
    )
    if log_folder:
        builder = (
            builder.config("spark.eventLog.enabled", "true")
            .config("spark.eventLog.dir", f"file:{log_folder}")
            .config("spark.eventLog.compress", "false")
            .config("spark.eventLog.rolling.enabled", "false")
        )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def targets(folder: str) -> dict[str, Artifact]:
    return {name: Artifact(f"{folder}/{name}", mode="overwrite") for name in TABLES}


def measure(folder: str, log_folder: str, wall_file: str, wanted: str) -> None:
    spark = session(log_folder)
    tables = {name: read_artifact(spark, target) for name, target in targets(folder).items()}
    wall = {}
    available = jobs()
    for name in wanted.split(",") if wanted else available:
        build = available[name]
        started = time.perf_counter()
        with eventlog.job_step(spark, name):
            build(tables).write.format("noop").mode("overwrite").save()
        wall[name] = round(time.perf_counter() - started, 3)
    Path(wall_file).write_text(json.dumps(wall))
    spark.stop()


def report(log_folder: str, wall_file: str) -> None:
    spark = session()
    logged = eventlog.read_event_logs(spark, log_folder)
    slowest = (
        eventlog.tasks_by_step(logged).groupBy("step").agg(F.max("executorRunTime").alias("slowest_task_ms"))
    )
    runs = eventlog.stage_aggregate(logged).join(slowest, "step").collect()
    by_step = {row.step: row for row in runs}
    for name, seconds in json.loads(Path(wall_file).read_text()).items():
        row = by_step[name]
        print(
            json.dumps(
                {
                    "job": name,
                    "wall_s": seconds,
                    "executor_s": round(row.executorRunTime / 1000, 1),
                    "stages": row.numStages,
                    "tasks": row.numTasks,
                    "shuffle_mib": round(row.shuffleBytesWritten / 2**20, 1),
                    "spill_mib": round((row.memoryBytesSpilled + row.diskBytesSpilled) / 2**20, 1),
                    "slowest_task_ms": row.slowest_task_ms,
                }
            ),
            flush=True,
        )
    spark.stop()


def main(folder: str, scale: str = "xs", factor: str = "1", wanted: str = "") -> None:
    if not (Path(folder) / "sales").exists():
        spark = session()
        manifest = Artifact(f"{folder}/manifest", "json", "append")
        base = SCALES[scale]
        size = replace(
            base, sales=base.sales * int(factor), partitions=base.partitions * int(factor)
        )
        checks = inventory.materialize(spark, size, targets(folder), manifest, scale)
        print(json.dumps({"checks": [row.asDict() for row in checks.collect()]}))
        spark.stop()
    work = tempfile.mkdtemp(prefix="run-")
    logs, wall_file = f"{work}/logs", f"{work}/wall.json"
    Path(logs).mkdir()
    # The measured session must end before its log is complete, so it has its own process.
    subprocess.run([sys.executable, __file__, "--measure", folder, logs, wall_file, wanted], check=True)
    report(logs, wall_file)


if __name__ == "__main__":
    if sys.argv[1] == "--measure":
        measure(*sys.argv[2:])
    else:
        main(*sys.argv[1:])
