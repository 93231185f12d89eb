"""Source inventory and generation of the retail tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.generate.retail import SalesShape, Scale, generate_tables
from millrace.operators.aggregates import top_key
from millrace.operators.profile import generation_checks, inventory_gate, source_profile
from millrace.operators.star import fk_violations
from millrace.sources.artifacts import Artifact, read_artifact, write_artifact
from millrace.sources.files import table_file_stats


def inventory(
    tables: Mapping[str, DataFrame], files: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Profile, foreign-key checks, vendor imbalance and the gate over them."""
    profile = source_profile(tables, files)
    violations = fk_violations(tables)
    return {
        "profile": profile,
        "violations": violations,
        "imbalance": top_key(tables["sales"], "vendor_id"),
        "gate": inventory_gate(profile, violations),
    }


def materialize(
    spark: SparkSession,
    scale: Scale,
    targets: Mapping[str, Artifact],
    manifest: Artifact,
    run_id: str,
    shape: SalesShape = SalesShape(),
) -> DataFrame:
    """Generates and writes the four tables, checks what was written and stores a
    manifest. Returns the checks."""
    for name, df in generate_tables(spark, scale, shape).items():
        write_artifact(df, targets[name], scale.max_records_per_file)
    written = {name: read_artifact(spark, target) for name, target in targets.items()}
    files = table_file_stats(spark, {name: target.path for name, target in targets.items()})
    checks = generation_checks(
        written,
        scale.row_counts(),
        fk_violations(written),
        shape.hot_vendor,
        shape.hot_share,
        shape.share_tolerance,
        files,
    )
    write_artifact(manifest_record(checks, files, scale, targets, run_id, shape), manifest)
    return checks


def manifest_record(
    checks: DataFrame,
    files: DataFrame,
    scale: Scale,
    targets: Mapping[str, Artifact],
    run_id: str,
    shape: SalesShape,
) -> DataFrame:
    """One row with paths, parameters, checks and file statistics as nested structs."""

    def literal(values: Mapping[str, object]):
        return F.struct(*[F.lit(value).alias(name) for name, value in values.items()])

    gathered = checks.select(
        F.struct("check", "expected", "actual", "passed").alias("check"),
        F.lit(None).cast(files.select(F.struct("*")).schema[0].dataType).alias("file"),
    ).unionByName(
        files.select(
            F.lit(None)
            .cast("struct<check:string,expected:double,actual:double,passed:boolean>")
            .alias("check"),
            F.struct("*").alias("file"),
        )
    )
    return gathered.agg(
        F.collect_list("check").alias("checks"), F.collect_list("file").alias("files")
    ).select(
        F.lit(run_id).alias("run_id"),
        F.current_timestamp().alias("generated_at"),
        literal({name: target.path for name, target in targets.items()}).alias("paths"),
        literal(asdict(scale)).alias("scale"),
        literal(asdict(shape)).alias("shape"),
        "checks",
        "files",
    )
