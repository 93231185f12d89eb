"""Generated tables: exact counts, skew, keys, independence from partitions."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from millrace.generate import events, retail, volume
from millrace.generate.rows import expand_rows
from millrace.generate.volume import VolumePlan
from millrace.plans import inventory, temporal
from millrace.plans.retail import sales_enriched
from millrace.sources.artifacts import Artifact

SMALL = retail.Scale(20, 10, 500, 6000, 4, 1000, 2, 80)


def rows(df):
    return sorted(map(repr, df.collect()))


def test_scales():
    assert retail.SCALES["demo"].row_counts() == {
        "vendors": 20,
        "products": 200,
        "customers": 10_000,
        "sales": 200_000,
    }
    assert retail.SCALES["xs"].sales == 5_000_000 and retail.SCALES["xs"].payload_columns == 2
    assert retail.SCALES["s"].vendors * retail.SCALES["s"].products_per_vendor == 10_000


@pytest.fixture(scope="module")
def tables(spark):
    return {name: df.cache() for name, df in retail.generate_tables(spark, SMALL).items()}


def test_inventory_of_generated_tables(tables):
    jobs = inventory.inventory(tables)
    assert {r.table_name: r.rows for r in jobs["profile"].collect()} == SMALL.row_counts()
    assert [r.violations for r in jobs["violations"].collect()] == [0, 0, 0]
    top = jobs["imbalance"].first()
    assert top.top_vendor_id == 1 and abs(top.top_share - 0.70) < 0.03
    assert jobs["gate"].first().passed is True


def test_gate_names_what_failed(tables):
    broken = {**tables, "vendors": tables["vendors"].where("vendor_id <> 1"), "customers": tables["customers"].limit(0)}
    gate = inventory.inventory(broken)["gate"].first()
    assert (gate.empty_tables, gate.broken_relationships, gate.passed) == (
        "customers",
        "customer,vendor",
        False,
    )


def test_shapes(tables):
    sale = tables["sales"].agg(
        F.min("quantity"), F.max("quantity"), F.min("sale_date"), F.max("sale_date"),
        F.min("unit_price"), F.max("unit_price"), F.min(F.length("payload_2")), F.max(F.length("payload_2")),
    ).first()
    assert tuple(sale[:4]) == (1, 5, date(2026, 1, 1), date(2026, 1, 30))
    assert 1.0 <= sale[4] and sale[5] <= 501.0
    assert sale[6] == sale[7] == 80
    other = tables["sales"].where("vendor_id <> 1").select("vendor_id").distinct()
    assert {r.vendor_id for r in other.collect()} == set(range(2, 21))
    assert tables["vendors"].where("vendor_id = 7").first().vendor_name == "vendor_000007"
    assert {r.region: r["count"] for r in tables["vendors"].groupBy("region").count().collect()} == {
        "US": 10,
        "BR": 4,
        "EU": 4,
        "APAC": 2,
    }
    assert sales_enriched(tables).where("vendor_name is null or product_name is null").isEmpty()


def test_rows_do_not_depend_on_partitions(spark, tables):
    whole = retail.generate_sales(spark.range(1, 6001, 1, 1), SMALL)
    assert rows(whole) == rows(tables["sales"])


def test_hot_vendor_is_spread_when_written(spark):
    scale = retail.Scale(20, 10, 500, 8000, 16)
    sales = retail.generate_tables(spark, scale)["sales"]
    largest = sales.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert largest < 8000 * 0.35


def test_materialize_checks_and_manifest(spark, tmp_path):
    targets = {
        name: Artifact(str(tmp_path / name), mode="overwrite", partition_by=("vendor_id",) if name == "sales" else ())
        for name in SMALL.row_counts()
    }
    manifest = Artifact(str(tmp_path / "manifest"), "json", "append")
    checks = inventory.materialize(spark, SMALL, targets, manifest, "run-1").collect()
    assert len(checks) == 9 and all(c.passed for c in checks)
    written = [json.loads(line) for f in (tmp_path / "manifest").glob("part-*") for line in f.open()]
    assert len(written) == 1
    assert written[0]["run_id"] == "run-1" and written[0]["scale"]["sales"] == 6000
    assert written[0]["paths"]["sales"].endswith("/sales")
    assert {f["table_name"] for f in written[0]["files"]} == set(targets)
    assert all(c["passed"] for c in written[0]["checks"])


def test_expand_rows(spark):
    df = spark.createDataFrame([("a", 5), ("b", 0), ("c", 12), ("d", 4)], "k string, n long")
    got = expand_rows(df, F.col("n"), first=1, chunk=4, partitions=3)
    found = {}
    for r in got.collect():
        found.setdefault(r.k, []).append(r.id)
    assert {k: sorted(v) for k, v in found.items()} == {
        "a": list(range(1, 6)),
        "c": list(range(1, 13)),
        "d": list(range(1, 5)),
    }


def test_default_volume_plan(spark):
    plan = {str(r.event_date): r for r in volume.plan_volumes(spark, VolumePlan()).collect()}
    assert len(plan) == 14 and sum(r.expected_rows for r in plan.values()) == 2_210_000
    assert [plan[f"2026-01-{d}"].spike_label for d in ("01", "04", "07", "11")] == [
        "NORMAL",
        "VOLUME_SPIKE",
        "MEDIUM_SPIKE",
        "VOLUME_SPIKE",
    ]
    assert plan["2026-01-04"].expected_rows == 1_000_000


def test_partition_calibration(spark):
    df = spark.createDataFrame([(10_000,), (100_000,), (1_000_000,), (100_000_000,)], "n long")
    got = df.select(volume.partitions_for(F.col("n"), 250_000, 16).alias("p"))
    assert [r.p for r in got.collect()] == [1, 1, 4, 16]


def test_partitions_of_a_whole_plan():
    assert VolumePlan().partitions == 12 + 2 * 4
    assert VolumePlan(base_rows_per_day=10**8, spikes={}).partitions == 14 * 16


def test_spike_outside_the_plan_is_rejected():
    with pytest.raises(ValueError, match="outside"):
        VolumePlan(spikes={date(2026, 2, 1): 10})


PLAN = VolumePlan(
    start=date(2026, 1, 1), end=date(2026, 1, 4), base_rows_per_day=50, spikes={date(2026, 1, 3): 10}
)


def test_events_do_not_depend_on_chunks(spark):
    days = volume.plan_volumes(spark, PLAN)
    one = events.generate_events(days, rows_per_chunk=1000, partitions=1).drop("created_at")
    many = events.generate_events(days, rows_per_chunk=7, partitions=5).drop("created_at")
    assert rows(one) == rows(many) and one.count() == 650
    assert one.select("event_id").distinct().count() == 650
    first = one.where("event_id = '20260103-000000000011'").first()
    assert str(first.event_ts) == "2026-01-03 00:00:11"
    assert [f.simpleString() for f in one.schema.fields][:5] == [
        "event_id:string",
        "event_date:date",
        "event_ts:timestamp",
        "account_id:bigint",
        "customer_id:bigint",
    ]


def test_source_is_filled_once_and_only_where_missing(spark, tmp_path):
    source = Artifact(str(tmp_path / "events"))
    first = temporal.generate_source(spark, PLAN, source)
    assert {r.write_status for r in first["audit"].collect()} == {"generated"}
    assert all(r.matches for r in first["check"].collect())
    longer = VolumePlan(PLAN.start, date(2026, 1, 6), 50, PLAN.spikes)
    second = temporal.generate_source(spark, longer, source)
    status = {str(r.event_date): r.write_status for r in second["audit"].collect()}
    assert [d for d, s in status.items() if s == "generated"] == ["2026-01-05", "2026-01-06"]
    assert all(r.matches for r in second["check"].collect())
    assert spark.read.parquet(source.path).count() == 750
    again = temporal.generate_source(spark, longer, source)
    assert {r.write_status for r in again["audit"].collect()} == {"already_exists"}
    replaced = temporal.generate_source(spark, longer, source, replace=True)
    assert {r.write_status for r in replaced["audit"].collect()} == {"generated"}
    assert spark.read.parquet(source.path).count() == 750


def test_append_day(spark, tmp_path):
    source = Artifact(str(tmp_path / "events"))
    day = date(2026, 3, 1)
    jobs = temporal.generate_source(spark, PLAN, source, temporal.APPEND_DAY, day, 10)
    assert [(r.expected_rows, r.actual_rows) for r in jobs["check"].collect()] == [(500, 500)]
    with pytest.raises(ValueError, match="exists"):
        temporal.generate_source(spark, PLAN, source, temporal.APPEND_DAY, day, 10)
    with pytest.raises(ValueError, match="needs a date"):
        temporal.generate_source(spark, PLAN, source, temporal.APPEND_DAY)
    with pytest.raises(ValueError, match="full mode"):
        temporal.generate_source(spark, PLAN, source, temporal.APPEND_DAY, day, replace=True)


def test_backfill_drops_the_output_of_a_date_without_events(spark, tmp_path):
    days = volume.plan_volumes(spark, PLAN)
    made = events.generate_events(days)
    made.write.partitionBy("event_date").parquet(str(tmp_path / "events"))
    stored = spark.read.parquet(str(tmp_path / "events"))
    output = Artifact(str(tmp_path / "activity"))
    temporal.backfill(stored, days, output)
    day = "event_date = '2026-01-03'"
    temporal.backfill(stored.where(f"NOT {day}"), days.where(day), output)
    after = spark.read.parquet(output.path)
    assert after.where(day).isEmpty()
    assert after.select("event_date").distinct().count() == days.count() - 1


def test_backfill_replaces_only_its_dates(spark, tmp_path):
    days = volume.plan_volumes(spark, PLAN)
    made = events.generate_events(days)
    made.write.partitionBy("event_date").parquet(str(tmp_path / "events"))
    stored = spark.read.parquet(str(tmp_path / "events"))
    output = Artifact(str(tmp_path / "activity"))
    temporal.backfill(stored, days, output)
    before = rows(spark.read.parquet(output.path).where("event_date <> '2026-01-03'"))
    temporal.backfill(stored, days.where("event_date = '2026-01-03'"), output)
    after = spark.read.parquet(output.path)
    assert rows(after.where("event_date <> '2026-01-03'")) == before
    total = {str(r.event_date): r.n for r in after.groupBy("event_date").agg(F.sum("event_count").alias("n")).collect()}
    assert total == {"2026-01-01": 50, "2026-01-02": 50, "2026-01-03": 500, "2026-01-04": 50}
    one_day = temporal.daily_activity(stored, date(2026, 1, 3))
    everything = temporal.daily_activity(stored).where("event_date = '2026-01-03'")
    assert rows(one_day) == rows(everything)
