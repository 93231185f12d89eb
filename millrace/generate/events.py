"""Temporal events: all days of a plan in one job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.hashing import XXHASH64, hash_mod, pick
from millrace.functions.labels import numbered
from millrace.functions.money import from_cents
from millrace.generate.rows import ROWS_PER_CHUNK, expand_rows

SIZE_BUCKETS = ("SMALL", "MEDIUM", "LARGE")


@dataclass(frozen=True)
class EventDimensions:
    """Fixed values as defaults. Sizes may also be columns of the volume table."""

    accounts: int | Column = 10_000
    customers: int | Column = 50_000
    vendors: int | Column = 500
    products: int | Column = 5_000
    regions: tuple[str, ...] = ("BR_SP", "BR_RJ", "BR_MG", "BR_PR")
    channels: tuple[str, ...] = ("APP", "WEB", "API")
    event_types: tuple[str, ...] = ("ORDER_CREATED", "ORDER_PAID", "ORDER_CANCELLED")


def generate_events(
    volumes: DataFrame,
    seed: int = 77,
    dimensions: EventDimensions = EventDimensions(),
    algorithm: str = XXHASH64,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    partitions: int | None = None,
) -> DataFrame:
    """Events for every row of ``volumes`` (``event_date``, ``expected_rows``).

    An event depends only on its number within the day and the seed. A spike day is
    cut into chunks like any other, so it does not end up in one task.
    """
    offset = F.col("event_offset")

    def drawn(step: int, modulo: int | Column) -> Column:
        return hash_mod(offset, modulo=modulo, seed=seed + step, algorithm=algorithm)

    def chosen(step: int, values: tuple[str, ...]) -> Column:
        return pick(values, drawn(step, len(values)))

    quantity = drawn(8, 5) + 1
    unit_cents = drawn(9, 20_000) + 500
    rows = expand_rows(
        volumes,
        F.col("expected_rows"),
        name="event_offset",
        chunk=rows_per_chunk,
        partitions=partitions,
    )
    return rows.select(
        F.concat(
            F.date_format("event_date", "yyyyMMdd"), F.lit("-"), numbered("", offset, 12)
        ).alias("event_id"),
        "event_date",
        F.timestamp_seconds(
            F.unix_date("event_date") * F.lit(86_400) + F.pmod(offset, F.lit(86_400))
        ).alias("event_ts"),
        (drawn(1, dimensions.accounts) + 1).alias("account_id"),
        (drawn(2, dimensions.customers) + 1).alias("customer_id"),
        (drawn(3, dimensions.vendors) + 1).alias("vendor_id"),
        (drawn(4, dimensions.products) + 1).alias("product_id"),
        chosen(5, dimensions.regions).alias("region"),
        chosen(6, dimensions.channels).alias("channel"),
        chosen(7, dimensions.event_types).alias("event_type"),
        quantity.cast("int").alias("quantity"),
        from_cents(quantity * unit_cents).alias("gross_amount"),
        chosen(10, SIZE_BUCKETS).alias("payload_size_bucket"),
        F.current_timestamp().alias("created_at"),
    )
