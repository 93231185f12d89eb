"""Registered queries with an independent SQL statement for each exact one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.queries import events, generation, metrics, quality, retail, stored

Query = Callable[[SparkSession, str], DataFrame]
_GROUPS = (retail, quality, events, metrics, generation, stored)


def all_queries() -> dict[str, Query]:
    return {name: query for group in _GROUPS for name, query in group.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for group in _GROUPS for name, sql in group.SQL.items()}
