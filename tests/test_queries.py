"""Every registered query against its SQL statement."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from millrace.queries import all_queries
from tests.oracle import compare

NO_PAIRS = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, folder, plan_of, name):
    """Same rows as the SQL statement; only key joins; no Python in the plan."""
    df = queries()[name](spark, folder)
    plan = plan_of(df)
    assert not [node for node in NO_PAIRS if node in plan]
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan
    assert compare(spark, folder, name, df) == ""


def test_every_sql_statement_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["vendor_region", "sale_year_month"]
