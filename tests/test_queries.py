"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from pricewright_queries.checker import compare, duck


@pytest.fixture(scope="module")
def connection(sf):
    return duck(sf)


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert sum(r["items"] for r in rows) > 0 and round(sum(r.share_pct for r in rows)) == 100


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, sf, connection, name):
    run = []

    def query(spark, sf):
        run.append(entry.queries()[name](spark, sf))
        return run[0]

    verdict = compare(spark, sf, name, query, entry.oracle_sql().get(name), connection)
    assert verdict.startswith(("ok", "rows only")) and "TYPE" not in verdict
    plan = run[0]._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
