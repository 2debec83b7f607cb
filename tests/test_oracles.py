"""Every query with SQL meaning equals its statement in an independent engine."""

import pytest

import __spark_entry__ as entry_point
from allocspark.plans import catalog, oracles
from tests.oracle import difference

QUERIES, ORACLES = catalog.QUERIES, oracles.oracle_sql()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, sql, name):
    assert difference(QUERIES[name](spark, sf_dir), sql, ORACLES[name]) is None


def test_strained_campaigns_fail_in_every_way(spark, sf_dir):
    status = {r["solver_status"] for r in QUERIES["strained_allocation"](spark, sf_dir).collect()}
    assert status == {"OPTIMAL_CONVERGENCE", *(f"SOLVER_INFEASIBLE: {why}" for why in (
        "no budget given", "region capacity below its floor", "region floors exceed the budget", "senior quota out of reach"))}


def test_entry_point_runs(spark):
    assert entry_point.entry(spark).limit(1).count() == 1
