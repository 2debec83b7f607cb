"""Physical plans: pushed filters, pruned columns, no Python, no nested loops."""

import pytest

from allocspark.operators import corridors
from allocspark.plans import catalog
from allocspark.sources import fixtures, readers

STREAMED = {"anomaly_stream", "cost_surge_alarm_stream"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - STREAMED))
def test_no_python_and_no_pairing(spark, sf_dir, name):
    plan = plan_of(catalog.QUERIES[name](spark, sf_dir))
    for node in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups",
                 "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_filter_and_columns_reach_the_scan(spark, sf_dir, tmp_path):
    observed = fixtures.raw_observations(spark, sf_dir).withColumn("unused", readers.F.lit("x"))
    observed.write.parquet(str(tmp_path / "raw"))
    plan = plan_of(corridors.corridor_metrics(spark.read.parquet(str(tmp_path / "raw"))))
    assert "PushedFilters: [IsNotNull(is_active_corridor), EqualTo(is_active_corridor,true)]" in plan
    assert "unused" not in plan and "allocation_id" not in plan
