"""Timings of the headline queries; prints one JSON line.

Each query is planned and run to a sink that discards rows, so the result is not pulled to
the driver. Timings are warm, like the published ones: every query runs once on the smallest
data set beside the given one before it is timed. Session start and warming are not counted.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

from allocspark.operators import corridors
from allocspark.plans.catalog import QUERIES
from allocspark.session import build_session
from allocspark.sources import fixtures

HEADLINE = [
    "corridor_metrics", "naive_allocation", "greedy_allocation", "constrained_results", "efficiency_rollup",
    "rolling_7d", "campaign_cumulative", "pareto_frontier", "saturation_matrix", "budget_elasticity",
    "mta_attribution", "cohort_matrix", "anomaly_detect", "cost_surge_alarm", "dq_profile",
]


def seconds_of(df: DataFrame) -> float:
    started = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def stored_rates(spark: SparkSession, sf_dir: str) -> dict[str, int]:
    """Rows a second of the corridor aggregate over stored telemetry, one copy and ten."""
    rates = {}
    for copies in (1, 10):
        path = f"{tempfile.mkdtemp(prefix='bench-')}/telemetry"
        raw = fixtures.raw_observations(spark, sf_dir)
        raw.selectExpr("*", f"explode(sequence(1, {copies})) as copy").drop("copy").repartition(32).write.parquet(path)
        stored = spark.read.schema(raw.schema).parquet(path)
        rows = stored.count()
        best = min(seconds_of(corridors.corridor_metrics(stored)) for _ in range(3))
        rates[f"corridor_rows_per_sec_x{copies}"] = round(rows / best)
    return rates


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", cpus, **{
        "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"})
    smallest = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    warm_dir = smallest if os.path.isdir(smallest) else sf_dir
    seconds, extra = {}, {}
    for name in names:
        seconds_of(QUERIES[name](spark, warm_dir))
    for name in names:
        started = time.perf_counter()
        seconds_of(QUERIES[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - started, 3)
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    campaigns = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey").distinct().count()
    if "corridor_metrics" in seconds:
        extra["corridor_rows_per_sec"] = round(rows / seconds["corridor_metrics"])
        extra["stored"] = stored_rates(spark, sf_dir)
    if "constrained_results" in seconds:
        extra["campaigns_per_sec"] = round(campaigns / seconds["constrained_results"], 1)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rsplit("sf", 1)[-1], "cpus": cpus, **extra,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
