"""Ordered chunks give the rows of the plain window; nulls stay out of means."""

from decimal import Decimal
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from allocspark.operators import cohorts, pareto, rollup
from allocspark.operators.ordered import Running, run_by_key, run_ordered
from allocspark.plans import catalog
from allocspark.session import ensure_checkpoint_dir
from allocspark.sources import fixtures
from tests.oracle import canonical


def same(left, right):
    assert sorted(left.columns) == sorted(right.columns)
    assert dict(left.dtypes) == dict(right.dtypes)
    assert canonical(left.columns, left.collect()) == canonical(right.columns, right.collect())


def plain(df, spec):
    """The same columns by windows over whole keys."""
    whole = Window.partitionBy(*spec.key)
    along = whole.orderBy(*spec.order)
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns(
        {out: F.sum(src).over(so_far) for out, src in spec.sums.items()}
        | {out: F.lag(src).over(along) for out, src in spec.previous.items()}
        | {out: F.lead(src).over(along) for out, src in spec.following.items()}
        | {out: F.first(src).over(so_far) for out, src in spec.first.items()}
        | {spec.position: F.row_number().over(along), spec.size: F.count(F.lit(1)).over(whole)})


EVERYTHING = Running(key=["k"], order=["t", "id"], sums={"run": "v"}, previous={"prev": "v"},
                     following={"nxt": "v"}, first={"head": "v"}, position="pos", size="size")


@pytest.fixture(params=[1, 7, 40])
def partitions(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_one_key_holds_a_third_of_the_rows_and_every_row_ties(spark, partitions):
    rows = [("hot" if i % 3 == 0 else f"k{i % 50}", 0, i, float(i) if i % 7 else None) for i in range(900)]
    df = spark.createDataFrame(rows + [(None, 1, 1000 + i, 1.0) for i in range(40)],
                               "k string, t int, id int, v double")
    same(run_ordered(df, EVERYTHING), plain(df, EVERYTHING))


def test_no_rows(spark):
    df = spark.createDataFrame([], "k string, t int, id int, v double")
    assert run_ordered(df, EVERYTHING).collect() == []


def test_many_keys_of_several_chunks(spark):
    df = spark.range(60_000).selectExpr("id % 12000 as k", "id div 12000 as t", "id", "cast(id as double) as v")
    same(run_ordered(df, EVERYTHING), plain(df, EVERYTHING))


@pytest.mark.parametrize("values", [[1] * 17, [1, 1, 2, 2, 2, 2, 2, 3], [5, 4, 3], list(range(10)) * 3,
                                    [None, 4, None, 1, 2, 3, None, 4, 4, 9, 8, 7]])
def test_ntile(spark, values):
    df = spark.createDataFrame([(g, v, i) for g in "ab" for i, v in enumerate(values)], "g string, v int, id int")
    same(cohorts.with_ntile(df, "g", "v", "id", 4, "q"),
         df.selectExpr("*", "ntile(4) over (partition by g order by v nulls last, id) as q"))


def test_means_and_percentiles_leave_nulls_out(spark):
    columns = ("telemetry_id string, campaign_id int, channel_name string, region string, seniority string,"
               " cost_per_applicant_usd decimal(8,2), allocated_applicants int, allocated_spend_usd decimal(12,2),"
               " overall_conversion_yield decimal(8,5), projected_hires decimal(8,2), event_timestamp string")
    rows = [(str(i), 1, "c", "r", "s", cost, 1, Decimal(1), share, Decimal(1), f"2024-01-01 0{i}:00:00")
            for i, (cost, share) in enumerate([(Decimal(10), None), (Decimal(20), Decimal("0.1")), (None, Decimal("0.2"))])]
    telemetry = spark.createDataFrame(rows, columns).withColumn("event_timestamp", F.to_timestamp("event_timestamp"))
    day = rollup.efficiency_rollup(telemetry, spark.createDataFrame([(1,)], "campaign_id int")).first()
    assert [float(day[c]) for c in ("mean_cpa_usd", "rolling_7d_cpa_usd", "p95_cpa_usd", "mean_conversion_yield")] == [
        15.0, 13.33, 19.5, 0.15]
    assert float(day["rolling_7d_yield"]) == 0.125


def test_dominance_of_many_pairs_equals_brute_force_on_a_sample(spark):
    pairs = spark.range(60_000).selectExpr(
        "cast(pmod(hash(id), 3000) as decimal(10,2)) as cost", "cast(pmod(xxhash64(id), 2500) as decimal(10,2)) as gain")
    counts = pareto.dominance_counts(pairs, "cost", "gain")
    rows = {(r.cost, r.gain): r.dominated_by_count for r in counts.collect()}
    assert len(rows) == pairs.distinct().count()
    points = np.array([(float(r.cost), float(r.gain)) for r in pairs.collect()])
    for cost, gain in list(rows)[:300]:
        c, g = float(cost), float(gain)
        better = (points[:, 0] <= c) & (points[:, 1] >= g) & ((points[:, 0] < c) | (points[:, 1] > g))
        assert rows[cost, gain] == better.sum()


def test_no_window_without_a_key_sees_all_rows(spark, sf_dir):
    """Frontier, quartiles and running sums: no stage deals all rows to one task."""
    telemetry, campaigns = fixtures.sourcing_telemetry(spark, sf_dir), fixtures.campaign_master(spark, sf_dir)
    cumulative = rollup.campaign_cumulative(telemetry, campaigns)
    plan = cumulative._jdf.queryExecution().executedPlan().toString()
    # What is left after the rows are laid out: a join with the broadcast borders, no shuffle of the rows.
    assert plan.count("SortMergeJoin") == 0 and "BroadcastHashJoin" in plan


def bytes_kept(spark):
    ensure_checkpoint_dir(spark)
    return sum(f.stat().st_size for f in Path(spark.sparkContext.getCheckpointDir().removeprefix("file:")).rglob("*") if f.is_file())


def test_an_ordered_pass_writes_little_and_nothing_of_settled_rows(spark):
    """every row was written once more with all its columns, 89 bytes of a telemetry row."""
    df = spark.range(200_000).selectExpr("id % 700 as k", "id as t", "id", "1.0d as v", "concat('Client #', id % 700) as name",
                                         "concat('Executive Headhunting ', id % 5) as channel")
    before = bytes_kept(spark)
    rows = run_ordered(df, EVERYTHING)
    assert rows.count() == 200_000 and 0 < bytes_kept(spark) - before < 30 * 200_000
    before = bytes_kept(spark)
    assert run_ordered(df, EVERYTHING, settled=True).where("pos = 1").count() == 700
    assert bytes_kept(spark) - before < 100_000  # the borders


def test_a_key_that_ends_at_a_border_carries_nothing_into_the_next(spark, partitions):
    df = spark.range(400).selectExpr("cast(id div 4 as string) as k", "cast(id % 4 as int) as t", "id", "cast(id as double) as v")
    same(run_ordered(df, EVERYTHING), plain(df, EVERYTHING))


def test_report_positions_keep_keys_and_places_only(spark, sf_dir):
    """F8: the whole reports were written, some hundred bytes a row."""
    before = bytes_kept(spark)
    positions = catalog.report_positions(spark, sf_dir)
    assert positions.count() > 12_000
    settled = [f for f in Path(spark.sparkContext.getCheckpointDir().removeprefix("file:")).glob("stored-*")]
    assert settled and bytes_kept(spark) - before < 1_500_000


def test_hot_keys_by_chunks_and_the_rest_by_plain_windows(spark, partitions):
    """rows were laid out by chunks after a join had laid them out by key."""
    rows = [("hot" if i % 3 == 0 else f"k{i % 50}", 0, i, float(i) if i % 7 else None) for i in range(900)]
    df = spark.createDataFrame(rows + [(None, 1, 1000 + i, 1.0) for i in range(40)], "k string, t int, id int, v double")
    sizes = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    same(run_by_key(df, EVERYTHING, sizes), plain(df, EVERYTHING))
    none = df.where("false")
    assert run_by_key(none, EVERYTHING, none.groupBy("k").agg(F.count(F.lit(1)).alias("n"))).collect() == []


def test_history_of_campaigns_hot_unknown_and_listed_twice(spark, partitions):
    columns = ("telemetry_id string, campaign_id int, channel_name string, region string, seniority string,"
               " cost_per_applicant_usd decimal(8,2), allocated_applicants int, allocated_spend_usd decimal(12,2),"
               " overall_conversion_yield decimal(8,5), projected_hires decimal(8,2), event_timestamp string")
    rows = [(f"t{i:03}", 1 if i % 2 else i % 40, "c", "r", f"s{i % 3}", Decimal(i * 7 % 50) if i % 9 else None, i, Decimal(i),
             Decimal(i % 11) / 100, Decimal(1), f"2024-01-{1 + i % 5:02} 00:00:00") for i in range(300)]
    telemetry = spark.createDataFrame(rows, columns).withColumn("event_timestamp", F.to_timestamp("event_timestamp"))
    campaigns = spark.createDataFrame([(i, "a", "2023-05-01") for i in range(30)] + [(4, "b", None), (99, "z", "2023-06-01")],
                                      "campaign_id int, client_name string, created_at string").withColumn("created_at", F.to_date("created_at"))
    names = ["telemetry_id", "client_name", "cpa_efficiency_quartile", "allocation_batch_sequence", "baseline_campaign_cpa_usd"]
    history = "over (partition by campaign_id order by event_timestamp, telemetry_id)"

    def both(listed):
        found = cohorts.cohort_telemetry(cohorts.settled_telemetry(telemetry), listed)
        expected = telemetry.join(listed.select("campaign_id", "client_name"), "campaign_id").selectExpr(
            "*", "ntile(4) over (partition by seniority order by cost_per_applicant_usd nulls last, telemetry_id) as cpa_efficiency_quartile",
            f"row_number() {history} as allocation_batch_sequence", f"first(cost_per_applicant_usd) {history} as baseline_campaign_cpa_usd")
        return found, expected

    found, expected = both(campaigns.where("client_name <> 'b'"))
    same(found.select(*names), expected.select(*names))
    found, expected = both(campaigns)
    sequence = ["telemetry_id", "campaign_id", "allocation_batch_sequence"]
    same(found.select(*sequence), expected.select(*sequence))


def test_cohort_reports_compute_the_telemetry_once(spark, sf_dir):
    """the benchmark joined all order lines again, and every enriched row shuffled once more."""
    plan = catalog.cohort_enriched(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 1  # the partial means of the corridors


def test_the_cohort_matrix_sums_before_it_shuffles(spark, sf_dir):
    """every row became two with all sums, most of which shuffled."""
    plan = catalog.cohort_matrix(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "lineitem" not in plan and "Window" not in plan
