"""Mergeable rollup state, snapshots, sketches, folded alarm logs."""

import pytest
from pyspark.sql import functions as F

from allocspark import schemas
from allocspark.operators import rollup, sketches
from allocspark.sources import fixtures, rollup_store, snapshots
from allocspark.streaming import jobs
from tests.oracle import canonical


def rows(df):
    return canonical(df.columns, df.collect())


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    telemetry = fixtures.sourcing_telemetry(spark, sf_dir).where("event_timestamp >= '1996-01-01' and event_timestamp < '1996-07-01'")
    return telemetry, fixtures.campaign_master(spark, sf_dir)


def test_refreshes_read_new_rows_only_and_equal_the_whole(spark, tables, tmp_path):
    telemetry, campaigns = tables
    root = str(tmp_path / "store")
    parts = [telemetry.where("event_timestamp < '1996-03-03'"), telemetry.where("event_timestamp >= '1996-03-03' and pmod(hash(telemetry_id), 5) > 0"),
             telemetry.where("event_timestamp >= '1996-03-03' and pmod(hash(telemetry_id), 5) = 0")]
    path = str(tmp_path / "arrived")
    for number, part in enumerate(parts):
        # Each batch's file is gone when the next one is read.
        part.write.mode("overwrite").parquet(f"{path}{number}")
        new = spark.read.parquet(f"{path}{number}")
        done = rollup_store.refresh(spark, root, f"b{number}", new, campaigns)
        assert done["version"] == number + 1 and done["rows"] == rollup.registered_only(part, campaigns).count()
        if number:
            assert min(done["quarters"]) == "1996Q1"
    whole = rollup.efficiency_rollup(telemetry, campaigns)
    stored = rollup_store.read_rollup(spark, root)
    assert rows(stored) == rows(whole)
    assert rollup_store.refresh(spark, root, "b1", parts[1], campaigns) == {"version": 3, "rows": 0, "quarters": []}
    before = rows(rollup_store.read_state(spark, root, "cells"))
    rollup_store.compact(spark, root)
    assert rows(rollup_store.read_state(spark, root, "cells")) == before and rows(rollup_store.read_rollup(spark, root)) == rows(whole)
    spring = rollup_store.read_rollup(spark, root, "1996Q2", "1996Q2")
    assert rows(spring) == rows(whole.where("snapshot_date between '1996-04-01' and '1996-06-30'"))
    assert len(spring.inputFiles()) < len(rollup_store.read_rollup(spark, root).inputFiles())


def test_stored_sketches_answer_any_range(spark, tables, tmp_path):
    telemetry, campaigns = tables
    root = str(tmp_path / "store")
    for name, part in (("a", "pmod(hash(telemetry_id), 3) = 0"), ("b", "pmod(hash(telemetry_id), 3) > 0")):
        rollup_store.refresh(spark, root, name, telemetry.where(part), campaigns)
    daily = rollup_store.read_state(spark, root, "sketches").where("snapshot_date between '1996-02-10' and '1996-04-20'")
    found = sketches.estimated(sketches.merged(daily, schemas.CORRIDOR), 0.5)
    exact = telemetry.where("to_date(event_timestamp) between '1996-02-10' and '1996-04-20'").groupBy(*schemas.CORRIDOR).agg(
        F.count_distinct("campaign_id").alias("n"), F.count("cost_per_applicant_usd").alias("rows"))
    both = found.join(exact, schemas.CORRIDOR).collect()
    assert len(both) == exact.count() > 10
    assert all(abs(r.campaigns - r.n) <= 1 + 0.07 * r.n and r.n_values == r.rows for r in both)


def test_an_empty_batch_and_an_empty_store(spark, tables, tmp_path):
    telemetry, campaigns = tables
    root = str(tmp_path / "store")
    assert rollup_store.read_rollup(spark, root).count() == 0
    assert rollup_store.refresh(spark, root, "none", telemetry.where("false"), campaigns)["quarters"] == []
    assert rollup_store.read_state(spark, root, "cells").count() == 0


def test_a_reader_sees_the_old_or_the_new_version(spark, tmp_path):
    root = str(tmp_path / "snapshots")
    first = snapshots.publish(spark, root, snapshots.current(spark, root) | {"folders": {"a": "1"}}, snapshots.current(spark, root))
    # Another writer is lost in the middle of its manifest: the old version counts, and the next number is free.
    (tmp_path / "snapshots" / "_manifests" / "000000000002.json").write_text('{"version": 2, "fol')
    assert snapshots.current(spark, root) == first
    second = snapshots.publish(spark, root, first | {"folders": {"a": "2"}}, first)
    assert second["version"] == 3 and snapshots.current(spark, root)["folders"] == {"a": "2"}
    with pytest.raises(snapshots.Conflict):
        snapshots.publish(spark, root, first | {"folders": {"a": "3"}}, first)
    assert snapshots.current(spark, root) == second


def test_a_lost_refresh_leaves_the_old_state(spark, tables, tmp_path, monkeypatch):
    telemetry, campaigns = tables
    root = str(tmp_path / "store")
    rollup_store.refresh(spark, root, "a", telemetry.where("event_timestamp < '1996-02-01'"), campaigns)
    before = rows(rollup_store.read_rollup(spark, root))
    late = telemetry.where("event_timestamp >= '1996-02-01' and event_timestamp < '1996-03-01'")

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "publish", lost)
        with pytest.raises(RuntimeError):
            rollup_store.refresh(spark, root, "b", late, campaigns)
    assert rows(rollup_store.read_rollup(spark, root)) == before
    rollup_store.refresh(spark, root, "b", late, campaigns)
    assert rows(rollup_store.read_rollup(spark, root)) == rows(rollup.efficiency_rollup(telemetry.where("event_timestamp < '1996-03-01'"), campaigns))


def test_distinct_estimates_do_not_depend_on_the_split(spark):
    df = spark.range(60_000).selectExpr("id % 3 as k", "cast(pmod(hash(id), 20011) as string) as campaign_id", "cast(null as double) as cost_per_applicant_usd", "id")
    answers = set()
    for parts in (2, 7, 30):
        split = sketches.sketched(df.withColumn("part", F.expr(f"pmod(hash(id), {parts})")), ["k", "part"])
        answers.add(tuple(sorted((r.k, r.campaigns, r.cost_quantile) for r in sketches.estimated(sketches.merged(split, ["k"]), 0.5).collect())))
    assert len(answers) == 1
    exact = df.groupBy("k").agg(F.count_distinct("campaign_id").alias("n")).collect()
    for (k, n, quantile), r in zip(sorted(answers.pop()), sorted(exact)):
        assert abs(n - r.n) <= 4 * sketches.HLL_ERROR * r.n and quantile is None


def test_quantile_ranks_of_skewed_values(spark):
    df = spark.range(200_000).selectExpr("id % 40 as part", "case when id % 3 = 0 then 1.0 else exp(pmod(hash(id), 1000) / 40.0) end as cost_per_applicant_usd",
                                         "id as campaign_id").cache()
    fractions = (0.01, 0.2, 0.33, 0.5, 0.9, 0.99, 0.999)
    merged = sketches.merged(sketches.sketched(df, ["part"]), [F.lit(1).alias("all")])
    found = sketches.estimated(merged, *fractions).first()["cost_quantiles"]
    n = df.count()
    for f, value in zip(fractions, found):
        below, upto = df.where(F.col("cost_per_applicant_usd") < value).count(), df.where(F.col("cost_per_applicant_usd") <= value).count()
        assert below <= (f + 3 * sketches.KLL_RANK_ERROR) * n and upto >= (f - 3 * sketches.KLL_RANK_ERROR) * n


def test_the_approximate_rollup_is_near_the_exact_one(spark, tables):
    telemetry, campaigns = tables
    exact = {(r.snapshot_date, r.channel_name, r.region, r.seniority): r for r in rollup.efficiency_rollup(telemetry, campaigns).collect()}
    close = rollup.efficiency_rollup(telemetry, campaigns, approximate=True).collect()
    assert len(close) == len(exact)
    for r in close:
        e = exact[r.snapshot_date, r.channel_name, r.region, r.seniority]
        assert abs(r.active_campaigns_count - e.active_campaigns_count) <= 1 and r.total_spend_usd == e.total_spend_usd


def test_a_folded_alarm_log_answers_alike_and_reads_less(spark, tmp_path):
    feed, log, state = (str(tmp_path / name) for name in ("feed", "log", "state"))

    def arrives(*costs):
        spark.createDataFrame(costs, "event_timestamp string, cost_usd double").selectExpr(
            "to_timestamp(event_timestamp) as event_timestamp", "cast(cost_usd as decimal(18,4)) as cost_usd",
        ).write.mode("append").parquet(feed)
        events = spark.readStream.schema("event_timestamp timestamp, cost_usd decimal(18,4)").parquet(feed)
        jobs.start_cost_alarms(events, log, state).awaitTermination()

    def shown():
        return rows(jobs.current_alarms(spark, log))

    assert shown() == [] and jobs.fold_alarms(spark, log) == -1
    arrives(("2024-01-01 10:01:00", 200.0), ("2024-01-01 10:06:00", 200.0))
    arrives(("2024-01-01 10:11:00", 300.0))
    before = shown()
    assert jobs.fold_alarms(spark, log) >= 1 and shown() == before and len(before) == 2
    assert not any("batch_id=" in name for name in jobs.current_alarms(spark, log).inputFiles())
    arrives(("2024-01-01 10:07:00", 0.0))  # takes the first alarm back
    assert len(shown()) < 2 and jobs.fold_alarms(spark, log) >= 2
    assert jobs.fold_alarms(spark, log) == jobs.fold_alarms(spark, log)


def test_members_shuffle_once_to_the_files_they_end_in(spark, sf_dir):
    """they shuffled to be made distinct and once more to their quarters."""
    rows = rollup.rollup_rows(fixtures.sourcing_telemetry(spark, sf_dir), fixtures.campaign_master(spark, sf_dir)).limit(500).localCheckpoint()
    twice = rows.unionByName(rows)
    members = rollup_store._parts_of(twice, {"1995Q1": 2_500_000})["members"]
    assert members.count() == rows.select(*rollup.CELL, "campaign_id").distinct().count()
    assert members._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_quarters_of_one_batch_are_read_without_a_shuffle_and_others_merged(spark, tables, tmp_path):
    """all members shuffled again in every refresh, also those of quarters that one batch alone holds."""
    root = str(tmp_path / "store")
    telemetry, campaigns = tables
    undated = telemetry.limit(50).withColumn("event_timestamp", F.lit(None).cast("timestamp"))
    first = telemetry.where("event_timestamp < '1996-05-01'").unionByName(undated).localCheckpoint()
    second = telemetry.where("event_timestamp >= '1996-04-20'").unionByName(undated).localCheckpoint()  # some rows twice

    def shuffles(part, periods=None):
        return rollup_store.read_state(spark, root, part, periods)._jdf.queryExecution().executedPlan().toString().count("Exchange")

    rollup_store.refresh(spark, root, "a", first.where("event_timestamp is not null"), campaigns)
    assert [shuffles(part) for part in ("cells", "members", "instants")] == [0, 0, 0]
    base = snapshots.current(spark, root)
    new = rollup.rollup_rows(first.unionByName(second), campaigns)
    for name, batch in (("b", first), ("c", second)):  # the parts alone: a refresh knows the days of its rows
        for part, df in rollup_store._parts_of(rollup.rollup_rows(batch, campaigns), {}).items():
            df.write.partitionBy("period").parquet(f"{root}/{part}/batch={name}")
    both = base | {"parts": {part: ["batch=b", "batch=c"] for part in base["parts"]}}
    members = rollup_store.read_state(spark, root, "members", None, both)
    assert rows(members) == rows(new.select(*rollup.CELL, F.col("campaign_id").cast("string").alias("campaign_id")).distinct())
    cells = rollup_store.read_state(spark, root, "cells", None, both)
    counted = rollup.cell_counts(new)
    assert rows(cells.select(*counted.columns[:5], "n", "applicants")) == rows(counted.select(*counted.columns[:5], "n", "applicants"))


def test_new_rows_lie_by_day_and_corridor(spark, tables, tmp_path, monkeypatch):
    """rows lay by campaign, so that each task summed and sketched a part of every day."""
    telemetry, campaigns = tables
    plans = []
    kept = rollup_store.stored
    monkeypatch.setattr(rollup_store, "stored", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or kept(df))
    rollup_store.refresh(spark, str(tmp_path / "store"), "a", telemetry, campaigns)
    assert "REBALANCE_PARTITIONS_BY_COL" in plans[0]
