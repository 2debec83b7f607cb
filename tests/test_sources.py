"""Readers, sinks, streaming jobs."""

import glob

import pytest
from pyspark.sql import functions as F

from allocspark import schemas
from allocspark.operators import allocation as al, anomalies, corridors, rollup
from allocspark.sources import fixtures, readers, writers
from allocspark.streaming import jobs
from allocspark.streaming.alarms import cost_surge_alarms
from tests.oracle import canonical


def rows(df):
    return canonical(df.columns, df.collect())


def test_missing_source(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_observations(spark, str(tmp_path / "absent"))


def test_observations_round_trip(spark, sf_dir, tmp_path):
    observed = fixtures.raw_observations(spark, sf_dir)
    raw = observed.withColumns({
        **{c: F.col(c).cast("double") for c in ("cost_per_applicant_usd", "interview_yield_rate",
                                                "offer_acceptance_rate", "overall_conversion_yield")},
        "cost_per_hire_benchmark_usd": F.lit(1.0),
        "event_timestamp": F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss")})
    path = str(tmp_path / "deep" / "folder")
    writers.write_parquet(raw, path)
    back = readers.read_observations(spark, path)
    assert back.schema["event_timestamp"].dataType.typeName() == "timestamp"
    assert rows(corridors.corridor_metrics(back)) == rows(corridors.corridor_metrics(observed))


def test_event_time_text(spark):
    row = spark.range(1).select(readers.format_event_time(F.lit(1767225600)).alias("t")).select(
        "t", readers.parse_event_time(F.col("t")).cast("long").alias("s")).first()
    assert (row["t"], row["s"]) == ("2026-01-01 00:00:00", 1767225600)


def test_quarters_and_pruning(spark, sf_dir, tmp_path):
    telemetry = fixtures.sourcing_telemetry(spark, sf_dir).withColumns({
        "campaign_id": F.col("campaign_id").cast("string"),
        "event_timestamp": F.col("event_timestamp").cast("timestamp")})
    writers.write_telemetry_by_quarter(telemetry, str(tmp_path / "sourcing_telemetry"))
    back = readers.read_table(spark, str(tmp_path), "sourcing_telemetry")
    assert back.count() == telemetry.count()
    span = readers.between_dates(back, "1996-02-01 00:00:00", "1996-05-01 00:00:00")
    plan = span._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_quarter" in plan and "GreaterThanOrEqual(event_timestamp" in plan
    wanted = telemetry.filter("event_timestamp >= '1996-02-01' and event_timestamp < '1996-05-01'")
    assert span.count() == wanted.count() > 0


def test_rollup_refresh_replaces_only_its_days(spark, sf_dir, tmp_path):
    telemetry, campaigns = fixtures.sourcing_telemetry(spark, sf_dir), fixtures.campaign_master(spark, sf_dir)
    path = str(tmp_path / "rollup")
    writers.refresh_rollup(telemetry, campaigns, path, "1997-03-01", "1997-03-20")
    writers.refresh_rollup(telemetry, campaigns, path, "1997-03-11", "1997-03-31")
    whole = rollup.efficiency_rollup(telemetry, campaigns).filter("snapshot_date between '1997-03-01' and '1997-03-31'")
    stored = spark.read.option("partitionColumnTypeInference", "false").parquet(path)
    stored = stored.withColumn("snapshot_date", F.date_format("snapshot_date", "yyyy-MM-dd"))
    assert rows(stored.select(*whole.columns)) == rows(whole)


def test_run_audit(spark, sf_dir, tmp_path):
    program = al.corridor_program(corridors.corridor_metrics(fixtures.raw_observations(spark, sf_dir)))
    baseline = al.pro_rata(fixtures.campaign_master(spark, sf_dir), program)
    results = al.campaign_results(al.integer_allocations(al.greedy_plan(baseline, program)))
    path = str(tmp_path / "optimization_runs_audit")
    for job in ("2024-01/main", "2024-01/main", "2024-02"):  # the second run replaces the first
        writers.append_run_audit(results, path, job)
    audit = readers.read_table(spark, str(tmp_path), "optimization_runs_audit")
    assert audit.count() == 2 * results.count() == audit.select("run_id").distinct().count()
    assert audit.columns == schemas.OPTIMIZATION_RUNS_AUDIT.fieldNames() and audit.where("solve_time_ms is not null").count() == 0


def test_anomaly_stream_equals_batch_and_survives_restart(spark, sf_dir, tmp_path):
    campaigns, registry = fixtures.campaign_master(spark, sf_dir), fixtures.channel_corridor_registry(spark)
    lines = fixtures.stream_table(spark, sf_dir, "lineitem")
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    for _ in range(2):  # the second run finds nothing new
        jobs.start_anomaly_log(
            fixtures.sourcing_telemetry(spark, sf_dir, lines), registry, campaigns, log, checkpoint).awaitTermination()
    logged = spark.read.parquet(log)
    batch = anomalies.detect_anomalies(fixtures.sourcing_telemetry(spark, sf_dir), registry, campaigns)
    columns = ["channel_name", "region", "seniority", "observed_cpa_usd", "baseline_cpa_usd", "escalation_tier"]
    assert rows(logged.select(*columns)) == rows(batch.select(*columns))
    keys = spark.read.json(logged.select("alert_payload").rdd.map(lambda r: r[0])).columns
    assert len(keys) == 11


def test_batch_anomaly_log_keeps_null_keys(spark, sf_dir, tmp_path):
    alerts = anomalies.detect_anomalies(
        fixtures.sourcing_telemetry(spark, sf_dir), fixtures.channel_corridor_registry(spark),
        fixtures.campaign_master(spark, sf_dir))
    writers.append_anomaly_log(alerts.limit(5), str(tmp_path / "sourcing_anomaly_audit_log"))
    assert readers.read_table(spark, str(tmp_path), "sourcing_anomaly_audit_log").count() == 5
    text = anomalies.payload_json(alerts.limit(1).withColumn("alert_payload", F.struct(F.lit(None).cast("string").alias("k"))))
    assert text.first()["alert_payload"] == '{"k":null}'


def test_cost_alarm_stream_equals_batch(spark, sf_dir, tmp_path):
    stream = fixtures.cost_events(spark, sf_dir, fixtures.stream_table(spark, sf_dir, "events"))
    jobs.start_cost_alarms(stream, str(tmp_path / "alarms"), str(tmp_path / "checkpoint")).awaitTermination()
    alarms = jobs.current_alarms(spark, str(tmp_path / "alarms"))
    assert rows(alarms) == rows(cost_surge_alarms(fixtures.cost_events(spark, sf_dir)))
    assert glob.glob(str(tmp_path / "checkpoint" / "offsets" / "*"))


def test_open_windows_give_alarms_and_late_rows_are_dropped(spark, tmp_path):
    feed, log, state = (str(tmp_path / name) for name in ("feed", "log", "state"))

    def arrives(*costs):
        spark.createDataFrame(costs, "event_timestamp string, cost_usd double").selectExpr(
            "to_timestamp(event_timestamp) as event_timestamp", "cast(cost_usd as decimal(18,4)) as cost_usd",
        ).write.mode("append").parquet(feed)
        events = spark.readStream.schema("event_timestamp timestamp, cost_usd decimal(18,4)").parquet(feed)
        jobs.start_cost_alarms(events, log, state).awaitTermination()
        return [str(row["period_start"])[11:16] for row in jobs.current_alarms(spark, log).sort("period_start").collect()]

    assert arrives(("2024-01-01 10:01:00", 200.0), ("2024-01-01 10:06:00", 200.0)) == ["10:05"]
    assert arrives(("2024-01-01 10:07:00", 0.0)) == []  # the later mean falls to 100
    assert arrives(("2024-01-01 12:01:00", 200.0), ("2024-01-01 12:06:00", 200.0)) == ["12:05"]
    assert arrives(("2024-01-01 10:08:00", 900.0)) == ["12:05"]  # too late to count


def test_refresh_removes_days_without_telemetry(spark, sf_dir, tmp_path):
    telemetry, campaigns = fixtures.sourcing_telemetry(spark, sf_dir), fixtures.campaign_master(spark, sf_dir)
    path = str(tmp_path / "rollup")
    writers.refresh_rollup(telemetry, campaigns, path, "1997-03-01", "1997-03-04")
    gone = telemetry.filter("to_date(event_timestamp) <> date'1997-03-02'")
    writers.refresh_rollup(gone, campaigns, path, "1997-03-02", "1997-03-03")
    days = {str(row[0]) for row in spark.read.parquet(path).select("snapshot_date").distinct().collect()}
    assert days == {"1997-03-01", "1997-03-03", "1997-03-04"}


def test_a_repeated_registry_row_gives_no_second_alert(spark, sf_dir):
    telemetry, campaigns = fixtures.sourcing_telemetry(spark, sf_dir), fixtures.campaign_master(spark, sf_dir)
    registry = fixtures.channel_corridor_registry(spark)
    once = anomalies.detect_anomalies(telemetry, registry, campaigns).count()
    assert anomalies.detect_anomalies(telemetry, registry.unionByName(registry), campaigns).count() == once > 0
