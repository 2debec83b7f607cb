"""Adapters between the telemetry shapes: declared columns, no row lost or repeated, nothing guessed."""

import pytest
from pyspark.sql import functions as F

from allocspark import schemas
from allocspark.operators import allocation, attribution, corridors, elasticity
from allocspark.sources import adapters, fixtures
from tests.oracle import canonical


def rows(df):
    return canonical(df.columns, df.collect())


@pytest.fixture
def registry(spark):
    """One corridor listed twice, one inactive, all others not at all."""
    listed = [("b", "Direct AI Sourcing", "EMEA", "Senior Lead", 20, True), ("a", "Direct AI Sourcing", "EMEA", "Senior Lead", 10, True),
              ("c", "Talent Network Pool", "APAC", "Senior Lead", 30, False)]
    return spark.createDataFrame(
        listed, "corridor_id string, channel_name string, region string, seniority string, saturation_capacity int, is_active boolean")


@pytest.fixture
def telemetry(spark):
    given = [
        ("t1", "Direct AI Sourcing", "EMEA", "Senior Lead", 40, "0.1000", "0.05000", 0),
        ("t1", "Direct AI Sourcing", "EMEA", "Senior Lead", 40, "0.1000", "0.05000", 0),  # repeated
        ("t2", "Direct AI Sourcing", "EMEA", "Senior Lead", 9, "0.1000", "0.00000", 0),
        ("t3", "Talent Network Pool", "APAC", "Senior Lead", 1, "0.1000", "0.05000", 2),
        ("t4", "Carrier Pigeon", "APAC", "Senior Lead", 100, "0.1000", "0.05000", None),
        ("t5", None, "APAC", None, None, None, None, None),
    ]
    frame = spark.createDataFrame(given, """telemetry_id string, channel_name string, region string, seniority string, allocated_applicants int,
        interview_yield_rate string, overall_conversion_yield string, actual_hires int""")
    return schemas.conform(frame.withColumns({
        "campaign_id": F.lit("C1"), "cost_per_applicant_usd": F.lit("10.00"), "allocated_spend_usd": F.lit("1.00"),
        "offer_acceptance_rate": F.lit("0.5000"), "projected_hires": F.lit("1.00"),
        "event_timestamp": F.lit("2026-01-02 03:04:05"), "created_at": F.lit("2026-01-02 03:04:05"),
    }), schemas.SOURCING_TELEMETRY)


def test_observations_take_capacity_and_activity_from_the_registry(telemetry, registry):
    found = adapters.observations_from_telemetry(telemetry, registry)
    assert found.columns == schemas.RAW_OBSERVATIONS.fieldNames()
    given = sorted((r["allocation_id"], r["max_channel_capacity_applicants"], r["is_active_corridor"]) for r in found.select(
        "allocation_id", F.coalesce("max_channel_capacity_applicants", F.lit(-1)).alias("max_channel_capacity_applicants"), "is_active_corridor").collect())
    assert given == [("t1", 10, True), ("t1", 10, True), ("t2", 10, True), ("t3", 30, False), ("t4", -1, False), ("t5", -1, False)]
    prices = {r["allocation_id"]: r["cost_per_hire_benchmark_usd"] for r in found.collect()}
    assert prices["t1"] == 200.0 and prices["t2"] == float("inf") and prices["t5"] is None


def test_channel_telemetry_of_batches(telemetry, registry):
    found = adapters.channel_telemetry_from_telemetry(telemetry, registry)
    assert found.schema.simpleString() == schemas.SOURCING_CHANNEL_TELEMETRY.simpleString()
    outcome = {r["telemetry_id"]: (r["corridor_id"], r["passed_interview"], r["hired_flag"], r["is_active_corridor"]) for r in found.collect()}
    assert found.count() == 6 and outcome == {
        "t1": ("a", True, False, True), "t2": ("a", False, False, True), "t3": ("c", True, True, False),
        "t4": ("Carrier Pigeon|APAC|Senior Lead", True, None, False), "t5": ("APAC", None, None, False)}


def test_outcomes_of_observations_are_unknown(telemetry, registry):
    observations = adapters.observations_from_telemetry(telemetry, registry).withColumn("is_active_corridor", F.lit(True))
    found = adapters.channel_telemetry_from_observations(observations, registry)
    assert found.schema.simpleString() == schemas.SOURCING_CHANNEL_TELEMETRY.simpleString()
    assert found.count() == 6 == found.where("passed_interview is null and hired_flag is null and is_active_corridor").count()
    assert {r["corridor_id"] for r in found.collect()} == {"a", "c", "Carrier Pigeon|APAC|Senior Lead", "APAC"}


def test_there_and_back(spark, sf_dir):
    """Observations of telemetry, bought again, are the telemetry."""
    telemetry = schemas.conform(fixtures.sourcing_telemetry(spark, sf_dir).withColumns({
        "actual_hires": F.lit(0), "created_at": F.col("event_timestamp")}), schemas.SOURCING_TELEMETRY)
    observations = adapters.observations_from_telemetry(telemetry, fixtures.channel_corridor_registry(spark))
    bought = telemetry.select(F.col("telemetry_id").alias("allocation_id"), "campaign_id", "allocated_applicants")
    again = adapters.telemetry_from_observations(observations.join(bought, "allocation_id"), F.col("campaign_id"), F.col("allocated_applicants"))
    assert again.schema.simpleString() == schemas.SOURCING_TELEMETRY.simpleString()
    assert rows(again) == rows(telemetry)


def test_reports_run_on_adapted_tables(spark, sf_dir):
    telemetry = fixtures.sourcing_telemetry(spark, sf_dir).withColumns({
        "actual_hires": F.expr("cast(floor(projected_hires) as int)"), "created_at": F.col("event_timestamp")})
    registry = fixtures.channel_corridor_registry(spark)
    program = allocation.corridor_program(corridors.corridor_metrics(adapters.observations_from_telemetry(telemetry, registry)))
    plan = allocation.greedy_plan(allocation.pro_rata(fixtures.campaign_master(spark, sf_dir), program), program)
    assert allocation.campaign_results(allocation.integer_allocations(plan)).where("total_projected_hires > 0").count()
    history = adapters.channel_telemetry_from_telemetry(telemetry, registry)
    assert attribution.touch_paths(history).count() == telemetry.count()
    assert elasticity.monthly_funnel(history).agg(F.sum("stage_hires_achieved")).first()[0] == telemetry.where("actual_hires > 0").count()


def test_empty_tables(spark, telemetry, registry):
    nothing, unlisted = telemetry.limit(0), registry.limit(0)
    observations = adapters.observations_from_telemetry(nothing, registry)
    assert observations.count() == adapters.channel_telemetry_from_observations(observations, unlisted).count() == 0
    assert adapters.telemetry_from_observations(observations, F.lit("C"), F.lit(None)).count() == 0
    assert adapters.channel_telemetry_from_telemetry(telemetry, unlisted).where("not is_active_corridor").count() == 6
