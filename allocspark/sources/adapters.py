"""Adapters between the three telemetry shapes, so that every report runs on what a user has stored.

Each is one projection, with at most one join to the corridor registry; the result has the
columns and types its shape declares. The registry is collapsed to a row per corridor (that with
the smallest id) and is left to Spark's own size check. A corridor the registry does not list, or
one with a null part, has no capacity and counts as inactive; no row is dropped or repeated.
What a shape cannot know is null, never guessed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from allocspark import schemas
from allocspark.functions.rounding import rounded
from allocspark.operators.corridors import OBSERVED_CORRIDOR, cost_per_hire
from allocspark.schemas import CORRIDOR


def _with_registry(telemetry: DataFrame, registry: DataFrame, corridor: list[str]) -> DataFrame:
    """``telemetry`` with ``_listed``: id, capacity and activity of its corridor, null if unlisted."""
    listed = registry.groupBy(*[F.col(ours).alias(theirs) for ours, theirs in zip(CORRIDOR, corridor)]).agg(
        F.min(F.struct("corridor_id", "saturation_capacity", "is_active")).alias("_listed"))
    return telemetry.join(listed, corridor, "left")


def _corridor_id(corridor: list[str]) -> Column:
    return F.coalesce("_listed.corridor_id", F.concat_ws("|", *corridor))


def _is_active() -> Column:
    return F.coalesce("_listed.is_active", F.lit(False))


def observations_from_telemetry(telemetry: DataFrame, registry: DataFrame) -> DataFrame:
    """Campaign telemetry as observations, which corridor metrics and every allocation start from.

    Capacity and activity are the registry's; the benchmark is the row's cost over its yield.
    """
    known = _with_registry(telemetry, registry, CORRIDOR)
    return known.select(
        F.col("telemetry_id").alias("allocation_id"), F.col("channel_name").alias("channel"), "region", "seniority",
        "cost_per_applicant_usd", F.col("_listed.saturation_capacity").alias("max_channel_capacity_applicants"),
        "interview_yield_rate", "offer_acceptance_rate", "overall_conversion_yield",
        cost_per_hire(F.col("cost_per_applicant_usd"), F.col("overall_conversion_yield")).alias("cost_per_hire_benchmark_usd"),
        _is_active().alias("is_active_corridor"), "event_timestamp",
    )


def channel_telemetry_from_telemetry(telemetry: DataFrame, registry: DataFrame) -> DataFrame:
    """Campaign telemetry as channel telemetry, which elasticity and attribution read.

    A row is a batch of applicants: it is hired if it has actual hires, and it passed the interview
    if it is hired or its rate lets at least one of its applicants pass.
    """
    hired = F.col("actual_hires") > 0
    known = _with_registry(telemetry, registry, CORRIDOR).select(
        "telemetry_id", _corridor_id(CORRIDOR).alias("corridor_id"),
        F.col("channel_name").alias("sourcing_channel"), F.col("region").alias("talent_region"),
        F.col("seniority").alias("role_seniority"), "event_timestamp", "cost_per_applicant_usd",
        "interview_yield_rate", "offer_acceptance_rate",
        (hired | (F.col("allocated_applicants") * F.col("interview_yield_rate") >= 1)).alias("passed_interview"),
        hired.alias("hired_flag"), _is_active().alias("is_active_corridor"),
    )
    return schemas.conform(known, schemas.SOURCING_CHANNEL_TELEMETRY)


def channel_telemetry_from_observations(observations: DataFrame, registry: DataFrame) -> DataFrame:
    """Observations as channel telemetry. Their own flag tells activity; outcomes are unknown, hence null."""
    known = _with_registry(observations, registry, OBSERVED_CORRIDOR).select(
        F.col("allocation_id").alias("telemetry_id"), _corridor_id(OBSERVED_CORRIDOR).alias("corridor_id"),
        F.col("channel").alias("sourcing_channel"), F.col("region").alias("talent_region"),
        F.col("seniority").alias("role_seniority"), "event_timestamp", "cost_per_applicant_usd",
        "interview_yield_rate", "offer_acceptance_rate", F.lit(None).alias("passed_interview"),
        F.lit(None).alias("hired_flag"), "is_active_corridor",
    )
    return schemas.conform(known, schemas.SOURCING_CHANNEL_TELEMETRY)


def telemetry_from_observations(observations: DataFrame, campaign_id: Column, applicants: Column) -> DataFrame:
    """Observations bought by a campaign as its telemetry, with spend and expected hires.

    ``campaign_id`` and ``applicants`` are expressions over the observations' columns. Null
    applicants are none; nothing has been hired yet.
    """
    bought = F.coalesce(applicants.cast("int"), F.lit(0))
    known = observations.withColumn("_bought", bought).select(
        F.col("allocation_id").alias("telemetry_id"), campaign_id.alias("campaign_id"),
        F.col("channel").alias("channel_name"), "region", "seniority", "cost_per_applicant_usd",
        F.col("_bought").alias("allocated_applicants"),
        (F.col("cost_per_applicant_usd") * F.col("_bought")).alias("allocated_spend_usd"),
        "interview_yield_rate", "offer_acceptance_rate", "overall_conversion_yield",
        rounded(F.col("_bought") * F.col("overall_conversion_yield"), 2).alias("projected_hires"),
        F.lit(0).alias("actual_hires"), "event_timestamp", F.col("event_timestamp").alias("created_at"),
    )
    return schemas.conform(known, schemas.SOURCING_TELEMETRY)
