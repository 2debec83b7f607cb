"""Explicit schemas and closed domains of the recruitment-telemetry data model."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

CORRIDOR = ["channel_name", "region", "seniority"]

# The closed domains of the data model.
CHANNELS = [
    "Programmatic Job Boards",
    "Direct AI Sourcing",
    "Sponsored Campaigns",
    "Talent Network Pool",
    "Executive Headhunting",
]
REGIONS = ["LATAM", "EMEA", "North America", "APAC"]
SENIORITIES = ["Junior Specialist", "Mid-Level Engineer", "Senior Lead", "Staff Architect"]
SENIOR_LEVELS = ["Senior Lead", "Staff Architect"]


# Parquet telemetry as delivered: event time is text and is parsed by the reader.
RAW_OBSERVATIONS = T.StructType([
    T.StructField("allocation_id", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("seniority", T.StringType()),
    T.StructField("cost_per_applicant_usd", T.DoubleType()),
    T.StructField("max_channel_capacity_applicants", T.IntegerType()),
    T.StructField("interview_yield_rate", T.DoubleType()),
    T.StructField("offer_acceptance_rate", T.DoubleType()),
    T.StructField("overall_conversion_yield", T.DoubleType()),
    T.StructField("cost_per_hire_benchmark_usd", T.DoubleType()),
    T.StructField("is_active_corridor", T.BooleanType()),
    T.StructField("event_timestamp", T.StringType()),
])

CAMPAIGN_MASTER = T.StructType([
    T.StructField("campaign_id", T.StringType()),
    T.StructField("client_name", T.StringType()),
    T.StructField("total_budget_usd", T.DecimalType(12, 2)),
    T.StructField("target_hires", T.IntegerType()),
    T.StructField("min_senior_hires", T.IntegerType()),
    T.StructField("max_cph_target_usd", T.DecimalType(10, 2)),
    T.StructField("regional_diversity_min_pct", T.DecimalType(5, 4)),
    T.StructField("is_active", T.BooleanType()),
    T.StructField("created_at", T.TimestampType()),
])

CHANNEL_CORRIDOR_REGISTRY = T.StructType([
    T.StructField("corridor_id", T.StringType()),
    T.StructField("channel_name", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("seniority", T.StringType()),
    T.StructField("baseline_cpa_usd", T.DecimalType(8, 2)),
    T.StructField("saturation_capacity", T.IntegerType()),
    T.StructField("expected_interview_yield", T.DecimalType(6, 4)),
    T.StructField("expected_offer_acceptance", T.DecimalType(6, 4)),
    T.StructField("is_active", T.BooleanType()),
    T.StructField("updated_at", T.TimestampType()),
])

SOURCING_TELEMETRY = T.StructType([
    T.StructField("telemetry_id", T.StringType()),
    T.StructField("campaign_id", T.StringType()),
    T.StructField("channel_name", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("seniority", T.StringType()),
    T.StructField("cost_per_applicant_usd", T.DecimalType(8, 2)),
    T.StructField("allocated_applicants", T.IntegerType()),
    T.StructField("allocated_spend_usd", T.DecimalType(12, 2)),
    T.StructField("interview_yield_rate", T.DecimalType(6, 4)),
    T.StructField("offer_acceptance_rate", T.DecimalType(6, 4)),
    T.StructField("overall_conversion_yield", T.DecimalType(8, 5)),
    T.StructField("projected_hires", T.DecimalType(8, 2)),
    T.StructField("actual_hires", T.IntegerType()),
    T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("created_at", T.TimestampType()),
])

SOURCING_CHANNEL_TELEMETRY = T.StructType([
    T.StructField("telemetry_id", T.StringType()),
    T.StructField("corridor_id", T.StringType()),
    T.StructField("sourcing_channel", T.StringType()),
    T.StructField("talent_region", T.StringType()),
    T.StructField("role_seniority", T.StringType()),
    T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("cost_per_applicant_usd", T.DecimalType(8, 2)),
    T.StructField("interview_yield_rate", T.DecimalType(6, 4)),
    T.StructField("offer_acceptance_rate", T.DecimalType(6, 4)),
    T.StructField("passed_interview", T.BooleanType()),
    T.StructField("hired_flag", T.BooleanType()),
    T.StructField("is_active_corridor", T.BooleanType()),
])

OPTIMIZATION_RUNS_AUDIT = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("campaign_id", T.StringType()),
    T.StructField("solver_status", T.StringType()),
    T.StructField("total_budget_usd", T.DecimalType(12, 2)),
    T.StructField("allocated_budget_usd", T.DecimalType(12, 2)),
    T.StructField("budget_utilization_pct", T.DecimalType(5, 2)),
    T.StructField("projected_hires", T.DecimalType(14, 2)),
    T.StructField("blended_cost_per_hire_usd", T.DecimalType(14, 2)),
    T.StructField("naive_heuristic_hires", T.DecimalType(14, 2)),
    T.StructField("efficiency_gain_pct", T.DecimalType(14, 2)),
    T.StructField("solve_time_ms", T.DecimalType(8, 2)),
    T.StructField("executed_at", T.TimestampType()),
])

SOURCING_ANOMALY_AUDIT_LOG = T.StructType([
    T.StructField("anomaly_id", T.StringType()),
    T.StructField("campaign_id", T.StringType()),
    T.StructField("channel_name", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("seniority", T.StringType()),
    T.StructField("observed_cpa_usd", T.DecimalType(8, 2)),
    T.StructField("baseline_cpa_usd", T.DecimalType(8, 2)),
    T.StructField("observed_yield", T.DecimalType(8, 5)),
    T.StructField("escalation_tier", T.StringType()),
    T.StructField("alert_payload", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

TABLES = {
    "campaign_master": CAMPAIGN_MASTER,
    "channel_corridor_registry": CHANNEL_CORRIDOR_REGISTRY,
    "sourcing_telemetry": SOURCING_TELEMETRY,
    "sourcing_channel_telemetry": SOURCING_CHANNEL_TELEMETRY,
    "optimization_runs_audit": OPTIMIZATION_RUNS_AUDIT,
    "sourcing_anomaly_audit_log": SOURCING_ANOMALY_AUDIT_LOG,
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, in its order and types."""
    return df.select(*[F.col(field.name).cast(field.dataType).alias(field.name) for field in schema])
