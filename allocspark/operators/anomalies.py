"""Cost-surge and conversion-collapse detection; one transform for batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from allocspark.functions import labels
from allocspark.functions.rounding import ratio, rounded
from allocspark.schemas import CORRIDOR

# Fallbacks, alert thresholds and the alert's event text.
FALLBACK_BASELINE_USD = "40.00"
FALLBACK_CLIENT = "Enterprise Client"
SURGE_THRESHOLD = "1.45"
YIELD_COLLAPSE = "0.00500"
EVENT_TEXT = "Sourcing Corridors Anomaly Triggered"


def detect_anomalies(telemetry: DataFrame, registry: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Alerts for observations whose cost surges over the corridor baseline or whose yield collapses.

    Stateless, so it takes a batch or a streaming frame. A corridor registered more than once
    counts with its lowest baseline, so no observation gives two alerts. Campaign names join
    after the filter, so only alerts are shuffled when that table is large.
    """
    baselines = registry.groupBy(*CORRIDOR).agg(F.min("baseline_cpa_usd").alias("known_baseline"))
    baseline = F.coalesce("known_baseline", F.lit(FALLBACK_BASELINE_USD).cast("decimal(8,2)"))
    measured = telemetry.join(baselines, CORRIDOR, "left").withColumn(
        "baseline_cpa_usd", baseline
    ).withColumn(
        "surge_multiplier", rounded(ratio(F.col("cost_per_applicant_usd"), F.col("baseline_cpa_usd")), 2)
    )
    surge, conversion = F.col("surge_multiplier"), F.col("overall_conversion_yield")
    alerts = measured.filter((surge >= F.expr(SURGE_THRESHOLD)) | (conversion <= F.expr(YIELD_COLLAPSE)))
    named = alerts.join(campaigns.select("campaign_id", "client_name"), "campaign_id", "left")
    return named.select(
        "telemetry_id", "campaign_id", *CORRIDOR, "event_timestamp",
        F.col("cost_per_applicant_usd").alias("observed_cpa_usd"),
        "baseline_cpa_usd",
        conversion.alias("observed_yield"),
        labels.escalation_tier(surge, conversion).alias("escalation_tier"),
        F.struct(
            F.lit(EVENT_TEXT).alias("event"),
            F.col("campaign_id"),
            F.coalesce("client_name", F.lit(FALLBACK_CLIENT)).alias("client_name"),
            F.col("channel_name").alias("channel"),
            F.concat_ws(" - ", "region", "seniority").alias("corridor"),
            F.col("cost_per_applicant_usd").alias("cpa_observed"),
            F.col("baseline_cpa_usd").alias("cpa_baseline"),
            surge.alias("surge_multiplier"),
            conversion.alias("conversion_yield"),
            labels.recommended_action(surge).alias("recommended_action"),
        ).alias("alert_payload"),
    )


def payload_json(alerts: DataFrame) -> DataFrame:
    """The payload as JSON text that keeps keys whose value is null."""
    return alerts.withColumn("alert_payload", F.to_json("alert_payload", {"ignoreNullFields": "false"}))
