"""Monthly use of corridor capacity against the registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from allocspark.functions import labels
from allocspark.functions.rounding import mean, ratio, rounded
from allocspark.schemas import CORRIDOR


def saturation_matrix(telemetry: DataFrame, registry: DataFrame) -> DataFrame:
    """One row per (month, corridor): utilisation, headroom, marginal hires and labels.

    Telemetry is aggregated before the join, so the join carries one row per month and
    corridor; the registry keys are unique, hence the result is that of joining first.
    """
    monthly = telemetry.groupBy(F.date_format("event_timestamp", "yyyy-MM").alias("report_month"), *CORRIDOR).agg(
        F.sum("allocated_applicants").alias("total_allocated_applicants"),
        rounded(F.sum("allocated_spend_usd"), 2).alias("total_spend_usd"),
        rounded(F.sum("projected_hires"), 1).alias("total_projected_hires"),
        rounded(mean(F.col("cost_per_applicant_usd")), 2).alias("effective_cpa_usd"),
        rounded(mean(F.col("overall_conversion_yield")), 5).alias("effective_conversion_yield"),
    )
    loaded = monthly.join(registry.select(*CORRIDOR, "saturation_capacity"), CORRIDOR)
    used, capacity = F.col("total_allocated_applicants"), F.col("saturation_capacity")
    analysed = loaded.select(
        "report_month", *CORRIDOR, "saturation_capacity", "total_allocated_applicants",
        "total_spend_usd", "total_projected_hires",
        rounded(ratio(used * 100, capacity), 2).alias("capacity_utilization_pct"),
        (capacity - used).alias("remaining_applicant_headroom"),
        rounded(F.col("effective_conversion_yield") * 100, 2).alias("marginal_hires_per_100_extra_capacity"),
        rounded(ratio(F.col("effective_cpa_usd"), F.col("effective_conversion_yield")), 2)
        .alias("corridor_cph_benchmark"),
    )
    utilization, benchmark = F.col("capacity_utilization_pct"), F.col("corridor_cph_benchmark")
    return analysed.withColumns({
        "channel_saturation_status": labels.saturation_status(utilization),
        "capacity_expansion_recommendation": labels.expansion_recommendation(utilization, benchmark),
    })


def ranked_saturation(matrix: DataFrame) -> DataFrame:
    return matrix.orderBy(
        F.desc("report_month"), F.col("capacity_utilization_pct").desc_nulls_first(),
        F.col("corridor_cph_benchmark").asc_nulls_last(), *CORRIDOR,
    )
