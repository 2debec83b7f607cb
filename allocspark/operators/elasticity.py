"""Month-over-month budget elasticity and the marginal price of a hire."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from allocspark.functions import labels
from allocspark.functions.rounding import exact, mean, ratio, rounded

SOURCED_CORRIDOR = ["sourcing_channel", "talent_region", "role_seniority"]


def monthly_funnel(history: DataFrame) -> DataFrame:
    """Applications, spend, interviews and hires per corridor and month of the active rows."""
    return (
        history.filter("is_active_corridor")
        .groupBy("corridor_id", *SOURCED_CORRIDOR, F.date_format("event_timestamp", "yyyy-MM").alias("calendar_month"))
        .agg(
            F.count("telemetry_id").alias("total_applications"),
            F.sum("cost_per_applicant_usd").alias("monthly_expenditure_usd"),
            mean(F.col("cost_per_applicant_usd")).alias("mean_cpa_usd"),
            F.count_if("passed_interview").alias("stage_interviews_passed"),
            F.count_if("hired_flag").alias("stage_hires_achieved"),
            mean(F.col("interview_yield_rate") * F.col("offer_acceptance_rate")).alias("empirical_conversion_yield"),
        )
    )


def elasticity_history(history: DataFrame) -> DataFrame:
    """Finite differences of each corridor-month against the corridor's previous month.

    The window runs on one row per corridor and month, so its partitions stay short.
    """
    months = Window.partitionBy("corridor_id").orderBy("calendar_month", *SOURCED_CORRIDOR)
    spend, hires = F.col("monthly_expenditure_usd"), F.col("stage_hires_achieved")
    prev_spend, prev_hires = F.col("prev_monthly_expenditure"), F.col("prev_stage_hires")
    moved = monthly_funnel(history).withColumns({
        "prev_monthly_expenditure": F.lag(spend).over(months),
        "prev_stage_hires": F.lag(hires).over(months),
    })
    more_spend, more_hires = spend - prev_spend, hires - prev_hires
    comparable = (prev_spend > 0) & (prev_hires > 0) & (more_spend > 0)
    differenced = moved.withColumns({
        "marginal_cph_usd": exact(
            F.when(more_hires > 0, ratio(more_spend, more_hires)).otherwise(ratio(spend, hires))),
        "sourcing_budget_elasticity": exact(
            F.when(comparable, ratio(ratio(more_hires, prev_hires), ratio(more_spend, prev_spend)))
            .otherwise(F.lit(1.0))),
    })
    marginal = F.col("marginal_cph_usd")
    return differenced.withColumns({
        "capital_efficiency_index": rounded(ratio(F.col("empirical_conversion_yield") * 1000, marginal), 4),
        "shadow_price_hires_per_k_usd": rounded(ratio(F.lit(1000.0), marginal), 3),
        "elasticity_regime": labels.elasticity_regime(F.col("sourcing_budget_elasticity")),
    })


def budget_elasticity(history: DataFrame) -> DataFrame:
    """Corridor summary: mean marginal price, elasticity, dominant regime and action."""
    summary = elasticity_history(history).groupBy(*SOURCED_CORRIDOR).agg(
        F.count_distinct("calendar_month").alias("observation_periods"),
        rounded(mean(F.col("monthly_expenditure_usd")), 2).alias("avg_monthly_expenditure_usd"),
        rounded(mean(F.col("stage_hires_achieved")), 1).alias("avg_monthly_hires"),
        mean(F.col("marginal_cph_usd")).alias("marginal"),
        rounded(mean(F.col("sourcing_budget_elasticity")), 4).alias("avg_budget_elasticity"),
        rounded(mean(F.col("shadow_price_hires_per_k_usd")), 3).alias("avg_shadow_price_k_usd"),
        F.mode("elasticity_regime", True).alias("dominant_elasticity_regime"),
    )
    return summary.select(
        *SOURCED_CORRIDOR, "observation_periods", "avg_monthly_expenditure_usd", "avg_monthly_hires",
        rounded(F.col("marginal"), 2).alias("blended_marginal_cph_usd"),
        "avg_budget_elasticity", "avg_shadow_price_k_usd", "dominant_elasticity_regime",
        labels.capital_action(F.col("dominant_elasticity_regime"), F.col("marginal"))
        .alias("strategic_capital_action"),
    )


def ranked_elasticity(summary: DataFrame) -> DataFrame:
    return summary.orderBy(
        F.col("avg_shadow_price_k_usd").desc_nulls_first(),
        F.col("blended_marginal_cph_usd").asc_nulls_last(), *SOURCED_CORRIDOR,
    )
