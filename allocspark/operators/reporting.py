"""Executive tables over allocation lines and campaign results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from allocspark.functions import labels
from allocspark.functions.rounding import ratio, rounded
from allocspark.operators.corridors import OBSERVED_CORRIDOR

# Agency fee saved per extra hire, and the fallback capacity of an unknown corridor.
AGENCY_FEE_USD = 5000
FALLBACK_CAPACITY = 1000


def allocation_rollup(lines: DataFrame) -> DataFrame:
    """Budget, hires, their shares and unit cost per channel, region and seniority of a campaign.

    The three groupings come from one pass over the lines.
    """
    sets = [[F.col("campaign_id"), F.col(dimension)] for dimension in OBSERVED_CORRIDOR]
    grouped = lines.groupingSets(sets, "campaign_id", *OBSERVED_CORRIDOR).agg(
        *[F.grouping(dimension).alias(f"without_{dimension}") for dimension in OBSERVED_CORRIDOR],
        F.sum("allocated_budget_usd").alias("budget_usd"),
        F.sum("expected_hires").alias("hires"),
    )
    dimension = F.coalesce(*[
        F.when(F.col(f"without_{name}") == 0, F.lit(name)) for name in OBSERVED_CORRIDOR])
    named = grouped.select(
        "campaign_id", dimension.alias("dimension"), F.coalesce(*OBSERVED_CORRIDOR).alias("member"),
        "budget_usd", "hires",
    )
    whole = Window.partitionBy("campaign_id", "dimension")  # at most five members

    def share(column: str) -> Column:
        return rounded(ratio(F.col(column), F.greatest(F.sum(column).over(whole), F.lit(1))), 6)

    return named.select(
        "campaign_id", "dimension", "member", "budget_usd", share("budget_usd").alias("budget_share"),
        "hires", share("hires").alias("hires_share"),
        rounded(ratio(F.col("budget_usd"), F.greatest(F.col("hires"), F.expr("0.001"))), 2)
        .alias("effective_cph_usd"),
    )


#: The reports' orders: ascending SQL expressions.
ROLLUP_ORDER = ["campaign_id", "dimension", "member"]
SCHEDULE_ORDER = ["campaign_id", "-allocated_budget_usd", "-expected_hires", *OBSERVED_CORRIDOR]


def sorted_rollup(rollup: DataFrame) -> DataFrame:
    return rollup.orderBy("campaign_id", "dimension", "member")


def named_measures(results: DataFrame) -> DataFrame:
    """Budget, hires, blended unit cost, gain and the senior share of hires per campaign."""
    hires = F.col("total_projected_hires")
    return results.select(
        "campaign_id", F.col("total_allocated_applicants").alias("total_applicants"),
        F.col("total_budget_allocated_usd").alias("allocated_budget_usd"),
        hires.alias("total_expected_hires"),
        rounded(ratio(F.col("total_budget_allocated_usd"), hires), 2).alias("blended_cph_usd"),
        "efficiency_gain_pct",
        F.coalesce(rounded(ratio(F.col("senior_hires"), hires), 6), F.lit(0)).alias("senior_staff_ratio"),
    )


def grand_totals(lines: DataFrame) -> DataFrame:
    """Applicants, budget, hires and unit cost over all campaigns."""
    return lines.agg(
        F.count_distinct("campaign_id").alias("campaigns"),
        F.sum("allocated_applicants").alias("total_applicants"),
        F.sum("allocated_budget_usd").alias("total_budget_usd"),
        F.sum("expected_hires").alias("total_hires"),
        rounded(ratio(F.sum("allocated_budget_usd"), F.sum("expected_hires")), 2).alias("blended_cph_usd"),
    )


def executive_variance(results: DataFrame) -> DataFrame:
    """Five measures of each campaign: pro-rata value, optimal value, variance and delta."""
    spend, hires = F.col("total_budget_allocated_usd"), F.col("total_projected_hires")
    naive = F.col("naive_heuristic_hires")
    # The pro-rata unit cost is shown for the money the optimal plan spends. Names of the measures.
    rows = [
        ("Total Campaign Sourcing Budget ($)", spend, spend),
        ("Aggregate Qualified Hires Delivered", naive, hires),
        ("Blended Cost per Hire (CPH, $)", ratio(spend, F.greatest(naive, F.lit(1))),
         F.col("blended_cost_per_hire_usd")),
        ("Budget Utilization Rate (%)", F.lit(1.0), ratio(F.col("budget_utilization_pct"), F.lit(100))),
        ("Recruitment Agency Fee Avoidance ($)", F.lit(0.0), (hires - naive) * AGENCY_FEE_USD),
    ]
    table = F.array(*[
        F.struct(F.lit(place).alias("line"), F.lit(metric).alias("metric"),
                 rounded(before, 6).cast("decimal(28,6)").alias("status_quo"),
                 rounded(after, 6).cast("decimal(28,6)").alias("optimal"))
        for place, (metric, before, after) in enumerate(rows, 1)
    ])
    before, after = F.col("row.status_quo"), F.col("row.optimal")
    return results.select("campaign_id", F.explode(table).alias("row")).select(
        "campaign_id", "row.line", "row.metric", "row.status_quo", "row.optimal",
        (after - before).alias("absolute_variance"),
        F.when(before == 0, 0).otherwise(rounded(ratio(after - before, before), 6)).alias("efficiency_delta"),
    )


def kpi_cards(results: DataFrame) -> DataFrame:
    """The five headline figures of a campaign with their sub-values."""
    spend, naive = F.col("total_budget_allocated_usd"), F.col("naive_heuristic_hires")
    best_cost = F.col("blended_cost_per_hire_usd")
    naive_cost = ratio(spend, F.greatest(naive, F.lit(1)))
    return results.select(
        "campaign_id", spend.alias("sourcing_budget_usd"),
        naive.alias("status_quo_hires"), rounded(naive_cost, 2).alias("status_quo_cph_usd"),
        F.col("total_projected_hires").alias("optimal_hires"), best_cost.alias("optimal_cph_usd"),
        (F.col("total_projected_hires") - naive).alias("hires_gain"), "efficiency_gain_pct",
        rounded(naive_cost - best_cost, 2).alias("cph_reduction_usd"),
        rounded(ratio((naive_cost - best_cost) * 100, naive_cost), 2).alias("cph_reduction_pct"),
    )


def allocation_schedule(lines: DataFrame, metrics: DataFrame | None = None) -> DataFrame:
    """Every line with its corridor's unit cost, yield and capacity, and how loaded it is.

    Lines carry these from the plan they come from, so no telemetry is read again. ``metrics``, one
    row per corridor, is for other figures than the plan's, such as a later month's.
    A corridor without figures shows the line's own averages.
    """
    applicants = F.col("allocated_applicants")
    each = F.greatest(applicants, F.lit(1))
    capacity = F.coalesce("known_capacity", F.lit(FALLBACK_CAPACITY))
    figures = {"known_cost": "unit_cost_usd", "known_yield": "unit_yield", "known_capacity": "unit_capacity"}
    if metrics is None:
        known = lines.withColumns({name: F.col(own) for name, own in figures.items()})
    else:
        known = lines.drop(*figures.values()).join(metrics.select(
            *OBSERVED_CORRIDOR, F.col("cost_per_applicant_usd").alias("known_cost"),
            F.col("overall_conversion_yield").alias("known_yield"),
            F.col("max_channel_capacity_applicants").alias("known_capacity"),
        ), OBSERVED_CORRIDOR, "left")
    return known.select(
        "campaign_id", *OBSERVED_CORRIDOR,
        rounded(F.coalesce(F.col("known_cost").cast("double"), ratio(F.col("allocated_budget_usd"), each)), 2)
        .alias("unit_cpa_usd"),
        rounded(F.coalesce(F.col("known_yield").cast("double"), ratio(F.col("expected_hires"), each)), 8)
        .alias("conversion_yield"),
        capacity.alias("monthly_capacity"),
        "allocated_applicants", "allocated_budget_usd", "expected_hires", "effective_cost_per_hire_usd",
        labels.allocation_status(applicants, capacity).alias("allocation_status"),
    )


def sorted_schedule(schedule: DataFrame) -> DataFrame:
    return schedule.orderBy(
        "campaign_id", F.desc("allocated_budget_usd"), F.desc("expected_hires"), *OBSERVED_CORRIDOR)
