"""Classification rules as CASE columns. Thresholds and label texts are fixed values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def efficiency_tier(cost_per_hire: Column, mean_yield: Column) -> Column:
    affordable = cost_per_hire <= 1200
    high_yield = mean_yield >= F.expr("0.08000")
    return (
        F.when(affordable & high_yield, "HIGH_YIELD_LOW_COST (STAR)")
        .when(affordable, "MODERATE_YIELD_AFFORDABLE")
        .when(high_yield, "HIGH_PRECISION_PREMIUM")
        .otherwise("LOW_YIELD_EXPENSIVE_BOTTLENECK")
    )


def pareto_status(dominated_by: Column) -> Column:
    return (
        F.when(dominated_by == 0, "PARETO_OPTIMAL_FRONTIER")
        .when(dominated_by <= 2, "NEAR_OPTIMAL_SECOND_TIER")
        .otherwise("SUB_OPTIMAL_DOMINATED")
    )


def saturation_status(utilization_pct: Column) -> Column:
    return (
        F.when(utilization_pct >= 95, "SEVERELY_SATURATED_HARD_BOTTLENECK")
        .when(utilization_pct >= 80, "CONGESTED_NEAR_CAPACITY")
        .when(utilization_pct <= 30, "UNDER_UTILIZED_SLACK_CAPACITY")
        .otherwise("OPTIMALLY_LOADED")
    )


def expansion_recommendation(utilization_pct: Column, cost_per_hire: Column) -> Column:
    congested = utilization_pct >= 80
    return (
        F.when(congested & (cost_per_hire <= 1500), "TIER_1_EXPANSION_TARGET (HIGH ROI)")
        .when(congested, "TIER_2_EXPANSION_SELECTIVE")
        .otherwise("MAINTAIN_CURRENT_LIMITS")
    )


def elasticity_regime(elasticity: Column) -> Column:
    """The open gaps (1.19, 1.20) and (0.79, 0.80) fall through to the last label on purpose."""
    return (
        F.when(elasticity >= F.expr("1.20"), "ELASTIC_HIGH_SCALE")
        .when(elasticity.between(F.expr("0.80"), F.expr("1.19")), "CONSTANT_RETURNS")
        .when(elasticity.between(F.expr("0.30"), F.expr("0.79")), "INELASTIC_SATURATING")
        .otherwise("DECREASING_CAPITAL_TRAP")
    )


def capital_action(regime: Column, marginal_cost: Column) -> Column:
    saturating = regime.isin("INELASTIC_SATURATING", "DECREASING_CAPITAL_TRAP")
    return (
        F.when((regime == "ELASTIC_HIGH_SCALE") & (marginal_cost < 250), "PRIORITY_AGGRESSIVE_EXPANSION")
        .when((regime == "CONSTANT_RETURNS") & (marginal_cost < 400), "SUSTAIN_OPTIMAL_LP_QUOTA")
        .when(saturating | (marginal_cost >= 400), "THROTTLE_ALLOCATION_TO_CAPACITY_BOUND")
        .otherwise("RE-BENCHMARK_INTERVIEW_PASS_RATE")
    )


def funnel_archetype(first_touch: Column, last_touch: Column, absorption: Column) -> Column:
    return (
        F.when(first_touch > last_touch * F.expr("1.5"), "TOP_FUNNEL_DISCOVERY")
        .when(last_touch > first_touch * F.expr("1.5"), "BOTTOM_FUNNEL_CLOSER")
        .when(absorption >= F.expr("0.15"), "CORE_CONVERSION_PILLAR")
        .otherwise("MID_FUNNEL_NURTURE")
    )


def longitudinal_tier(quartile: Column, conversion_yield: Column) -> Column:
    return (
        F.when((quartile == 1) & (conversion_yield >= F.expr("0.08")), "OPTIMAL_HIGH_PERFORMER")
        .when((quartile == 4) & (conversion_yield <= F.expr("0.03")), "CHRONIC_COST_INEFFICIENCY")
        .when(quartile.isin(2, 3), "NOMINAL_OPERATIONAL_BAND")
        .otherwise("STABLE_AVERAGE")
    )


def allocation_status(applicants: Column, capacity: Column) -> Column:
    return (
        F.when((applicants > 0) & (applicants >= capacity * F.expr("0.99")), "CAPACITY_SATURATED")
        .when(applicants > 0, "OPTIMAL_ACTIVE")
        .otherwise("ZERO_ALLOCATED")
    )


def escalation_tier(surge: Column, conversion_yield: Column) -> Column:
    critical = (surge >= 2) | (conversion_yield <= F.expr("0.00200"))
    return F.when(critical, "P1_CRITICAL_BUDGET_DRAIN").otherwise("P2_ELEVATED_DRIFT_WARNING")


def recommended_action(surge: Column) -> Column:
    return F.when(
        surge >= 2, "Immediate Channel Throttling & Reallocate to Talent Network"
    ).otherwise("Adjust Linear Optimization Channel Upper Bound")
