"""Branches of the classification and data-quality rules on hand-made rows."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from allocspark.functions import labels
from allocspark.functions.rounding import as_double
from allocspark.operators import anomalies, attribution, elasticity, pareto, quality, reporting
from allocspark.streaming.alarms import cost_surge_alarms


def label(spark, column, **values):
    row = spark.range(1).select(*[F.expr(f"cast({v} as decimal(20,5))").alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("cph, rate, expected", [
    ("1200", "0.08", "HIGH_YIELD_LOW_COST (STAR)"), ("1200", "0.0799", "MODERATE_YIELD_AFFORDABLE"),
    ("1200.01", "0.08", "HIGH_PRECISION_PREMIUM"), ("null", "0.01", "LOW_YIELD_EXPENSIVE_BOTTLENECK"),
    ("null", "0.09", "HIGH_PRECISION_PREMIUM")])
def test_efficiency_tier(spark, cph, rate, expected):
    assert label(spark, labels.efficiency_tier(F.col("c"), F.col("y")), c=cph, y=rate) == expected


@pytest.mark.parametrize("pct, status, advice", [
    ("95", "SEVERELY_SATURATED_HARD_BOTTLENECK", "TIER_1_EXPANSION_TARGET (HIGH ROI)"),
    ("80", "CONGESTED_NEAR_CAPACITY", "TIER_1_EXPANSION_TARGET (HIGH ROI)"),
    ("30", "UNDER_UTILIZED_SLACK_CAPACITY", "MAINTAIN_CURRENT_LIMITS"),
    ("30.01", "OPTIMALLY_LOADED", "MAINTAIN_CURRENT_LIMITS"), ("null", "OPTIMALLY_LOADED", "MAINTAIN_CURRENT_LIMITS")])
def test_saturation(spark, pct, status, advice):
    assert label(spark, labels.saturation_status(F.col("p")), p=pct) == status
    assert label(spark, labels.expansion_recommendation(F.col("p"), F.col("c")), p=pct, c="1500") == advice
    if advice.startswith("TIER_1"):
        assert label(spark, labels.expansion_recommendation(F.col("p"), F.col("c")), p=pct, c="1500.01") == \
            "TIER_2_EXPANSION_SELECTIVE"


@pytest.mark.parametrize("value, expected", [
    ("1.2", "ELASTIC_HIGH_SCALE"), ("1.195", "DECREASING_CAPITAL_TRAP"), ("1.19", "CONSTANT_RETURNS"),
    ("0.8", "CONSTANT_RETURNS"), ("0.795", "DECREASING_CAPITAL_TRAP"), ("0.79", "INELASTIC_SATURATING"),
    ("0.3", "INELASTIC_SATURATING"), ("0.29", "DECREASING_CAPITAL_TRAP"), ("-1", "DECREASING_CAPITAL_TRAP")])
def test_elasticity_regime(spark, value, expected):
    assert label(spark, labels.elasticity_regime(F.col("e")), e=value) == expected


@pytest.mark.parametrize("regime, cost, expected", [
    ("ELASTIC_HIGH_SCALE", "249.99", "PRIORITY_AGGRESSIVE_EXPANSION"),
    ("ELASTIC_HIGH_SCALE", "250", "RE-BENCHMARK_INTERVIEW_PASS_RATE"),
    ("ELASTIC_HIGH_SCALE", "400", "THROTTLE_ALLOCATION_TO_CAPACITY_BOUND"),
    ("CONSTANT_RETURNS", "399", "SUSTAIN_OPTIMAL_LP_QUOTA"),
    ("INELASTIC_SATURATING", "null", "THROTTLE_ALLOCATION_TO_CAPACITY_BOUND"),
    ("CONSTANT_RETURNS", "null", "RE-BENCHMARK_INTERVIEW_PASS_RATE")])
def test_capital_action(spark, regime, cost, expected):
    assert label(spark, labels.capital_action(F.lit(regime), F.col("m")), m=cost) == expected


@pytest.mark.parametrize("first, last, rate, expected", [
    ("16", "10", "0", "TOP_FUNNEL_DISCOVERY"), ("10", "16", "0", "BOTTOM_FUNNEL_CLOSER"),
    ("15", "10", "0.15", "CORE_CONVERSION_PILLAR"), ("10", "10", "0.14", "MID_FUNNEL_NURTURE")])
def test_funnel_archetype(spark, first, last, rate, expected):
    assert label(spark, labels.funnel_archetype(F.col("f"), F.col("l"), F.col("a")), f=first, l=last, a=rate) == expected


@pytest.mark.parametrize("quartile, rate, expected", [
    ("1", "0.08", "OPTIMAL_HIGH_PERFORMER"), ("1", "0.07", "STABLE_AVERAGE"), ("4", "0.03", "CHRONIC_COST_INEFFICIENCY"),
    ("4", "0.04", "STABLE_AVERAGE"), ("2", "0.9", "NOMINAL_OPERATIONAL_BAND"), ("3", "0.01", "NOMINAL_OPERATIONAL_BAND")])
def test_longitudinal_tier(spark, quartile, rate, expected):
    assert label(spark, labels.longitudinal_tier(F.col("q"), F.col("y")), q=quartile, y=rate) == expected


def test_rounding_ties_go_away_from_zero(spark):
    row = spark.range(1).select(as_double(F.lit(1.005), 2).alias("a"), as_double(F.lit(-2.5), 0).alias("b")).first()
    assert (row["a"], row["b"]) == (1.01, -3.0)


def _alerts(spark, cost, rate, channel="Talent Network Pool", campaign="known"):
    telemetry = spark.createDataFrame(
        [("t", campaign, channel, "LATAM", "Senior Lead", Decimal(cost), Decimal(rate))],
        "telemetry_id string, campaign_id string, channel_name string, region string, seniority string,"
        " cost_per_applicant_usd decimal(8,2), overall_conversion_yield decimal(8,5)",
    ).withColumn("event_timestamp", F.lit("2026-01-01").cast("timestamp"))
    registry = spark.createDataFrame([("Talent Network Pool", "LATAM", "Senior Lead", Decimal("100"))],
                                     "channel_name string, region string, seniority string, baseline_cpa_usd decimal(8,2)")
    campaigns = spark.createDataFrame([("known", "Acme")], "campaign_id string, client_name string")
    return anomalies.detect_anomalies(telemetry, registry, campaigns).collect()


def test_anomaly_branches(spark):
    assert _alerts(spark, "144.49", "0.00501") == []
    rounded_up = _alerts(spark, "144.50", "0.1")[0]  # ratio is rounded before it is compared
    assert rounded_up["escalation_tier"] == "P2_ELEVATED_DRIFT_WARNING"
    assert rounded_up["alert_payload"]["surge_multiplier"] == Decimal("1.45")
    assert _alerts(spark, "200", "0.1")[0]["escalation_tier"] == "P1_CRITICAL_BUDGET_DRAIN"
    yield_only = _alerts(spark, "90", "0.002")[0]
    assert yield_only["escalation_tier"] == "P1_CRITICAL_BUDGET_DRAIN"
    assert yield_only["alert_payload"]["recommended_action"].startswith("Adjust")
    fallback = _alerts(spark, "80", "0.1", channel="Direct AI Sourcing", campaign="other")[0]
    assert fallback["baseline_cpa_usd"] == Decimal("40.00")
    assert fallback["alert_payload"]["client_name"] == "Enterprise Client"


def test_dominance_counts_with_ties(spark):
    points = [(1, 5), (1, 5), (1, 4), (2, 5), (2, 6), (3, 6), (3, 1), (0, 0), (9, 9)]
    df = spark.createDataFrame(points, "cost int, gain int")
    counted = {(r["cost"], r["gain"]): r["dominated_by_count"]
               for r in pareto.dominance_counts(df, "cost", "gain").collect()}
    for cost, gain in set(points):
        worse_than = sum(c <= cost and g >= gain and (c, g) != (cost, gain) for c, g in points)
        assert counted[cost, gain] == worse_than


def test_mode_ties_take_the_lowest_regime(spark):
    rows = [("a", "x", "r", "s", f"2026-0{m}-01", Decimal(c), h) for m, c, h in
            [(1, "100", True), (2, "100", True), (3, "200", True)]]
    history = spark.createDataFrame(
        rows, "corridor_id string, sourcing_channel string, talent_region string, role_seniority string,"
        " d string, cost_per_applicant_usd decimal(8,2), hired_flag boolean",
    ).withColumns({"event_timestamp": F.col("d").cast("timestamp"), "telemetry_id": F.col("d"),
                   "passed_interview": F.lit(True), "is_active_corridor": F.lit(True),
                   "interview_yield_rate": F.lit("0.5").cast("decimal(6,4)"),
                   "offer_acceptance_rate": F.lit("0.5").cast("decimal(6,4)")})
    regimes = [r["elasticity_regime"] for r in elasticity.elasticity_history(history).orderBy("calendar_month").collect()]
    assert regimes == ["CONSTANT_RETURNS", "CONSTANT_RETURNS", "DECREASING_CAPITAL_TRAP"]
    assert elasticity.budget_elasticity(history).first()["dominant_elasticity_regime"] == "CONSTANT_RETURNS"


def test_touches_without_a_path_end_where_they_are(spark):
    touches = spark.createDataFrame(
        [(1, None, "A", True), (2, None, "B", False), (3, 7, "A", True), (4, 7, "B", True)],
        "telemetry_id long, corridor_id long, sourcing_channel string, hired_flag boolean",
    ).withColumns({"event_timestamp": F.col("telemetry_id").cast("timestamp"), "is_active_corridor": F.lit(True),
                   "cost_per_applicant_usd": F.lit(1).cast("decimal(8,2)")})
    ends = {r["telemetry_id"]: r["destination_channel"] for r in attribution.touch_paths(touches).collect()}
    assert ends == {1: "CONVERSION_HIRED", 2: "DROP_OFF", 3: "B", 4: "CONVERSION_HIRED"}


def test_alarm_needs_two_neighbouring_periods(spark):
    def at(minute, cost):
        return (f"2026-01-01 00:{minute:02d}:00", Decimal(cost))
    rows = [at(0, "121"), at(5, "120"), at(10, "130"), at(15, "140"), at(16, "101"), at(25, "500"), at(35, "500")]
    events = spark.createDataFrame(rows, "t string, cost_usd decimal(18,4)").select(
        F.col("t").cast("timestamp").alias("event_timestamp"), "cost_usd")
    alarms = cost_surge_alarms(events).collect()
    assert [str(a["period_start"]) for a in alarms] == ["2026-01-01 00:15:00"]


def test_quarantine_names_every_broken_rule(spark):
    rows = spark.createDataFrame(
        [("Talent Network Pool", "LATAM", "Senior Lead", Decimal("28.50"), 850, Decimal(".32"), Decimal(".45")),
         ("Talent Network Pool", "Mars", "Senior Lead", Decimal("-10"), 850, Decimal("1.2"), None)],
        "channel string, region string, seniority string, cost_per_applicant_usd decimal(8,2),"
        " max_channel_capacity_applicants int, interview_yield_rate decimal(6,4), offer_acceptance_rate decimal(6,4)")
    valid, rejected = quality.split_quarantine(rows, quality.CORRIDOR_UNIT_RULES)
    assert valid.count() == 1
    assert rejected.first()["failed_rules"] == [
        "cost_positive", "interview_rate_in_unit_interval", "offer_rate_in_unit_interval", "region_in_domain"]


def test_schedule_defaults_for_an_unknown_corridor(spark):
    lines = spark.createDataFrame(
        [("c", "A", "R", "S", 1000, Decimal("500"), Decimal("20"), Decimal("25"), 1, 1, 1)],
        "campaign_id string, channel string, region string, seniority string, allocated_applicants int,"
        " allocated_budget_usd decimal(18,2), expected_hires decimal(18,2), effective_cost_per_hire_usd decimal(18,2),"
        " unit_cost_usd int, unit_yield int, unit_capacity int")
    metrics = spark.createDataFrame(
        [], "channel string, region string, seniority string, cost_per_applicant_usd decimal(12,2),"
        " overall_conversion_yield decimal(13,8), max_channel_capacity_applicants int")
    row = reporting.allocation_schedule(lines, metrics).first()
    assert (row["unit_cpa_usd"], row["monthly_capacity"]) == (Decimal("0.50"), 1000)
    assert row["conversion_yield"] == Decimal("0.02") and row["allocation_status"] == "CAPACITY_SATURATED"


def test_schedule_shows_the_figures_of_its_plan(spark):
    lines = spark.createDataFrame(
        [("c", "A", "R", "S", 99, Decimal("990"), Decimal("20"), Decimal("49.5"), Decimal("10.00"), Decimal("0.20000000"), 100),
         ("c", "B", "R", "S", 0, Decimal("0"), Decimal("0"), Decimal("0"), None, None, None)],
        "campaign_id string, channel string, region string, seniority string, allocated_applicants int,"
        " allocated_budget_usd decimal(18,2), expected_hires decimal(18,2), effective_cost_per_hire_usd decimal(18,2),"
        " unit_cost_usd decimal(12,2), unit_yield decimal(13,8), unit_capacity int")
    planned, unknown = reporting.sorted_schedule(reporting.allocation_schedule(lines)).collect()
    assert (planned["unit_cpa_usd"], planned["conversion_yield"], planned["monthly_capacity"]) == (Decimal("10.00"), Decimal("0.2"), 100)
    assert planned["allocation_status"] == "CAPACITY_SATURATED" and unknown["allocation_status"] == "ZERO_ALLOCATED"
    assert (unknown["unit_cpa_usd"], unknown["monthly_capacity"]) == (0, 1000)
