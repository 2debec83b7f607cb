"""Every report as a function of (session, data folder), over whole tables."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from allocspark import schemas
from allocspark.operators import (
    allocation, anomalies, attribution, cohorts, corridors, elasticity, pareto, quality, reporting,
    rollup, saturation, sketches,
)
from allocspark.operators.ordered import with_positions
from allocspark.session import cut_lineage, ensure_checkpoint_dir, stored
from allocspark.sources import adapters, fixtures, rollup_store, writers
from allocspark.sources.readers import quarter_of, read_parquet, read_table
from allocspark.streaming import jobs
from allocspark.streaming.alarms import cost_surge_alarms

Query = Callable[[SparkSession, str], DataFrame]
TIME_TEXT = "yyyy-MM-dd HH:mm:ss"


def delivered(df: DataFrame) -> DataFrame:
    """Report types: decimals as doubles, times and dates as text."""
    def shown(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, TIME_TEXT)
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        return column.alias(field.name)

    return df.select(*[shown(field) for field in df.schema])


# ------------------------------------------------------------------ corridors and rollups


def corridor_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered(corridors.sorted_corridors(_metrics(spark, sf_dir)))


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corridors.corridor_metrics(fixtures.raw_observations(spark, sf_dir))


def priced_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered(_priced(spark, sf_dir))


def _priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corridors.priced_observations(
        fixtures.raw_observations(spark, sf_dir), fixtures.dim_channel(spark),
        fixtures.dim_region(spark), fixtures.dim_seniority(spark),
    )


def dataset_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered(corridors.dataset_means(_priced(spark, sf_dir)))


def rolling_7d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered(rollup.moving_means(fixtures.sourcing_telemetry(spark, sf_dir)))


def campaign_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered(rollup.campaign_cumulative(
        fixtures.sourcing_telemetry(spark, sf_dir), fixtures.campaign_master(spark, sf_dir)))


def efficiency_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = rollup.efficiency_rollup(
        fixtures.sourcing_telemetry(spark, sf_dir), fixtures.campaign_master(spark, sf_dir))
    return delivered(rollup.ranked_rollup(daily))


def rollup_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily rollup after two refreshes that each read their own rows only, and a repeated one."""
    telemetry, campaigns = fixtures.sourcing_telemetry(spark, sf_dir), fixtures.campaign_master(spark, sf_dir)
    late = F.expr("event_timestamp >= timestamp'1998-01-01' or pmod(hash(telemetry_id), 10) = 0")
    root = _scratch(spark, "rollup")
    rollup_store.refresh(spark, root, "first", telemetry.where(~late), campaigns)
    rollup_store.refresh(spark, root, "second", telemetry.where(late), campaigns)
    rollup_store.refresh(spark, root, "second", telemetry.where(late), campaigns)
    return delivered(rollup_store.read_rollup(spark, root))


def reach_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaigns per corridor and quarter from daily sketches of two halves, beside the exact count."""
    telemetry = fixtures.sourcing_telemetry(spark, sf_dir).withColumn("snapshot_date", F.to_date("event_timestamp"))
    halves = [sketches.sketched(telemetry.where(F.expr(f"pmod(hash(telemetry_id), 2) = {i}")), rollup.CELL) for i in range(2)]
    quarter = quarter_of(F.col("snapshot_date")).alias("quarter")
    estimates = sketches.estimated(sketches.merged(halves[0].unionByName(halves[1]), [quarter, *schemas.CORRIDOR]), 0.5)
    exact = telemetry.groupBy(quarter, *schemas.CORRIDOR).agg(F.count_distinct("campaign_id").alias("active_campaigns"))
    # Four standard errors and one campaign.
    close = F.abs(F.col("campaigns") - F.col("active_campaigns")) <= 1 + 4 * sketches.HLL_ERROR * F.col("active_campaigns")
    return exact.join(estimates, ["quarter", *schemas.CORRIDOR]).select(
        "quarter", *schemas.CORRIDOR, "active_campaigns", F.col("n_rows").alias("observations"), close.alias("estimate_in_bounds"))


def quantile_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost quantiles per corridor from daily sketches: whether their ranks lie within the stated error."""
    telemetry = fixtures.sourcing_telemetry(spark, sf_dir).withColumn("snapshot_date", F.to_date("event_timestamp"))
    fractions = (0.05, 0.5, 0.95, 0.99)
    estimates = sketches.estimated(sketches.merged(sketches.sketched(telemetry, rollup.CELL), schemas.CORRIDOR), *fractions).select(
        *schemas.CORRIDOR, "cost_quantiles")
    cost = F.col("cost_per_applicant_usd").cast("double")
    # One row a corridor of the closed domains.
    ranked = telemetry.join(F.broadcast(estimates), schemas.CORRIDOR).groupBy(*schemas.CORRIDOR).agg(
        F.count(cost).alias("observations"),
        *[F.count_if(cost < F.col("cost_quantiles")[i]).alias(f"below_{i}") for i in range(len(fractions))],
        *[F.count_if(cost <= F.col("cost_quantiles")[i]).alias(f"upto_{i}") for i in range(len(fractions))])
    slack = 3 * sketches.KLL_RANK_ERROR * F.col("observations") + 1
    near = [(F.col(f"below_{i}") <= f * F.col("observations") + slack) & (F.col(f"upto_{i}") >= f * F.col("observations") - slack)
            for i, f in enumerate(fractions)]
    return ranked.select(*schemas.CORRIDOR, "observations", *[n.alias(f"p{round(100 * f)}_in_bounds") for n, f in zip(near, fractions)])


def quarter_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry of first quarters, read back from folders by quarter that a joined dimension prunes."""
    path = _scratch(spark, "quarters")
    writers.write_telemetry_by_quarter(fixtures.sourcing_telemetry(spark, sf_dir), path)
    quarters = spark.range(1990 * 4, 2030 * 4).select(
        F.expr("concat(id div 4, 'Q', id % 4 + 1)").alias("event_quarter"), F.expr("id % 4 + 1").alias("number"))
    stored = read_parquet(spark, path)
    joined = stored.join(F.broadcast(quarters.where("number = 1")), "event_quarter")  # 40 rows
    return delivered(joined.groupBy("event_quarter", "channel_name").agg(
        F.count(F.lit(1)).alias("observations"), F.sum("allocated_spend_usd").alias("total_spend_usd")))


def pareto_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    frontier = pareto.pareto_frontier(fixtures.sourcing_telemetry(spark, sf_dir))
    return delivered(pareto.ranked_frontier(frontier))


def saturation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = saturation.saturation_matrix(
        fixtures.sourcing_telemetry(spark, sf_dir), fixtures.channel_corridor_registry(spark))
    return delivered(saturation.ranked_saturation(matrix))


def elasticity_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered(elasticity.elasticity_history(fixtures.corridor_history(spark, sf_dir)))


def budget_elasticity(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = elasticity.budget_elasticity(fixtures.corridor_history(spark, sf_dir))
    return delivered(elasticity.ranked_elasticity(summary))


# ----------------------------------------------------------------- telemetry of other shapes


def _recorded_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign telemetry with the hires recorded so far: the whole ones of those projected."""
    return fixtures.sourcing_telemetry(spark, sf_dir).withColumns({
        "actual_hires": F.expr("cast(floor(projected_hires) as int)"), "created_at": F.col("event_timestamp")})


def _partial_registry(spark: SparkSession) -> DataFrame:
    """The registry without some corridors, and with inactive ones."""
    listed = fixtures.channel_corridor_registry(spark).where("not (region = 'APAC' and seniority = 'Staff Architect')")
    return listed.withColumn("is_active", F.expr("saturation_capacity < 5000"))


def relational_corridors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corridor metrics from campaign telemetry and the registry."""
    observations = adapters.observations_from_telemetry(_recorded_telemetry(spark, sf_dir), _partial_registry(spark))
    return delivered(corridors.corridor_metrics(observations))


def relational_elasticity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month-over-month elasticity from campaign telemetry and the registry."""
    history = adapters.channel_telemetry_from_telemetry(_recorded_telemetry(spark, sf_dir), _partial_registry(spark))
    return delivered(elasticity.elasticity_history(history))


def observed_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly applications and spend per corridor from observations, whose outcomes nobody knows."""
    history = adapters.channel_telemetry_from_observations(fixtures.raw_observations(spark, sf_dir), _partial_registry(spark))
    return delivered(elasticity.monthly_funnel(history))


def observed_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lifetime spend and hires per corridor of observations that campaigns buy by rule of their capacity."""
    observations = fixtures.raw_observations(spark, sf_dir)
    bought = adapters.telemetry_from_observations(
        observations, F.concat(F.lit("C"), F.col("max_channel_capacity_applicants") % 11), F.col("max_channel_capacity_applicants") % 50)
    return delivered(bought.groupBy("campaign_id", *schemas.CORRIDOR).agg(
        F.count(F.lit(1)).alias("observations"), F.sum("allocated_applicants").alias("total_applicants"),
        F.sum("allocated_spend_usd").alias("total_spend_usd"), F.sum("projected_hires").alias("total_hires")))


# -------------------------------------------------------------- attribution and cohorts


def touch_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered(attribution.touch_paths(fixtures.candidate_journeys(spark, sf_dir)))


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.channel_edges(attribution.touch_paths(fixtures.candidate_journeys(spark, sf_dir)))


def markov_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered(attribution.transition_matrix(_edges(spark, sf_dir)))


def mta_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered(attribution.ranked_attribution(attribution.attribution(_edges(spark, sf_dir))))


def _cohort_telemetry(spark: SparkSession, sf_dir: str, telemetry: DataFrame) -> DataFrame:
    return cohorts.cohort_telemetry(telemetry, fixtures.campaign_master(spark, sf_dir))


def cohort_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    telemetry = cohorts.settled_telemetry(fixtures.sourcing_telemetry(spark, sf_dir))
    return delivered(cohorts.with_corridor_benchmark(_cohort_telemetry(spark, sf_dir, telemetry), telemetry))


def cohort_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    telemetry = cohorts.settled_telemetry(fixtures.sourcing_telemetry(spark, sf_dir))
    return delivered(cohorts.ranked_cohorts(cohorts.cohort_matrix(_cohort_telemetry(spark, sf_dir, telemetry))))


# ------------------------------------------------------------------------- allocation


def _program(spark: SparkSession, sf_dir: str) -> DataFrame:
    return allocation.corridor_program(_metrics(spark, sf_dir))


def naive_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pro-rata hires, spend and unit cost of every campaign."""
    baseline = allocation.pro_rata(fixtures.campaign_master(spark, sf_dir), _program(spark, sf_dir))
    return delivered(baseline.select(
        "campaign_id", "naive_heuristic_hires", "naive_spend_usd", "naive_cost_per_hire_usd"))


def _budget_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    program = _program(spark, sf_dir)
    baseline = allocation.pro_rata(fixtures.campaign_master(spark, sf_dir), program)
    return allocation.integer_allocations(allocation.greedy_plan(baseline, program))


def _settled_program(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The program as one stored row: a constrained plan and its baseline read it several times."""
    return cut_lineage(_program(spark, sf_dir))


def _constrained(spark: SparkSession, sf_dir: str) -> DataFrame:
    program = _settled_program(spark, sf_dir)
    baseline = allocation.pro_rata(fixtures.campaign_master(spark, sf_dir), program)
    return allocation.integer_allocations(allocation.constrained_plan(baseline, program))


def greedy_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered(allocation.allocation_lines(_budget_only(spark, sf_dir)))


def greedy_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered(allocation.campaign_results(_budget_only(spark, sf_dir)))


def greedy_tradeoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered(allocation.tradeoff(allocation.campaign_results(_budget_only(spark, sf_dir))))


def allocation_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = allocation.allocation_lines(_budget_only(spark, sf_dir))
    return delivered(reporting.sorted_rollup(reporting.allocation_rollup(lines)))


def allocation_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered(reporting.named_measures(allocation.campaign_results(_budget_only(spark, sf_dir))))


def allocation_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered(reporting.grand_totals(allocation.allocation_lines(_budget_only(spark, sf_dir))))


def allocation_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = allocation.allocation_lines(_budget_only(spark, sf_dir), keep_zero=True)
    return delivered(reporting.sorted_schedule(reporting.allocation_schedule(lines)))


def allocation_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the plan beside the unit figures last observed."""
    lines = allocation.allocation_lines(_budget_only(spark, sf_dir), keep_zero=True)
    recent = fixtures.raw_observations(spark, sf_dir).where("event_timestamp >= timestamp'2001-07-01'")
    schedule = reporting.allocation_schedule(lines, corridors.corridor_metrics(recent))
    return delivered(schedule.groupBy("channel", "region", "seniority", "unit_cpa_usd", "conversion_yield", "monthly_capacity", "allocation_status").agg(
        F.count(F.lit(1)).alias("campaigns"), F.sum("allocated_applicants").alias("total_applicants")))


def executive_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered(reporting.executive_variance(allocation.campaign_results(_budget_only(spark, sf_dir))))


def kpi_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered(reporting.kpi_cards(allocation.campaign_results(_budget_only(spark, sf_dir))))


def constrained_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered(allocation.allocation_lines(_constrained(spark, sf_dir)))


def constrained_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered(allocation.campaign_results(_constrained(spark, sf_dir)))


def constrained_tradeoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered(allocation.tradeoff(allocation.campaign_results(_constrained(spark, sf_dir))))


def allocation_certificate(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = allocation.constrained_plan(fixtures.campaign_master(spark, sf_dir), _settled_program(spark, sf_dir))
    return _rounded(allocation.certificate(plan), budget_price=9, quota_price=9, relative_gap=9)


def _rounded(df: DataFrame, default: int = 6, **places: int) -> DataFrame:
    """Doubles of a search as rounded numbers, without a negative zero."""
    return df.select(*[
        (F.round(f.name, places.get(f.name, default)) + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema])


def strained_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plans where campaigns lack a budget, can't pay or hold their floors, or ask for many seniors."""
    case = F.col("campaign_id") % 7
    budget = F.col("total_budget_usd").cast("double")
    strained = fixtures.campaign_master(spark, sf_dir).withColumns({
        "total_budget_usd": F.when(case == 2, budget / 100).when(case != 1, budget),
        "min_senior_hires": F.when(case == 3, 100_000).when(case == 5, 150).when(case == 6, 220).otherwise(F.col("min_senior_hires")),
        "regional_diversity_min_pct": F.when(case.isin(2, 4), 0.15).otherwise(F.col("regional_diversity_min_pct").cast("double")),
    })
    plan = allocation.constrained_plan(strained, _settled_program(spark, sf_dir), F.when(case == 4, 1e6).otherwise(50.0))
    return _rounded(allocation.plan_totals(plan), applicants=4, spend_usd=4)


def run_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows of the budget-only plan, written twice by one job and read back."""
    root = _scratch(spark, "audit")
    results = allocation.campaign_results(_budget_only(spark, sf_dir))
    for _ in range(2):
        writers.append_run_audit(results, f"{root}/optimization_runs_audit", "budget-only")
    return delivered(read_table(spark, root, "optimization_runs_audit").drop("executed_at").withColumn(
        "campaign_id", F.col("campaign_id").cast("bigint")))


def report_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every row in the four sorted reports."""
    daily = rollup.efficiency_rollup(fixtures.sourcing_telemetry(spark, sf_dir), fixtures.campaign_master(spark, sf_dir))
    metrics = cut_lineage(_metrics(spark, sf_dir))
    program = allocation.corridor_program(metrics)
    plan = stored(allocation.integer_allocations(allocation.greedy_plan(
        allocation.pro_rata(fixtures.campaign_master(spark, sf_dir), program), program)))
    lines, every = allocation.allocation_lines(plan), allocation.allocation_lines(plan, keep_zero=True)
    return functools.reduce(DataFrame.unionByName, [
        _placed("corridors", metrics, corridors.REPORT_ORDER, corridors.OBSERVED_CORRIDOR),
        _placed("daily_rollup", daily, rollup.REPORT_ORDER, ["snapshot_date", *schemas.CORRIDOR]),
        _placed("allocation_rollup", reporting.allocation_rollup(lines), reporting.ROLLUP_ORDER, ["campaign_id", "dimension", "member"]),
        # The schedule unfolds the stored plan in place.
        _placed("allocation_schedule", reporting.allocation_schedule(every, metrics), reporting.SCHEDULE_ORDER,
                ["campaign_id", *corridors.OBSERVED_CORRIDOR], settled=True),
    ])


def _placed(name: str, report: DataFrame, order: list[str], keys: list[str], settled: bool = False) -> DataFrame:
    """The key and place of every row; nothing else of the report is stored or shuffled."""
    by = [F.expr(expression).alias(f"_by_{i}") for i, expression in enumerate(order)]
    narrow = report.select(F.concat_ws("|", *keys).alias("row_key"), *by)
    return with_positions(narrow, [f"_by_{i}" for i in range(len(order))], settled=settled).select(
        F.lit(name).alias("report"), "row_key", "report_position")


# ---------------------------------------------------------------- anomalies and alarms


# Keys of an alert's payload that are compared as they are.
PAYLOAD = ["event", "client_name", "channel", "corridor", "cpa_observed", "cpa_baseline",
           "surge_multiplier", "conversion_yield", "recommended_action"]


def _flat_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.select(
        "campaign_id", "channel_name", "region", "seniority", "observed_cpa_usd", "baseline_cpa_usd",
        "observed_yield", "escalation_tier", *[F.col(f"alert_payload.{name}") for name in PAYLOAD],
    )


def anomaly_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = anomalies.detect_anomalies(
        fixtures.sourcing_telemetry(spark, sf_dir), fixtures.channel_corridor_registry(spark),
        fixtures.campaign_master(spark, sf_dir))
    return delivered(_flat_alerts(alerts))


def cost_surge_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_alarms(cost_surge_alarms(fixtures.cost_events(spark, sf_dir)))


def _shown_alarms(alarms: DataFrame) -> DataFrame:
    return alarms.select(
        F.date_format("period_start", TIME_TEXT).alias("period_start"),
        F.date_format("alarm_at", TIME_TEXT).alias("alarm_at"),
        F.round("previous_mean", 6).alias("previous_mean"), F.round("current_mean", 6).alias("current_mean"),
    )


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder of the session."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex}"


def anomaly_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order lines as an arriving stream; the log it leaves is returned."""
    work = _scratch(spark, "anomaly-stream")
    lines = fixtures.stream_table(spark, sf_dir, "lineitem")
    jobs.start_anomaly_log(
        fixtures.sourcing_telemetry(spark, sf_dir, lines), fixtures.channel_corridor_registry(spark),
        fixtures.campaign_master(spark, sf_dir), f"{work}/log", f"{work}/checkpoint",
    ).awaitTermination()
    log = read_parquet(spark, f"{work}/log")
    payload = F.from_json("alert_payload", """event string, campaign_id long, client_name string, channel string,
        corridor string, cpa_observed double, cpa_baseline double, surge_multiplier double, conversion_yield double,
        recommended_action string, evaluated_at timestamp""")
    return delivered(log.withColumn("p", payload).select(
        F.col("campaign_id").cast("bigint").alias("campaign_id"), "channel_name", "region", "seniority",
        "observed_cpa_usd", "baseline_cpa_usd", "observed_yield", "escalation_tier",
        *[F.col(f"p.{name}") for name in PAYLOAD], F.col("p.campaign_id").alias("payload_campaign_id"),
        # The alert's own time varies from run to run.
        (F.col("p.evaluated_at") <= F.current_timestamp()).alias("evaluated_before_now")))


def cost_surge_alarm_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metric feed as an arriving stream; the alarms it leaves are returned."""
    work = _scratch(spark, "cost-alarm-stream")
    events = fixtures.cost_events(spark, sf_dir, fixtures.stream_table(spark, sf_dir, "events"))
    jobs.start_cost_alarms(events, f"{work}/alarms", f"{work}/checkpoint").awaitTermination()
    return _shown_alarms(jobs.current_alarms(spark, f"{work}/alarms"))


# -------------------------------------------------------------------------- data quality


def dq_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read and failed per declared rule of each table."""
    tables = {
        "sourcing_telemetry": (fixtures.sourcing_telemetry(spark, sf_dir), quality.TELEMETRY_RULES),
        "campaign_master": (fixtures.campaign_master(spark, sf_dir), quality.CAMPAIGN_RULES),
        "corridor_units": (_metrics(spark, sf_dir), quality.CORRIDOR_UNIT_RULES),
        "channel_corridor_registry": (fixtures.channel_corridor_registry(spark), quality.REGISTRY_RULES),
        # Rows that break rules: free and negative costs, unknown channels, no campaign.
        "strained_telemetry": (_strained_telemetry(spark, sf_dir), quality.TELEMETRY_RULES),
    }
    parts = [
        quality.rule_profile(table, rules).select(F.lit(name).alias("table_name"), "rule_name", "rows_read", "rows_failed")
        for name, (table, rules) in tables.items()
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def _strained_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The telemetry with faults by rule of its applicants and campaign."""
    case, campaign = F.col("allocated_applicants") % 10, F.col("campaign_id")
    return fixtures.sourcing_telemetry(spark, sf_dir).withColumns({
        "cost_per_applicant_usd": F.when(case == 1, 0).when(case == 2, -F.col("cost_per_applicant_usd")).when(case != 3, F.col("cost_per_applicant_usd")),
        "channel_name": F.when(case == 4, "Carrier Pigeon").otherwise(F.col("channel_name")),
        "campaign_id": F.when(case == 5, None).when(case == 6, -campaign).otherwise(campaign),
        "projected_hires": F.when(case == 7, -1 - F.col("projected_hires")).otherwise(F.col("projected_hires")),
    })


def _strained_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Tables with repeated keys and unknown campaigns, by rule."""
    campaigns, telemetry = fixtures.campaign_master(spark, sf_dir), _strained_telemetry(spark, sf_dir)
    registry = fixtures.channel_corridor_registry(spark)
    again = F.expr("allocated_applicants % 25 = 0")
    return {
        "campaign_master": campaigns.unionByName(campaigns.where("campaign_id % 50 = 0")),
        "channel_corridor_registry": registry.unionByName(registry.where("region = 'APAC'").withColumn("corridor_id", F.concat("corridor_id", F.lit("+")))),
        "sourcing_telemetry": telemetry.unionByName(telemetry.where(again)),
        "optimization_runs_audit": campaigns.select(F.expr("campaign_id div 2").alias("run_id"), F.expr("campaign_id * 3").alias("campaign_id")),
    }


def dq_declared_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of declared keys that more than one row holds."""
    return quality.broken_keys(_strained_tables(spark, sf_dir))


def dq_declared_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of declared references without a parent row."""
    return quality.broken_references(_strained_tables(spark, sf_dir))


# Stricter rules than the tables declare, so that real rows fail and are set aside.
SCREENING_RULES = {
    "cost_at_most_100": "cost_per_applicant_usd <= 100",
    "yield_above_collapse": "overall_conversion_yield > 0.005",
    "some_hire_expected": "projected_hires > 0",
}


def dq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry rows that fail the screening rules, with the reasons as text."""
    _, rejected = quality.split_quarantine(fixtures.sourcing_telemetry(spark, sf_dir), SCREENING_RULES)
    return rejected.select("telemetry_id", F.concat_ws(",", "failed_rules").alias("failed_rules"))


def dq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_parquet(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")
    return quality.duplicate_keys(lines, ["l_orderkey", "l_linenumber"])


def dq_missing_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that no campaign was derived for, as they have no order."""
    customers = read_parquet(spark, f"{sf_dir.rstrip('/')}/customer.parquet").select(
        F.col("c_custkey").alias("campaign_id"), "c_name")
    return quality.missing_references(customers, fixtures.campaign_master(spark, sf_dir), "campaign_id")


def dq_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered(quality.dataset_profile(fixtures.raw_observations(spark, sf_dir)))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        corridor_metrics, priced_observations, dataset_means, rolling_7d, campaign_cumulative,
        efficiency_rollup, rollup_refreshed, reach_estimates, quantile_estimates, quarter_activity, pareto_frontier, saturation_matrix, elasticity_history, budget_elasticity,
        relational_corridors, relational_elasticity, observed_funnel, observed_rollup,
        touch_paths, markov_transitions, mta_attribution, cohort_enriched, cohort_matrix,
        naive_allocation, greedy_allocation, greedy_results, greedy_tradeoff, allocation_rollup,
        allocation_measures, allocation_totals, allocation_schedule, allocation_review, executive_variance, kpi_cards,
        constrained_allocation, constrained_results, constrained_tradeoff, allocation_certificate,
        strained_allocation, run_audit, report_positions, anomaly_detect, anomaly_stream, cost_surge_alarm, cost_surge_alarm_stream,
        dq_rules, dq_quarantine, dq_duplicates, dq_missing_references, dq_profile,
        dq_declared_keys, dq_declared_references,
    )
}
