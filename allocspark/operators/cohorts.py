"""Longitudinal campaign metrics and the onboarding-cohort matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from allocspark.functions import labels
from allocspark.functions.rounding import mean, ratio, rounded
from allocspark.operators.ordered import Running, run_by_key, run_ordered
from allocspark.schemas import CORRIDOR
from allocspark.session import cut_lineage, stored


#: Groups whose borders are broadcast; with more of them they are joined.
BROADCAST_GROUPS = 20_000


def with_ntile(df: DataFrame, group: str, value: str, tiebreak: str, buckets: int, out: str) -> DataFrame:
    """NTILE over (partition by group order by value nulls last, tiebreak), by selection of border rows.

    Counts per distinct value say which value holds the last row of each bucket; only the rows with
    such a value are put in order, by ``tiebreak``, to find that row. Every row is then compared
    with at most ``buckets - 1`` border rows of its group and stays where it is. ``df`` is read three
    times: give a settled table.
    """
    rows = df.select(F.col(group).alias("g"), F.col(value).isNull().alias("missing"), F.col(value).alias("v"), F.col(tiebreak).alias("id"))
    counted = cut_lineage(rows.groupBy("g", "missing", "v").agg(F.count(F.lit(1)).alias("n")))
    totals = counted.groupBy(F.col("g").alias("_g")).agg(F.sum("n").alias("rows"))
    summed = run_ordered(counted, Running(key=["g"], order=["missing", "v"], sums={"up_to": "n"}), settled=True)
    end = F.expr(f"b * (rows div {buckets}) + least(b, rows % {buckets})")  # place of a bucket's last row
    borders = cut_lineage(
        summed.join(totals, F.col("g").eqNullSafe(F.col("_g")))
        .withColumn("b", F.explode(F.sequence(F.lit(1), F.lit(buckets - 1)))).withColumn("end", end)
        .where("end > up_to - n and end <= up_to").select("g", "missing", "v", (F.col("end") - F.col("up_to") + F.col("n")).alias("k")))
    small = borders.count() <= BROADCAST_GROUPS * (buckets - 1)

    def beside(side: DataFrame) -> DataFrame:
        return F.broadcast(side) if small else side

    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in ("g", "missing", "v")]
    values = borders.select("g", "missing", "v").distinct().withColumnsRenamed({name: f"_{name}" for name in ("g", "missing", "v")})
    # Stored by the pass, so that whole ``df`` is searched for them once.
    placed = run_ordered(rows.join(beside(values), same, "left_semi"), Running(key=["g", "missing", "v"], order=["id"], position="at"))
    named = borders.withColumnsRenamed({name: f"_{name}" for name in ("g", "missing", "v")})
    found = placed.join(beside(named), [*same, F.col("at") == F.col("k")]).groupBy(F.col("g").alias("_g")).agg(
        F.collect_list(F.struct("missing", "v", "id")).alias("_borders"))  # at most ``buckets - 1``
    own = F.struct(F.col(value).isNull().alias("missing"), F.col(value).alias("v"), F.col(tiebreak).alias("id"))
    joined = df.join(beside(cut_lineage(found)), F.col(group).eqNullSafe(F.col("_g")), "left")
    # At most ``buckets - 1`` comparisons, no function called per element.
    passed = [F.when(F.get("_borders", F.lit(i)) < own, 1).otherwise(0) for i in range(buckets - 1)]
    return joined.select(*df.columns, sum(passed, F.lit(1)).cast("int").alias(out))


def settled_telemetry(telemetry: DataFrame) -> DataFrame:
    """The columns of telemetry that the cohort reports read, stored: they read them several times."""
    return stored(telemetry.select(
        "telemetry_id", "campaign_id", *CORRIDOR, "cost_per_applicant_usd", "allocated_applicants",
        "allocated_spend_usd", "overall_conversion_yield", "projected_hires", "event_timestamp",
    ))


def cohort_telemetry(telemetry: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Every observation with its campaign history, cost quartile, drift, velocity and tier.

    ``telemetry`` is read twice: give ``settled_telemetry``. The rows shuffle once, by campaign, to meet
    their campaign and to be put in order, and are stored with their history for the quartiles.
    """
    onboarded = campaigns.select(
        "campaign_id", "client_name", F.date_format("created_at", "yyyy-MM").alias("onboarding_cohort")
    )
    # Both sides are laid out by campaign for the history anyway; hashed, only the history sorts the rows.
    known = telemetry.join(onboarded.hint("shuffle_hash"), "campaign_id")
    observed = telemetry.groupBy("campaign_id").agg(F.count(F.lit(1)).alias("rows"))
    listed = campaigns.groupBy("campaign_id").agg(F.count(F.lit(1)).alias("times"))
    sizes = stored(observed.join(listed, "campaign_id").select("campaign_id", (F.col("rows") * F.col("times")).alias("n")))
    history = Running(
        key=["campaign_id"], order=["event_timestamp", "telemetry_id"],
        previous={"prev_batch_cpa_usd": "cost_per_applicant_usd"},
        following={"next_batch_conversion_yield": "overall_conversion_yield"},
        first={"baseline_campaign_cpa_usd": "cost_per_applicant_usd"},
        position="allocation_batch_sequence",
    )
    placed = stored(run_by_key(known, history, sizes))
    # Seniorities are few, so their quartile borders are broadcast and the stored rows stay where they are.
    quartered = with_ntile(
        placed, "seniority", "cost_per_applicant_usd", "telemetry_id", 4, "cpa_efficiency_quartile"
    )
    cost, previous = F.col("cost_per_applicant_usd"), F.col("prev_batch_cpa_usd")
    added = placed.columns[len(known.columns):]
    return quartered.select(*known.columns, "cpa_efficiency_quartile", *added).withColumns({
        "cpa_drift_from_baseline_usd": rounded(cost - F.col("baseline_campaign_cpa_usd"), 2),
        "cpa_velocity_pct_change": F.when(previous.isNull() | (previous == 0), F.expr("cast(0 as decimal(29,2))"))
        .otherwise(rounded(ratio((cost - previous) * 100, previous), 2)),
        "longitudinal_performance_tier": labels.longitudinal_tier(
            F.col("cpa_efficiency_quartile"), F.col("overall_conversion_yield")),
    })


def with_corridor_benchmark(rows: DataFrame, telemetry: DataFrame) -> DataFrame:
    """Add the mean cost of the corridor across all campaigns."""
    benchmark = telemetry.groupBy(*CORRIDOR).agg(
        mean(F.col("cost_per_applicant_usd")).alias("corridor_benchmark_avg_cpa_usd")
    )
    return rows.join(F.broadcast(benchmark), CORRIDOR, "left")  # one row a corridor of the closed domains


def cohort_matrix(enriched: DataFrame, min_rows: int = 2) -> DataFrame:
    """One row per (cohort month, corridor, tier) with at least ``min_rows`` observations.

    Three narrow passes over ``enriched``, which comes from stored rows: sums per cell, the counted costs
    that the percentiles need, and the campaigns of each cell. Each is summed before it shuffles.
    """
    cell = ["onboarding_cohort", *CORRIDOR, "longitudinal_performance_tier"]
    sums = enriched.groupBy(*cell).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("allocated_applicants").alias("applicants"),
        F.sum("allocated_spend_usd").alias("spend"),
        F.sum("projected_hires").alias("hires"),
        F.sum("cpa_drift_from_baseline_usd").alias("drift"),
        F.sum("cpa_velocity_pct_change").alias("velocity"),
        F.sum("overall_conversion_yield").alias("yield_sum"),
        F.sum("cost_per_applicant_usd").alias("cost_sum"),
        F.count("cost_per_applicant_usd").alias("costs"),
        F.count("cpa_drift_from_baseline_usd").alias("drifts"),
        F.count("cpa_velocity_pct_change").alias("velocities"),
        F.count("overall_conversion_yield").alias("yields"),
    )
    costs = enriched.groupBy(*cell, "cost_per_applicant_usd").agg(F.count(F.lit(1)).alias("rows"))
    members = enriched.select(*cell, "campaign_id").distinct().groupBy(*cell).agg(F.count(F.lit(1)).alias("total_active_campaigns"))
    pieces = sums.unionByName(costs, allowMissingColumns=True).unionByName(members, allowMissingColumns=True)
    merged = pieces.groupBy(*cell).agg(
        F.max("total_active_campaigns").alias("total_active_campaigns"),
        F.max("applicants").alias("total_applicants_routed"),
        *[F.max(name).alias(name) for name in sums.columns[len(cell):] if name != "applicants"],
        F.percentile("cost_per_applicant_usd", [0.5, 0.95], F.coalesce("rows", F.lit(0))).alias("cost_points"),
    )
    n = F.col("n")
    return merged.filter(n >= min_rows).select(
        *cell, "total_active_campaigns", "total_applicants_routed",
        rounded(F.col("spend"), 2).alias("total_spend_usd"),
        rounded(F.col("hires"), 1).alias("total_projected_hires"),
        rounded(ratio(F.col("cost_sum"), F.col("costs")), 2).alias("avg_cpa_usd"),
        rounded(ratio(F.col("drift"), F.col("drifts")), 2).alias("avg_drift_from_inception_usd"),
        rounded(ratio(F.col("velocity"), F.col("velocities")), 2).alias("avg_cpa_velocity_pct"),
        rounded(ratio(F.col("yield_sum") * 100, F.col("yields")), 3).alias("avg_conversion_yield_pct"),
        rounded(F.col("cost_points")[0], 2).alias("median_cpa_usd"),
        rounded(F.col("cost_points")[1], 2).alias("p95_cpa_usd"),
        rounded(ratio(F.col("spend"), F.col("hires")), 2).alias("effective_cost_per_hire_usd"),
    )


def ranked_cohorts(matrix: DataFrame) -> DataFrame:
    return matrix.orderBy(
        F.desc("onboarding_cohort"), F.desc("total_spend_usd"), *CORRIDOR, "longitudinal_performance_tier"
    )
