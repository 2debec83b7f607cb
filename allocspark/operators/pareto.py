"""Cost/yield Pareto frontier over corridor lifetime metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from allocspark.functions import labels
from allocspark.functions.rounding import mean, ratio, rounded
from allocspark.operators.ordered import Running, run_ordered, with_positions
from allocspark.schemas import CORRIDOR
from allocspark.session import cut_lineage

MIN_APPLICANTS = 100


def lifetime_metrics(telemetry: DataFrame, min_applicants: int = MIN_APPLICANTS) -> DataFrame:
    """Corridor means and totals, for corridors with enough applicants to judge."""
    return (
        telemetry.groupBy(*CORRIDOR)
        .agg(
            rounded(mean(F.col("cost_per_applicant_usd")), 2).alias("mean_cpa_usd"),
            rounded(mean(F.col("overall_conversion_yield")), 5).alias("mean_conversion_yield"),
            F.sum("allocated_applicants").alias("historical_applicants_volume"),
            rounded(F.sum("allocated_spend_usd"), 2).alias("total_historical_spend_usd"),
            rounded(ratio(F.sum("allocated_spend_usd"), F.sum("projected_hires")), 2).alias("empirical_cph_usd"),
        )
        .filter(F.col("historical_applicants_volume") >= min_applicants)
    )


def dominance_counts(points: DataFrame, cost: str, gain: str) -> DataFrame:
    """How many rows of ``points`` dominate each distinct (cost, gain) pair.

    A row dominates if it costs no more and gains no less, with one of the two strict.
    Distinct pairs are ranked by (cost up, gain down): a dominator always has a smaller
    rank. For two ranks there is exactly one bit level at which they share the higher bits
    and differ in that bit, so counting, per level and shared prefix, the lower half's rows
    with at least the own gain finds every dominator once. That is k log k rows for k
    pairs, where a join on the inequalities would pair all of them.
    """
    pairs = cut_lineage(points.groupBy(cost, gain).agg(F.count(F.lit(1)).alias("copies")))
    ranked = with_positions(pairs, [cost, f"-{gain}"], "rank").withColumn("rank", F.col("rank").cast("long") - 1)
    width = pairs.agg(F.length(F.bin(F.greatest(F.count(F.lit(1)) - 1, F.lit(0)))).alias("width")).scalar()
    levels = ranked.withColumn("level", F.explode(F.sequence(F.lit(0), width - 1))).withColumns({
        "prefix": F.expr("shiftright(rank, level + 1)"),
        "upper": F.expr("shiftright(rank, level) & 1"),
        "less": -F.col(gain),
    }).withColumn("lower", F.when(F.col("upper") == 0, F.col("copies")).otherwise(0))
    # At the highest level all pairs share a prefix, so this too runs in chunks.
    no_less_gain = run_ordered(levels, Running(key=["level", "prefix"], order=["less", "upper", "rank"], sums={"lower_rows": "lower"}))
    return (
        no_less_gain.withColumn("above", F.when(F.col("upper") == 1, F.col("lower_rows")).otherwise(0))
        .groupBy(cost, gain)
        .agg(F.sum("above").alias("dominated_by_count"))
    )


def pareto_frontier(telemetry: DataFrame, min_applicants: int = MIN_APPLICANTS) -> DataFrame:
    """Dominance count, frontier rank, status and the marginal yield along each frontier."""
    metrics = cut_lineage(lifetime_metrics(telemetry, min_applicants))  # one row a corridor, read several times
    counts = dominance_counts(metrics, "mean_cpa_usd", "mean_conversion_yield")
    counted = metrics.join(counts, ["mean_cpa_usd", "mean_conversion_yield"])
    counted = cut_lineage(counted)
    layers = with_positions(counted.select("dominated_by_count").distinct(), ["dominated_by_count"], "pareto_frontier_rank")
    along = Running(key=["dominated_by_count"], order=["mean_cpa_usd", *CORRIDOR],
                    previous={"prev_cpa": "mean_cpa_usd", "prev_yield": "mean_conversion_yield"})
    ranked = run_ordered(counted, along).join(layers, "dominated_by_count")
    extra_cost = F.col("mean_cpa_usd") - F.col("prev_cpa")
    extra_yield = F.col("mean_conversion_yield") - F.col("prev_yield")
    return ranked.select(
        *CORRIDOR, "mean_cpa_usd",
        rounded(F.col("mean_conversion_yield") * 100, 3).alias("conversion_yield_pct"),
        "empirical_cph_usd", "dominated_by_count", "pareto_frontier_rank",
        labels.pareto_status(F.col("dominated_by_count")).alias("pareto_efficiency_status"),
        F.when(extra_cost > 0, rounded(ratio(extra_yield * 100, extra_cost), 4))
        .alias("marginal_yield_per_additional_dollar"),
        "historical_applicants_volume", "total_historical_spend_usd",
    )


def ranked_frontier(frontier: DataFrame) -> DataFrame:
    return frontier.orderBy("dominated_by_count", "mean_cpa_usd", *CORRIDOR)
