"""Corridor economics: the aggregate the allocator works on, and derived unit prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from allocspark.functions.rounding import as_double, exact, mean, ratio, rounded

OBSERVED_CORRIDOR = ["channel", "region", "seniority"]


def joint_yield(interview: Column, offer: Column) -> Column:
    return interview * offer


def cost_per_hire(cost: Column, conversion_yield: Column) -> Column:
    """Cost of one hire; infinite where nothing converts."""
    return F.when(conversion_yield <= 0, F.lit(float("inf"))).otherwise(ratio(cost, conversion_yield))


def corridor_metrics(observations: DataFrame) -> DataFrame:
    """Mean cost, median capacity and mean rates of the active rows of every corridor.

    Rows are first collapsed to (corridor, capacity) with counts, which keeps the exact
    median to a handful of pairs per corridor however many rows a corridor holds.
    """
    by_capacity = (
        observations.filter("is_active_corridor")
        .groupBy(*OBSERVED_CORRIDOR, "max_channel_capacity_applicants")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("cost_per_applicant_usd").alias("cost_sum"), F.count("cost_per_applicant_usd").alias("costs"),
            F.sum("interview_yield_rate").alias("interview_sum"), F.count("interview_yield_rate").alias("interviews"),
            F.sum("offer_acceptance_rate").alias("offer_sum"), F.count("offer_acceptance_rate").alias("offers"),
        )
    )
    metrics = by_capacity.groupBy(*OBSERVED_CORRIDOR).agg(
        rounded(ratio(F.sum("cost_sum"), F.sum("costs")), 2).cast("decimal(12,2)").alias("cost_per_applicant_usd"),
        F.percentile("max_channel_capacity_applicants", 0.5, F.col("n")).cast("int")
        .alias("max_channel_capacity_applicants"),
        rounded(ratio(F.sum("interview_sum"), F.sum("interviews")), 4).cast("decimal(6,4)").alias("interview_yield_rate"),
        rounded(ratio(F.sum("offer_sum"), F.sum("offers")), 4).cast("decimal(6,4)").alias("offer_acceptance_rate"),
    )
    joint = joint_yield(F.col("interview_yield_rate"), F.col("offer_acceptance_rate"))
    return metrics.withColumn("overall_conversion_yield", joint).withColumn(
        "cost_per_hire_benchmark_usd",
        cost_per_hire(F.col("cost_per_applicant_usd"), F.col("overall_conversion_yield")),
    )


#: The report's order: ascending SQL expressions.
REPORT_ORDER = OBSERVED_CORRIDOR


def sorted_corridors(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy(*OBSERVED_CORRIDOR)


# Floors and ranges the observed economics are held to.
COST_FLOOR_USD = "5.00"
INTERVIEW_RANGE = ("0.0150", "0.7500")
OFFER_RANGE = ("0.1000", "0.6500")


def priced_observations(
    observations: DataFrame, channels: DataFrame, regions: DataFrame, seniorities: DataFrame
) -> DataFrame:
    """Observed next to expected economics.

    The expected cost and interview rate are the channel base times the region and
    seniority multipliers of three dimension tables (at most 5 x 5 x 4 rows, broadcast);
    costs are held above their floor and rates inside their ranges, then yield and cost
    per hire are stored rounded.
    """
    dims = (
        observations
        .join(F.broadcast(channels.select(F.col("channel_name").alias("channel"), "cb", "s1")), "channel")
        .join(F.broadcast(regions.select("region", "rm").distinct()), "region")
        .join(F.broadcast(seniorities.select("seniority", "sm", "ym")), "seniority")
    )

    def held(value: Column, bounds: tuple[str, str]) -> Column:
        low, high = (F.lit(bound).cast("decimal(6,4)") for bound in bounds)
        return F.least(F.greatest(value, low), high)

    clamped = dims.withColumns({
        "expected_cpa_usd": (F.col("cb") * F.col("rm") * F.col("sm")).cast("decimal(8,2)"),
        "expected_interview_yield": held((F.col("s1") * F.col("ym")).cast("decimal(6,4)"), INTERVIEW_RANGE),
        "cost_per_applicant_usd": F.greatest("cost_per_applicant_usd", F.lit(COST_FLOOR_USD).cast("decimal(8,2)")),
        "interview_yield_rate": held(F.col("interview_yield_rate"), INTERVIEW_RANGE),
        "offer_acceptance_rate": held(F.col("offer_acceptance_rate"), OFFER_RANGE),
    })
    stored = clamped.withColumn(
        "overall_conversion_yield",
        F.round(joint_yield(F.col("interview_yield_rate"), F.col("offer_acceptance_rate")), 5),
    )
    return stored.select(
        "allocation_id", *OBSERVED_CORRIDOR, "cost_per_applicant_usd", "expected_cpa_usd",
        "interview_yield_rate", "expected_interview_yield", "offer_acceptance_rate",
        "overall_conversion_yield",
        as_double(ratio(F.col("cost_per_applicant_usd"), F.col("overall_conversion_yield")), 2)
        .alias("cost_per_hire_benchmark_usd"),
    )


def dataset_means(priced: DataFrame) -> DataFrame:
    """Row count, mean cost per applicant and mean benchmark cost per hire of a data set."""
    return priced.agg(
        F.count(F.lit(1)).alias("observations"),
        as_double(mean(F.col("cost_per_applicant_usd")), 2).alias("mean_cpa_usd"),
        as_double(mean(exact(F.col("cost_per_hire_benchmark_usd"))), 2).alias("mean_benchmark_cph_usd"),
    )
