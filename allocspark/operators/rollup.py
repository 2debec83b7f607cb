"""Moving 7-day means, cumulative campaign totals and the daily corridor rollup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from allocspark.functions import labels
from allocspark.functions.rounding import ratio, rounded, weighted_mean
from allocspark.operators.ordered import Running, run_ordered
from allocspark.schemas import CORRIDOR
from allocspark.session import stored


def registered_only(telemetry: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Telemetry of known campaigns. No hint: Spark broadcasts a small campaign table itself
    and splits hot campaigns of a shuffled join through its skew handling."""
    return telemetry.join(campaigns.select("campaign_id"), "campaign_id", "left_semi")


def instant_sums(telemetry: DataFrame) -> DataFrame:
    """Sums and counts per (corridor, instant): rows of one instant are peers of a RANGE frame."""
    return telemetry.groupBy(*CORRIDOR, "event_timestamp").agg(
        F.sum("cost_per_applicant_usd").alias("cost_sum"),
        F.sum("overall_conversion_yield").alias("yield_sum"),
        F.count("cost_per_applicant_usd").alias("costs"),
        F.count("overall_conversion_yield").alias("yields"),
        F.count(F.lit(1)).alias("observations"),
    )


def moving_means(telemetry: DataFrame, days: int = 7) -> DataFrame:
    """Mean cost and yield per corridor over the closed span [t - days, t], one row per instant."""
    return moving_means_of(instant_sums(telemetry), days)


def moving_means_of(instants: DataFrame, days: int = 7) -> DataFrame:
    """The moving means from the sums of ``instant_sums``.

    Each instant enters the span at t and leaves it after t + days; the moving total is the running
    total of entries minus exits, which needs no wide frame and no self-join. Nulls are left
    out of sums and counts; a span of nulls alone has no mean.
    """
    instants = stored(instants)  # the ordered pass reads it several times
    entering = F.struct(
        F.col("event_timestamp").alias("at"), F.lit(0).alias("leaves"),
        F.col("cost_sum").alias("d_cost"), F.col("yield_sum").alias("d_yield"),
        F.col("costs").alias("d_costs"), F.col("yields").alias("d_yields"),
    )
    leaving = F.struct(
        (F.col("event_timestamp") + F.expr(f"interval '{int(days)}' day")).alias("at"),
        F.lit(1).alias("leaves"),
        (-F.col("cost_sum")).alias("d_cost"), (-F.col("yield_sum")).alias("d_yield"),
        (-F.col("costs")).alias("d_costs"), (-F.col("yields")).alias("d_yields"),
    )
    changes = instants.select(
        *CORRIDOR, "observations",
        F.explode(F.array(entering, leaving)).alias("change"),
    ).select(*CORRIDOR, "observations", "change.*")
    spec = Running(
        key=CORRIDOR, order=["at", "leaves"],
        sums={"span_cost": "d_cost", "span_yield": "d_yield", "span_costs": "d_costs", "span_yields": "d_yields"},
    )
    return (
        run_ordered(changes, spec, settled=True)
        .filter(F.col("leaves") == 0)
        .select(
            *CORRIDOR, F.col("at").alias("event_timestamp"), "observations",
            ratio(F.col("span_cost"), F.col("span_costs")).alias("moving_cpa_usd"),
            ratio(F.col("span_yield"), F.col("span_yields")).alias("moving_yield"),
        )
    )


def campaign_cumulative(telemetry: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Spend and projected hires of each campaign up to and including every observation."""
    spec = Running(
        key=["campaign_id"], order=["event_timestamp", "telemetry_id"],
        sums={"cumulative_campaign_spend_usd": "allocated_spend_usd",
              "cumulative_projected_hires": "projected_hires"},
    )
    named = telemetry.join(campaigns.select("campaign_id", "client_name"), "campaign_id")
    columns = ["telemetry_id", "campaign_id", "client_name", *CORRIDOR, "event_timestamp",
               "allocated_spend_usd", "projected_hires"]
    return run_ordered(named.select(*columns), spec)


def with_ranks(counted: DataFrame, cell: list[str], value: str, count: str) -> DataFrame:
    """Add to each counted value the rows of its cell up to it, and the rows of the cell; nulls do not count."""
    rows = F.when(F.col(value).isNotNull(), F.col(count)).otherwise(0)
    whole = Window.partitionBy(*cell)
    so_far = whole.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counted.withColumns({"rows_up_to": F.sum(rows).over(so_far), "rows_of_cell": F.sum(rows).over(whole)})


def percentile_of_ranked(value: Column, fraction: float) -> Column:
    """Aggregate: interpolated percentile over the counted values of ``with_ranks``."""
    place = F.lit(fraction) * (F.col("rows_of_cell") - 1)
    below = F.min(F.when(F.col("rows_up_to") > F.floor(place), value)).cast("double")
    above = F.min(F.when(F.col("rows_up_to") > F.ceil(place), value)).cast("double")
    return below + (above - below) * F.max(place - F.floor(place))


CELL = ["snapshot_date", *CORRIDOR]


def rollup_rows(telemetry: DataFrame, campaigns: DataFrame) -> DataFrame:
    """The columns of known campaigns' telemetry that the rollup reads, with the day."""
    return registered_only(telemetry, campaigns).select(
        F.to_date("event_timestamp").alias("snapshot_date"), "campaign_id", *CORRIDOR, "event_timestamp",
        "cost_per_applicant_usd", "overall_conversion_yield", "allocated_applicants", "allocated_spend_usd",
        "projected_hires",
    )


def cell_counts(rows: DataFrame) -> DataFrame:
    """Sums and counts per (day, corridor, cost): all that means and the exact percentile need."""
    return rows.groupBy(*CELL, "cost_per_applicant_usd").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("allocated_applicants").alias("applicants"),
        F.sum("allocated_spend_usd").alias("spend"),
        F.sum("projected_hires").alias("hires"),
        F.sum("overall_conversion_yield").alias("yield_sum"),
        F.count("overall_conversion_yield").alias("yields"),
    )


def efficiency_rollup(telemetry: DataFrame, campaigns: DataFrame, approximate: bool = False) -> DataFrame:
    """One row per (day, corridor): volumes, costs, percentiles, moving means and tier.

    No day or corridor, however large, is gathered row by row: rows are first summed per
    (day, corridor, cost), which is all the exact percentile needs, and campaigns are
    counted over distinct (day, corridor, campaign) triples. The needed columns are settled
    once, as three passes read them. Means and percentiles leave nulls out. With ``approximate`` the
    campaigns and the percentile are estimated from sketches instead, in one narrow pass.
    """
    rows = stored(rollup_rows(telemetry, campaigns))
    if approximate:
        from allocspark.operators import sketches

        estimates = sketches.estimated(sketches.sketched(rows, CELL), 0.95)
        return assembled_rollup(cell_counts(rows), None, instant_sums(rows), estimates)
    return assembled_rollup(cell_counts(rows), rows.select(*CELL, "campaign_id").distinct(), instant_sums(rows))


def assembled_rollup(by_cost: DataFrame, members: DataFrame | None, instants: DataFrame, estimates: DataFrame | None = None) -> DataFrame:
    """The rollup from its mergeable parts: ``cell_counts``, distinct (day, corridor, campaign) rows and
    ``instant_sums``; or with campaigns and percentiles from ``estimates``."""
    cost = F.col("cost_per_applicant_usd")
    exact = estimates is None
    counted = with_ranks(by_cost, CELL, "cost_per_applicant_usd", "n") if exact else by_cost
    volumes = counted.groupBy(*CELL).agg(
        F.sum("applicants").alias("total_applicants_acquired"),
        F.sum("spend").alias("total_spend_usd"),
        F.sum("hires").alias("total_projected_hires"),
        F.sum(cost * F.col("n")).alias("cost_sum"),
        F.sum("yield_sum").alias("yield_sum"),
        F.sum(F.when(cost.isNotNull(), F.col("n"))).alias("costs"),
        F.sum("yields").alias("yields"),
        *([percentile_of_ranked(cost, 0.95).alias("p95")] if exact else []),
    )
    active = members.groupBy(*CELL).agg(F.count("campaign_id").alias("active_campaigns_count")) if exact else estimates.select(
        *CELL, F.col("campaigns").alias("active_campaigns_count"), F.col("cost_quantile").alias("p95"))
    daily = volumes.join(active, CELL)
    smoothed = (
        moving_means_of(instants)
        .groupBy(F.to_date("event_timestamp").alias("snapshot_date"), *CORRIDOR)
        .agg(
            weighted_mean("moving_cpa_usd", "observations").alias("rolling_cpa"),
            weighted_mean("moving_yield", "observations").alias("rolling_yield"),
        )
    )
    spend, hires = F.col("total_spend_usd"), F.col("total_projected_hires")
    measured = daily.join(smoothed, CELL).select(
        F.date_format("snapshot_date", "yyyy-MM-dd").alias("snapshot_date"), *CORRIDOR,
        "active_campaigns_count", "total_applicants_acquired", "total_spend_usd", "total_projected_hires",
        rounded(ratio(F.col("cost_sum"), F.col("costs")), 2).alias("mean_cpa_usd"),
        rounded(F.col("rolling_cpa"), 2).alias("rolling_7d_cpa_usd"),
        rounded(F.col("p95"), 2).alias("p95_cpa_usd"),
        rounded(ratio(F.col("yield_sum"), F.col("yields")), 5).alias("mean_conversion_yield"),
        rounded(F.col("rolling_yield"), 5).alias("rolling_7d_yield"),
        rounded(ratio(spend, hires), 2).alias("effective_cost_per_hire_usd"),
        rounded(ratio(hires, spend) * 1000, 3).alias("hires_yield_per_1k_usd"),
    )
    return measured.withColumn(
        "corridor_strategic_tier",
        labels.efficiency_tier(F.col("effective_cost_per_hire_usd"), F.col("mean_conversion_yield")),
    )


#: The report's order, as ascending SQL expressions: newest day first, then highest spend.
REPORT_ORDER = ["datediff(date'1970-01-01', snapshot_date)", "-total_spend_usd", *CORRIDOR]


def ranked_rollup(rollup: DataFrame) -> DataFrame:
    """Report order: newest day first, then highest spend."""
    return rollup.orderBy(F.desc("snapshot_date"), F.desc("total_spend_usd"), *CORRIDOR)
