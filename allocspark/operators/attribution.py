"""Touch paths, the channel transition graph and multi-touch attribution."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from allocspark.functions import labels
from allocspark.functions.rounding import ratio, rounded
from allocspark.operators.ordered import Running, run_ordered

HIRED, DROPPED = "CONVERSION_HIRED", "DROP_OFF"


def touch_paths(touches: DataFrame) -> DataFrame:
    """Active touches with their place on the path, its length and where the path goes next.

    The next touch is read along the order instead of joining the paths to themselves. Only
    the last touch of a path ends in a hire or a drop-off, by its own flag. Touches without
    a path id cannot be followed, so each of them ends there.
    """
    active = touches.filter("is_active_corridor")
    spec = Running(
        key=["corridor_id"], order=["event_timestamp", "telemetry_id"],
        following={"next_channel": "sourcing_channel"},
        position="touchpoint_sequence_number", size="total_touchpoint_depth",
    )
    followed = run_ordered(active, spec)
    ending = F.when(F.col("hired_flag"), HIRED).otherwise(DROPPED)
    return followed.withColumn(
        "destination_channel",
        F.when(F.col("corridor_id").isNull(), ending).otherwise(F.coalesce("next_channel", ending)),
    ).drop("next_channel")


def channel_edges(paths: DataFrame) -> DataFrame:
    """One row per (channel, destination): transitions, rule-based credits and spend.

    Every later report needs only these few rows, so the touches are read once.
    """
    hired = F.col("hired_flag")
    first = F.col("touchpoint_sequence_number") == 1
    last = F.col("touchpoint_sequence_number") == F.col("total_touchpoint_depth")
    share = (F.lit(1.0) / F.col("total_touchpoint_depth")).cast("decimal(28,18)")
    return paths.groupBy("sourcing_channel", "destination_channel").agg(
        F.count(F.lit(1)).alias("transition_count"),
        F.count(F.when(first & hired, 1)).alias("first_touch_hires"),
        F.count(F.when(last & hired, 1)).alias("last_touch_hires"),
        F.sum(F.when(hired, share).otherwise(0)).alias("linear_credit"),
        F.sum("cost_per_applicant_usd").alias("spend_usd"),
    )


def transition_matrix(edges: DataFrame) -> DataFrame:
    """Transition counts and probabilities P(origin -> destination)."""
    leaving = Window.partitionBy("sourcing_channel")
    return edges.select(
        F.col("sourcing_channel").alias("origin_channel"), "destination_channel", "transition_count",
        rounded(ratio(F.col("transition_count"), F.sum("transition_count").over(leaving)), 4)
        .alias("transition_probability"),
    )


def attribution(edges: DataFrame) -> DataFrame:
    """First-touch, last-touch, linear and absorption-weighted attribution per channel."""
    into_hire = F.when(F.col("destination_channel") == HIRED, F.col("transition_count")).otherwise(0)
    per_channel = edges.groupBy("sourcing_channel").agg(
        F.sum("spend_usd").alias("channel_total_spend_usd"),
        F.sum("first_touch_hires").alias("first_touch_hires"),
        F.sum("last_touch_hires").alias("last_touch_hires"),
        F.round(F.sum("linear_credit"), 2).alias("linear_attributed_hires"),
        F.sum(into_hire).alias("direct_conversions"),
        F.sum("transition_count").alias("total_outbound_transitions"),
        rounded(ratio(F.sum(into_hire), F.sum("transition_count")), 4).alias("direct_absorption_rate"),
    )
    everything = Window.partitionBy()  # over one row per channel
    absorption = F.col("direct_absorption_rate")
    all_absorption = F.sum(absorption).over(everything)
    all_linear = F.sum("linear_attributed_hires").over(everything)
    attributed = all_linear.cast("double") * ratio(absorption, all_absorption)
    return per_channel.select(
        "sourcing_channel", "channel_total_spend_usd", "first_touch_hires", "last_touch_hires",
        "linear_attributed_hires", "direct_conversions", "total_outbound_transitions",
        "direct_absorption_rate",
        rounded(ratio(absorption * 100, all_absorption), 2).alias("markov_attribution_weight_pct"),
        rounded(ratio(F.col("channel_total_spend_usd"), attributed), 2).alias("markov_effective_cph_usd"),
        labels.funnel_archetype(F.col("first_touch_hires"), F.col("last_touch_hires"), absorption)
        .alias("channel_funnel_archetype"),
    )


def ranked_attribution(report: DataFrame) -> DataFrame:
    return report.orderBy(F.col("markov_attribution_weight_pct").desc_nulls_first(), "sourcing_channel")
