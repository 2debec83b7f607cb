"""Cost alarm: the mean cost of a period is above a threshold twice in a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from allocspark.functions.rounding import mean

# Alarm threshold, period length in seconds; two periods must breach.
THRESHOLD_USD = 120
PERIOD_SECONDS = 300


def period_pairs(
    events: DataFrame, period_seconds: int = PERIOD_SECONDS, late_by: str | None = None
) -> DataFrame:
    """Mean costs of every two periods in a row, of a batch or streaming frame with
    ``event_timestamp`` and ``cost_usd``.

    Each window spans two periods and slides by one. Its two halves are averaged apart, and
    a half without events has no mean, so it does not breach. No state beyond the window
    aggregate is needed. ``late_by`` sets the watermark of a stream; later rows are dropped.
    """
    timed = events.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    if late_by is not None:
        timed = timed.withWatermark("event_timestamp", late_by)
    span, slide = f"{2 * period_seconds} seconds", f"{period_seconds} seconds"
    middle = F.col("span.start") + F.expr(f"interval '{period_seconds}' second")
    early = F.col("event_timestamp") < middle
    return (
        timed.withColumn("span", F.window("event_timestamp", span, slide))
        .withColumn("earlier_cost", F.when(early, F.col("cost_usd")))
        .withColumn("later_cost", F.when(~early, F.col("cost_usd")))
        .groupBy("span")
        .agg(mean(F.col("earlier_cost")).alias("previous_mean"), mean(F.col("later_cost")).alias("current_mean"))
        .select(
            (F.col("span.end") - F.expr(f"interval '{period_seconds}' second")).alias("period_start"),
            F.col("span.end").alias("alarm_at"), "previous_mean", "current_mean",
        )
    )


def breaching(pairs: DataFrame, threshold: float = THRESHOLD_USD) -> DataFrame:
    return pairs.filter((F.col("previous_mean") > threshold) & (F.col("current_mean") > threshold))


def cost_surge_alarms(
    events: DataFrame, threshold: float = THRESHOLD_USD, period_seconds: int = PERIOD_SECONDS,
) -> DataFrame:
    """The pairs of periods whose means both lie above the threshold."""
    return breaching(period_pairs(events, period_seconds), threshold)
