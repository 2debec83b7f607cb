"""Streaming jobs: anomaly log and cost alarms, each restartable from its checkpoint."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from allocspark.operators.anomalies import detect_anomalies
from allocspark.sources import snapshots
from allocspark.sources.readers import read_parquet
from allocspark.sources.writers import append_anomaly_log
from allocspark.streaming.alarms import breaching, period_pairs

LATE_BY = "10 minutes"
UNTIL_READ = {"availableNow": True}  # trigger: end when all that has arrived is read
PAIR_LOG = ("period_start timestamp, alarm_at timestamp, previous_mean double, current_mean double, batch_id long")


def start_anomaly_log(
    telemetry: DataFrame, registry: DataFrame, campaigns: DataFrame, log_path: str, checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Detect anomalies of arriving telemetry and log them.

    Detection holds no state, so no row is ever too late. A batch that is run again after a
    failure overwrites its own folder, which makes the log exactly-once.
    """
    def log_batch(alerts: DataFrame, batch_id: int) -> None:
        append_anomaly_log(alerts, f"{log_path.rstrip('/')}/batch_id={batch_id}", mode="overwrite")

    return (
        detect_anomalies(telemetry, registry, campaigns).writeStream
        .foreachBatch(log_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or UNTIL_READ))
        .start()
    )


def start_cost_alarms(
    events: DataFrame, alarm_path: str, checkpoint: str, late_by: str = LATE_BY, trigger: dict | None = None
) -> StreamingQuery:
    """Log every change of a pair of periods, at once and not only when its window closes.

    ``current_alarms`` reads the log: the latest state of each pair decides, so an alarm is known
    while its window is open and is taken back if later events lower a mean. A batch that is run
    again overwrites its own folder.
    """
    def log_batch(pairs: DataFrame, batch_id: int) -> None:
        pairs.write.mode("overwrite").parquet(f"{alarm_path.rstrip('/')}/batch_id={batch_id}")

    return (
        period_pairs(events, late_by=late_by).writeStream
        .foreachBatch(log_batch)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(**(trigger or UNTIL_READ))
        .start()
    )


def current_alarms(spark: SparkSession, alarm_path: str) -> DataFrame:
    """The alarms as of the log's last batch: the folded state and the batches behind it."""
    return breaching(_latest(_log(spark, alarm_path, snapshots.current(spark, alarm_path))).drop("batch_id"))


def fold_alarms(spark: SparkSession, alarm_path: str) -> int:
    """Fold the log up to its last whole batch into one row a pair; returns that batch's number.

    The folded state is published as a new version, so readers beside it see the old state or the
    new one, and reading costs the pairs and the batches since, not all batches ever written. A batch
    that is run again after that writes the rows that the fold already holds and isn't read.
    """
    base = snapshots.current(spark, alarm_path)
    last = max(_batches(spark, alarm_path), default=-1)
    if last <= base.get("through", -1):
        return base.get("through", -1)
    folder = f"_folded-{last}-{uuid.uuid4().hex}"
    _latest(_log(spark, alarm_path, base)).write.parquet(f"{alarm_path.rstrip('/')}/{folder}")
    snapshots.publish(spark, alarm_path, base | {"parts": {"folded": [folder]}, "through": last}, base)
    return last


def _batches(spark: SparkSession, alarm_path: str) -> list[int]:
    """Numbers of the whole batches in the log."""
    return sorted(int(name.partition("=")[2]) for name in snapshots.names(spark, alarm_path)
                  if name.startswith("batch_id=") and "_SUCCESS" in snapshots.names(spark, f"{alarm_path.rstrip('/')}/{name}"))


def _log(spark: SparkSession, alarm_path: str, manifest: dict) -> DataFrame:
    root = alarm_path.rstrip("/")
    fields = ", ".join(f for f in PAIR_LOG.split(", ") if not f.startswith("batch_id"))
    parts = [read_parquet(spark, f"{root}/{folder}", PAIR_LOG) for folder in manifest["parts"].get("folded", [])]
    new = [number for number in _batches(spark, root) if number > manifest.get("through", -1)]
    if new:
        parts.append(spark.read.schema(PAIR_LOG).option("basePath", root).parquet(*[f"{root}/batch_id={n}" for n in new]))
    empty = spark.createDataFrame([], f"{fields}, batch_id long")
    return functools.reduce(DataFrame.unionByName, parts, empty)


def _latest(log: DataFrame) -> DataFrame:
    """The last state of every pair, with the number of its batch."""
    return log.groupBy("period_start", "alarm_at").agg(
        F.max_by(F.struct("previous_mean", "current_mean"), "batch_id").alias("means"), F.max("batch_id").alias("batch_id"),
    ).select("period_start", "alarm_at", "means.*", "batch_id")
