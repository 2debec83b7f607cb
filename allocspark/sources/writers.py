"""Sinks: partitioned telemetry, the materialised rollup, run audit and anomaly log."""

from __future__ import annotations

from datetime import date, timedelta
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F

from allocspark import schemas
from allocspark.operators.rollup import efficiency_rollup
from allocspark.session import cut_lineage
from allocspark.sources.readers import between_dates, quarter_of


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet sink; missing parent folders are created by the file system layer."""
    df.write.mode(mode).parquet(path)


def write_telemetry_by_quarter(telemetry: DataFrame, path: str, mode: str = "append") -> None:
    """Route rows to one folder per calendar quarter of their event time.

    Rows are range-split on (quarter, event time) before the write: a busy quarter is
    spread over many tasks, and each file holds a narrow, sorted time span so Parquet
    min/max statistics can skip row groups.
    """
    (
        telemetry.withColumn("event_quarter", quarter_of(F.col("event_timestamp")))
        .repartitionByRange("event_quarter", "event_timestamp", "telemetry_id")
        .sortWithinPartitions("event_quarter", "event_timestamp")
        .write.mode(mode)
        .partitionBy("event_quarter")
        .parquet(path)
    )


def refresh_rollup(
    telemetry: DataFrame, campaigns: DataFrame, path: str, first_day: str, last_day: str
) -> None:
    """Rebuild the daily rollup for a closed range of days, replacing only those partitions.

    Seven extra days are read back so the moving means of the first day are whole. A day of
    the range that has no telemetry any more loses its partition.
    """
    start = date.fromisoformat(first_day) - timedelta(days=7)
    end = date.fromisoformat(last_day) + timedelta(days=1)
    recent = between_dates(telemetry, f"{start} 00:00:00", f"{end} 00:00:00")
    rollup = cut_lineage(efficiency_rollup(recent, campaigns).filter(
        F.col("snapshot_date").between(F.lit(first_day), F.lit(last_day))
    ))
    (
        rollup.repartition("snapshot_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date")
        .parquet(path)
    )
    filled = {str(row[0]) for row in rollup.select("snapshot_date").distinct().collect()}  # days of the range
    day = date.fromisoformat(first_day)
    while day < end:
        if day.isoformat() not in filled:
            _remove_folder(telemetry.sparkSession, f"{path.rstrip('/')}/snapshot_date={day.isoformat()}")
        day += timedelta(days=1)


def _remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder of any file system Spark can write; one that is not there is left."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def append_run_audit(results: DataFrame, path: str, job_key: str) -> None:
    """Audit rows of a job's campaign results, in a folder of the job that is written as a whole.

    The run id is a function of job and campaign, so a job that is run again replaces its own rows
    and no others. ``solve_time_ms`` is null: campaigns are solved side by side, none has a time.
    """
    audit = results.withColumns({
        "run_id": F.sha2(F.concat_ws("|", F.lit(job_key), F.col("campaign_id").cast("string")), 256),
        "campaign_id": F.col("campaign_id").cast("string"),
        "allocated_budget_usd": F.col("total_budget_allocated_usd"),
        "projected_hires": F.col("total_projected_hires"),
        "solve_time_ms": F.lit(None),
        "executed_at": F.current_timestamp(),
    })
    folder = f"{path.rstrip('/')}/job={quote(job_key, safe='')}"
    schemas.conform(audit, schemas.OPTIMIZATION_RUNS_AUDIT).write.mode("overwrite").parquet(folder)


def append_anomaly_log(alerts: DataFrame, path: str, mode: str = "append") -> None:
    """Append detected anomalies as log rows, with a fresh id and creation time."""
    logged = alerts.withColumns({
        "anomaly_id": F.expr("uuid()"),
        "created_at": F.current_timestamp(),
        "alert_payload": F.to_json(
            F.struct("alert_payload.*", F.current_timestamp().alias("evaluated_at")),
            {"ignoreNullFields": "false"},
        ),
    })
    schemas.conform(logged, schemas.SOURCING_ANOMALY_AUDIT_LOG).write.mode(mode).parquet(path)
