"""Readers: explicit schemas, text event times, event-time ranges that prune quarters."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from allocspark import schemas


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan; a path that does not exist raises FileNotFoundError."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"Parquet source not found: {path}") from error
        raise


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    """Raw telemetry with its event-time text parsed and money and rates as exact decimals."""
    raw = read_parquet(spark, path, schemas.RAW_OBSERVATIONS)
    return normalise_observations(raw)


def normalise_observations(raw: DataFrame) -> DataFrame:
    return raw.withColumns({
        "cost_per_applicant_usd": F.col("cost_per_applicant_usd").cast("decimal(8,2)"),
        "interview_yield_rate": F.col("interview_yield_rate").cast("decimal(6,4)"),
        "offer_acceptance_rate": F.col("offer_acceptance_rate").cast("decimal(6,4)"),
        "overall_conversion_yield": F.col("overall_conversion_yield").cast("decimal(8,5)"),
        "event_timestamp": parse_event_time(F.col("event_timestamp")),
    })


def parse_event_time(text):
    return F.to_timestamp(text, "yyyy-MM-dd HH:mm:ss")


def format_event_time(epoch_seconds):
    """Epoch seconds to the text form the raw telemetry carries (UTC session zone)."""
    return F.date_format(F.timestamp_seconds(epoch_seconds), "yyyy-MM-dd HH:mm:ss")


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """One of the relational tables, read from ``root/<table>`` with its declared schema.

    Telemetry written by quarter keeps ``event_quarter`` as a partition column.
    """
    schema = schemas.TABLES[table]
    if table == "sourcing_telemetry":
        schema = T.StructType(schema.fields + [T.StructField("event_quarter", T.StringType())])
    return read_parquet(spark, f"{root.rstrip('/')}/{table}", schema).select(*schema.fieldNames())


def read_jdbc_table(
    spark: SparkSession, url: str, table: str, partition_column: str, lower: str, upper: str,
    partitions: int, **options: str,
) -> DataFrame:
    """Relational source read in parallel ranges of ``partition_column``."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=partition_column, lowerBound=lower,
                 upperBound=upper, numPartitions=str(partitions), **options)
        .load()
    )


def between_dates(telemetry: DataFrame, start: str, end: str) -> DataFrame:
    """Half-open event-time range that also names its quarters, so whole partitions are skipped.

    The bounds take the column's own type, so the comparison reaches the Parquet scan.
    """
    kind = telemetry.schema["event_timestamp"].dataType
    first, last = F.lit(start).cast(kind), F.lit(end).cast(kind)
    in_range = (F.col("event_timestamp") >= first) & (F.col("event_timestamp") < last)
    if "event_quarter" in telemetry.columns:
        in_range = in_range & F.col("event_quarter").between(quarter_of(first), quarter_of(last))
    return telemetry.filter(in_range)


def quarter_of(event_time):
    return F.concat(F.year(event_time).cast("string"), F.lit("Q"), F.quarter(event_time).cast("string"))
