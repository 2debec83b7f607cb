"""The daily rollup kept up to date from mergeable state: a refresh reads new rows only.

State, in parts that add up: sums and counts per (day, corridor, cost), distinct (day, corridor,
campaign) rows, sums per (corridor, instant), and sketches per (day, corridor). A refresh turns a batch
of new rows into such parts, written beside those of earlier batches, and assembles anew the quarters
whose days or moving means they touch, from state alone. State and rollup are published together
(``snapshots``); a batch that was published is not taken again, so a refresh can be repeated.
"""

from __future__ import annotations

import uuid
from collections import Counter
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from allocspark.operators import rollup, sketches
from allocspark.session import stored
from allocspark.sources import snapshots
from allocspark.sources.readers import quarter_of

MOVING_DAYS = 7
_DAY = "snapshot_date date, channel_name string, region string, seniority string"
_COST = "cost_per_applicant_usd decimal(8,2)"
#: Part -> (columns that identify a row, columns that add up).
STATE = {
    "cells": (f"{_DAY}, {_COST}", "n bigint, applicants bigint, spend decimal(28,2), hires decimal(28,2), yield_sum decimal(28,5), yields bigint"),
    "members": (f"{_DAY}, campaign_id string", ""),
    "instants": ("channel_name string, region string, seniority string, event_timestamp timestamp",
                 "cost_sum decimal(28,2), yield_sum decimal(28,5), costs bigint, yields bigint, observations bigint"),
    "sketches": (_DAY, "members binary, values binary, n_values bigint, n_rows bigint"),
}


def _fields(ddl: str) -> list[T.StructField]:
    return list(T.StructType.fromDDL(ddl)) if ddl else []


def _conform(df: DataFrame, part: str) -> DataFrame:
    keys, sums = STATE[part]
    return df.select("period", *[F.col(f.name).cast(f.dataType).alias(f.name) for f in _fields(keys) + _fields(sums)])


#: The folder of rows without a day.
NO_PERIOD = "__HIVE_DEFAULT_PARTITION__"
#: Members of a quarter for each file of its folder, about.
FILE_ROWS = 1_000_000


def _parts_of(rows: DataFrame, quarters: dict[str, int]) -> dict[str, DataFrame]:
    """The parts of a batch, laid out by quarter; ``quarters`` has the rows of each."""
    # Costs as the state holds them, so that no two rows of a batch's cells have one key.
    priced = rows.withColumn("cost_per_applicant_usd", F.col("cost_per_applicant_usd").cast(_fields(_COST)[0].dataType))
    cells = {
        "cells": rollup.cell_counts(priced), "instants": rollup.instant_sums(rows), "sketches": sketches.sketched(rows, rollup.CELL),
    }
    # A small quarter is one file, a large one is split by its size.
    laid = {name: _conform(df.withColumn("period", _period(name)), name).hint("rebalance", F.col("period")) for name, df in cells.items()}
    # Nearly as many as the rows, so they shuffle once, to the files they end in, and are made distinct there.
    named = rows.select(_period("members").alias("period"), *rollup.CELL, "campaign_id")
    files = F.create_map(*[F.lit(x) for quarter, n in quarters.items() for x in (quarter, 1 + n // FILE_ROWS)])[F.col("period")] if quarters else F.lit(1)
    place = F.pmod(F.xxhash64(*rollup.CELL, "campaign_id"), files).alias("file")
    members = named.select("*", place).repartition("period", "file").distinct()
    return laid | {"members": _conform(members, "members")}


def _period(part: str):
    return quarter_of(F.col("event_timestamp" if part == "instants" else "snapshot_date"))


def read_state(spark: SparkSession, root: str, part: str, periods: list[str] | None = None, manifest: dict | None = None) -> DataFrame:
    """One part of the state, merged over all batches; only the given quarters' folders are read.

    A batch's part is merged in itself, so the rows of a quarter that one batch alone holds stay where they are.
    """
    keys, sums = STATE[part]
    names = [f.name for f in _fields(keys)]
    schema = T.StructType([*_fields(keys), *_fields(sums), T.StructField("period", T.StringType())])
    batches = (manifest or snapshots.current(spark, root))["parts"].get(part, [])
    base = f"{root.rstrip('/')}/{part}"
    stored = spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{b}" for b in batches]) if batches else spark.createDataFrame([], schema)
    if periods is not None:
        stored = stored.where(F.col("period").isin(periods))
    if part == "sketches":
        return sketches.merged(stored, names)
    holders = Counter(folder.removeprefix("period=") for b in batches for folder in snapshots.names(spark, f"{base}/{b}"))
    shared = [quarter for quarter, n in holders.items() if n > 1 and (periods is None or quarter in periods)]
    columns = [*names, *[f.name for f in _fields(sums)]]
    if not shared:
        return stored.select(*columns)
    several = F.coalesce(F.col("period").isin(shared), F.lit(NO_PERIOD in shared))
    parts = stored.where(several)
    merged = parts.groupBy(*names).agg(*[F.sum(f.name).cast(f.dataType).alias(f.name) for f in _fields(sums)]) if sums else parts.select(*names).distinct()
    return stored.where(~several).select(*columns).unionByName(merged)


def read_rollup(spark: SparkSession, root: str, first: str = "0000Q1", last: str = "9999Q4") -> DataFrame:
    """The published rollup, of the given quarters ('1996Q1'): no other folder is listed or read."""
    manifest = snapshots.current(spark, root)
    paths = [f"{root.rstrip('/')}/{folder}/period={quarter}" for quarter, folder in sorted(manifest["folders"].items())
             if first <= quarter <= last]
    schema = T.StructType.fromJson(manifest["schema"]) if "schema" in manifest else T.StructType([])
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def refresh(spark: SparkSession, root: str, batch: str, rows: DataFrame, campaigns: DataFrame) -> dict:
    """Take in ``rows``, the telemetry that no earlier batch held, and publish the next version.

    ``batch`` names them: a batch that was taken in already changes nothing. Returns the version, the
    rows read and the quarters assembled anew.
    """
    base = snapshots.current(spark, root)
    if batch in base["batches"]:
        return {"version": base["version"], "rows": 0, "quarters": []}
    # Rows of a (day, corridor) lie together, large ones split by their size, so the sums and sketches of ``_parts_of``
    # are nearly whole before they shuffle.
    known = rollup.rollup_rows(rows, campaigns).withColumn("campaign_id", F.col("campaign_id").cast("string"))
    new = stored(known.hint("rebalance", *[F.col(name) for name in rollup.CELL]))
    count = new.count()
    by_day = {r[0]: r["count"] for r in new.groupBy("snapshot_date").count().collect()}  # days of the calendar
    days = list(by_day)
    sizes: dict[str, int] = {}
    for day, n in by_day.items():
        sizes[_quarter(day)] = sizes.get(_quarter(day), 0) + n
    folder = f"batch={batch}-{uuid.uuid4().hex}"
    parts = {name: list(folders) for name, folders in base["parts"].items()}
    for name, part in _parts_of(new, sizes).items():
        part.write.partitionBy("period").parquet(f"{root.rstrip('/')}/{name}/{folder}")
        if days:
            parts.setdefault(name, []).append(folder)
    touched = {_quarter(day + timedelta(days=d)) for day in days for d in (0, MOVING_DAYS)}
    held = set(base["folders"]) | {_quarter(day) for day in days}
    quarters = sorted(touched & held)
    manifest = base | {"batches": [*base["batches"], batch], "parts": parts, "folders": dict(base["folders"])}
    if quarters:
        before = sorted({*quarters, *(_before(q) for q in quarters)})
        fresh = rollup.assembled_rollup(
            read_state(spark, root, "cells", quarters, manifest), read_state(spark, root, "members", quarters, manifest),
            read_state(spark, root, "instants", before, manifest))
        target = f"rollup/{folder}"
        fresh.withColumn("period", quarter_of(F.to_date("snapshot_date"))).hint("rebalance", F.col("period")).write.partitionBy("period").parquet(
            f"{root.rstrip('/')}/{target}")
        manifest["folders"] |= {quarter: target for quarter in quarters}
        manifest["schema"] = fresh.schema.jsonValue()
    return {"version": snapshots.publish(spark, root, manifest, base)["version"], "rows": count, "quarters": quarters}


def compact(spark: SparkSession, root: str) -> dict:
    """Merge the state of all batches into one folder a part; answers stay the same."""
    base = snapshots.current(spark, root)
    folder = f"batch=merged-{uuid.uuid4().hex}"
    for name in base["parts"]:
        merged = read_state(spark, root, name, manifest=base).withColumn("period", _period(name))
        _conform(merged, name).hint("rebalance", F.col("period")).write.partitionBy("period").parquet(f"{root.rstrip('/')}/{name}/{folder}")
    return snapshots.publish(spark, root, base | {"parts": {name: [folder] for name in base["parts"]}}, base)


def _quarter(day: date) -> str:
    return f"{day.year}Q{(day.month + 2) // 3}"


def _before(quarter: str) -> str:
    return _quarter(date(int(quarter[:4]), 3 * int(quarter[5]) - 2, 1) - timedelta(days=1))
