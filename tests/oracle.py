"""Compare a Spark result with a DuckDB statement over the same tables, row by row."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            connection.execute(f"create view {table} as select * from read_parquet('{path}')")
    return connection


def _cell(value):
    if value is None:
        return "null"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value + 0.0:.12g}"
    return str(value)


def canonical(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark_df, connection, sql: str) -> str | None:
    """None if equal, else a short description of the first differences."""
    ours = canonical(spark_df.columns, spark_df.collect())
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    theirs = canonical(names, result.fetchall())
    if sorted(spark_df.columns) != sorted(names):
        return f"columns differ: {sorted(set(spark_df.columns) ^ set(names))}"
    if ours == theirs:
        return None
    only_ours = [row for row in ours if row not in set(theirs)][:2]
    only_theirs = [row for row in theirs if row not in set(ours)][:2]
    return f"{len(ours)} vs {len(theirs)} rows; {sorted(names)}\n  spark {only_ours}\n  sql   {only_theirs}"
