"""Small helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from allocspark.session import cut_lineage

__all__ = ["cut_lineage", "free_name", "read_table", "replace_columns", "schema_with", "text_or_empty", "tokenizer_path"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores added until no column of ``df`` has that name."""
    taken = {column.lower() for column in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def replace_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without the columns that an operator is about to add under ``names``."""
    added = {name.lower() for name in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in added])


def schema_with(df: DataFrame, **added: str) -> StructType:
    """The schema of ``df`` and further columns, given by name and type."""
    fresh = StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in added.items()))
    return StructType([*df.schema.fields, *fresh.fields])


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
