"""From documents to packed training sequences, in five stages.

Each stage takes what the one before kept and returns the columns of documents, the last one the
packed pieces. ``run`` writes every stage's result to the shared folder and reads it again, so a
lost executor costs at most one stage. No stage changes a column that isn't its own, whatever its name.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from allocspark.llm import exact_dedup, minhash, packing, pii, toxicity
from allocspark.llm.common import read_table, tokenizer_path
from allocspark.session import ensure_checkpoint_dir

#: Setting with the secret key of the pseudonyms. Without it each application draws a key of its own:
#: pseudonyms are linked inside it and can't be undone or linked by anybody later.
KEY_SETTING = "spark.allocspark.pii.key"
_drawn: dict[str, bytes] = {}


def pseudonym_key(spark: SparkSession) -> bytes:
    given = spark.conf.get(KEY_SETTING, None)
    return given.encode() if given else _drawn.setdefault(spark.sparkContext.applicationId, os.urandom(32))


def _shielded(docs: DataFrame) -> DataFrame:
    """``docs`` with names for all columns but id and text that no operator gives its results."""
    return docs.select(*[F.col(f"`{c}`").alias(_shield(i, c)) for i, c in enumerate(docs.columns)])


def _shield(place: int, name: str) -> str:
    return name if name in ("doc_id", "text") else f"_document_{place}"


def _restored(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{_shield(i, c)}`").alias(c) for i, c in enumerate(docs.columns)])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity of at least 0.5 go; the lexicon is learned from the labelled documents."""
    lexicon = toxicity.learn(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return _restored(toxicity.toxicity(_shielded(docs), lexicon).where("predicted = 0"), docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal but for white space, the one with the longest text stays: one row,
    also where rows repeat an id or have none."""
    return _restored(exact_dedup.exact_dedup(_shielded(docs), one_row=True).where("kept"), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 on five-word shingles, that with the smallest id stays."""
    gone = minhash.near_duplicates(docs.select("doc_id", "text"), words=5, percent=80).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets become pseudonyms of their format; n_chars follows the new text."""
    fresh = pii.pseudonymise_column(_shielded(docs), pseudonym_key(spark))
    if "n_chars" in docs.columns:
        name = _shield(docs.columns.index("n_chars"), "n_chars")
        fresh = fresh.withColumn(name, F.when(F.col("n_replaced") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col(name)))
    return _restored(fresh, docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of at most 1024 tokens; a row for each piece, with its ids."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic), ("exact_dedup", drop_exact_copies), ("near_dedup", drop_near_copies),
    ("pii", pseudonymise), ("packing", pack_sequences),
]

#: No stage but exact dedup can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``; an empty table gives none."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{place}-{name}"
        result = stage(spark, docs, sf_dir)
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
    return docs
