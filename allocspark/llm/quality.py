"""Quality by importance resampling.

Two bags of hashed word n-grams are modelled: the target, documents labelled as good, and the raw
corpus, all documents. A document's log importance weight is the sum of the log ratios of its
n-grams; adding Gumbel noise and taking the largest k draws k documents without replacement in
proportion to their weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from allocspark.llm.common import cut_lineage, replace_columns, schema_with, text_or_empty

BUCKETS = 10_000
#: Share of the documents that is drawn.
SHARE = 0.5
#: At most so many target documents are learned from; of more, those with the smallest hash of their id.
TARGET_ROWS = 20_000
#: Keys in one step of the search for the k-th largest: so many rows come to the driver at most.
STEPS = 1_000
RESULTS = ["log_weight", "n_ngrams", "gumbel_key", "selected"]


def ngram_buckets(text: str | None) -> np.ndarray:
    """Bucket of every word and every pair of neighbouring words, A-Z lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    hashes = np.array(list(map(xxhash.xxh3_64_intdigest, words)), np.uint64)
    pairs = hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ hashes[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    pairs ^= pairs >> np.uint64(29)
    return (np.concatenate([hashes, pairs]) % np.uint64(BUCKETS)).astype(np.int64)


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Counts of all n-grams by bucket; every task sends ``BUCKETS`` sums at most, added up by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total += np.bincount(ngram_buckets(text), minlength=BUCKETS)
        places = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(total[places], pa.int64())], names=["bucket", "n"])

    counted = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    result = np.zeros(BUCKETS, np.int64)
    for row in counted:
        result[row["bucket"]] = row["n"]
    return result


def log_ratios(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               label_col: str = "quality", target_rows: int = TARGET_ROWS, held_out: Column | None = None) -> np.ndarray:
    """log p(bucket | target) - log p(bucket | corpus), smoothed by one count a bucket.

    The corpus model counts all of ``df``, the target model at most ``target_rows`` documents with
    label 1 for which ``held_out`` isn't true.
    """
    good = labels.where((F.col(label_col) == 1) & F.col(id_col).isNotNull())
    if held_out is not None:
        good = good.where(~held_out)
    chosen = good.select(F.col(id_col).alias("id")).distinct().orderBy(F.xxhash64("id"), "id").limit(target_rows)
    rows = df.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"))
    # Bounded by target_rows ids.
    target = bucket_counts(rows.join(F.broadcast(chosen), "id", "left_semi").select("text")) + 1.0
    corpus = bucket_counts(rows.select("text")) + 1.0
    return np.log(target / target.sum()) - np.log(corpus / corpus.sum())


def importance(df: DataFrame, ratios: np.ndarray, text_col: str = "text") -> DataFrame:
    """Every row of ``df`` with log_weight (the sum of its n-grams' log ratios) and n_ngrams."""
    kept = replace_columns(df, RESULTS)
    at = [c.lower() for c in kept.columns].index(text_col.lower())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [ngram_buckets(text) for text in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([float(ratios[f].sum()) for f in found], pa.float64()), pa.array(map(len, found), pa.int64())],
                names=[*batch.schema.names, "log_weight", "n_ngrams"])

    return kept.mapInArrow(run, schema_with(kept, log_weight="double", n_ngrams="long"))


def gumbel(id_col: str, seed: int) -> Column:
    """Standard Gumbel noise, a function of the id and the seed."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(f"`{id_col}`")), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(-F.log(uniform))


def top_k(df: DataFrame, key: str, order: str, k: int) -> Column:
    """Whether a row is among the ``k`` largest by ``key``; equal keys go by the smaller ``order``.

    The k-th largest is found by counting keys in ``STEPS`` equal steps of a range that narrows to
    the step where it lies, so the driver sees counts only, a bounded number of times; equal keys
    are told apart by the same search over their order.
    """
    if k <= 0:
        return F.lit(False)
    border, above = _kth(df, F.col(key), k)
    if border is None:
        return F.lit(True)
    tied = df.where(F.col(key) == border)
    last, _ = _kth(tied, -F.col(order).cast("double"), k - above)
    if last is None:
        return F.col(key) >= border
    return (F.col(key) > border) | ((F.col(key) == border) & (-F.col(order).cast("double") >= last))


def _kth(df: DataFrame, value: Column, k: int) -> tuple[float | None, int]:
    """(the k-th largest value, how many are larger); None if there are at most k values."""
    rows = df.select(value.alias("v")).where("v is not null")
    low, high, n = rows.agg(F.min("v"), F.max("v"), F.count("*")).first()
    if n <= k:
        return None, n
    above = 0
    while low < high:
        step = (high - low) / STEPS
        if not low < low + step < high:
            # The range has hardly any numbers left: take them one by one.
            for v, m in rows.where(F.col("v").between(low, high)).groupBy("v").count().orderBy(F.desc("v")).limit(STEPS).collect():
                if above + m >= k:
                    return v, above
                above += m
            return low, above
        place = F.least(F.floor((F.col("v") - F.lit(low)) / F.lit(step)), F.lit(STEPS - 1))
        counts = dict(rows.where(F.col("v").between(low, high)).groupBy(place.alias("p")).count().collect())
        for p in sorted(counts, reverse=True):
            if above + counts[p] >= k:
                break
            above += counts[p]
        low, high = rows.where(F.col("v").between(low, high) & (place == p)).agg(F.min("v"), F.max("v")).first()
    return low, above


def resample(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", share: float = SHARE, seed: int = 0, held_out: Column | None = None) -> DataFrame:
    """Per row of ``df``: the id, log_weight, n_ngrams, gumbel_key and selected.

    floor(share * rows) rows are selected, by the log weight and Gumbel noise; a long document's
    weight sums more n-grams, as the ratio of the two models does. A null or empty text has weight 0. Equal
    keys, as those of rows that repeat an id and a text, go by the smaller id and are selected
    together, which can exceed the share by such repeats; a null id is like any other. Ids are numbers; for
    ties they are compared as doubles. Without
    labelled rows the target is flat and the draw near uniform. Other input columns are left out.
    """
    ratios = log_ratios(df, labels, id_col, text_col, label_col, held_out=held_out)
    weighed = importance(df.select(F.col(f"`{id_col}`"), text_or_empty(text_col).alias(text_col)), ratios, text_col).drop(text_col)
    keyed = cut_lineage(weighed.withColumn("gumbel_key", F.col("log_weight") + gumbel(id_col, seed)))
    k = int(share * keyed.count())
    return keyed.withColumn("selected", F.coalesce(top_k(keyed, "gumbel_key", id_col, k), F.lit(False)))
