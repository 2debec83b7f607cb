"""Distinct counts and quantiles from mergeable sketches, opt-in beside the exact ones.

A sketch is a few KB whatever it holds, and sketches of parts merge into the sketch of the whole. So a
day is sketched once, and any range of days is answered from its sketches without reading rows again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: 2**12 registers: the estimate of a distinct count has a standard error of about 1.6 %.
HLL_BITS = 12
HLL_ERROR = 1.04 / 2 ** (HLL_BITS / 2)
#: Size parameter of the quantile sketch, and the error of a rank that 99 of 100 answers stay below.
KLL_K = 400
KLL_RANK_ERROR = 0.0068


def sketched(rows: DataFrame, by: list[str], member: str = "campaign_id", value: str = "cost_per_applicant_usd") -> DataFrame:
    """Per group: a sketch of the distinct members, one of the values (null where there is none), and counts.
    Nulls are left out of both."""
    return rows.groupBy(*by).agg(
        F.hll_sketch_agg(member, F.lit(HLL_BITS)).alias("members"),
        F.when(F.count(value) > 0, F.kll_sketch_agg_double(F.col(value).cast("double"), KLL_K)).alias("values"),
        F.count(value).alias("n_values"), F.count(F.lit(1)).alias("n_rows"),
    )


def merged(sketches: DataFrame, by: list) -> DataFrame:
    """The same sketches for coarser groups: unions of those of ``sketched``."""
    return sketches.groupBy(*by).agg(
        F.hll_union_agg("members").alias("members"),
        F.when(F.sum("n_values") > 0, F.kll_merge_agg_double("values", KLL_K)).alias("values"),
        F.sum("n_values").alias("n_values"), F.sum("n_rows").alias("n_rows"),
    )


def estimated(sketches: DataFrame, *fractions: float) -> DataFrame:
    """campaigns (the estimated distinct members) and a column per fraction: ``cost_quantile`` for one,
    else an array ``cost_quantiles``; null without values."""
    quantiles = [F.kll_sketch_get_quantile_double("values", F.lit(float(f))) for f in fractions]
    answer = quantiles[0].alias("cost_quantile") if len(quantiles) == 1 else F.array(*quantiles).alias("cost_quantiles")
    return sketches.withColumn("campaigns", F.hll_sketch_estimate("members")).select(
        *[c for c in sketches.columns if c not in ("members", "values")], "campaigns", answer)
