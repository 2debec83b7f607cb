"""Declared constraints as data-quality jobs: quarantine, uniqueness, references, profile."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, functions as F

from allocspark import schemas


def _listed(column: str, values: list[str]) -> str:
    return f"{column} in ({', '.join(repr(v) for v in values)})"


_DOMAINS = {
    "channel_in_domain": _listed("channel_name", schemas.CHANNELS),
    "region_in_domain": _listed("region", schemas.REGIONS),
    "seniority_in_domain": _listed("seniority", schemas.SENIORITIES),
}

# Rule name -> predicate every valid row meets. A NULL result counts as a failure.
TELEMETRY_RULES = {
    "campaign_present": "campaign_id is not null",
    "event_time_present": "event_timestamp is not null",
    "cost_positive": "cost_per_applicant_usd > 0",
    "applicants_not_negative": "allocated_applicants >= 0",
    "spend_not_negative": "allocated_spend_usd >= 0",
    "interview_rate_not_negative": "interview_yield_rate >= 0",
    "offer_rate_not_negative": "offer_acceptance_rate >= 0",
    "yield_not_negative": "overall_conversion_yield >= 0",
    "hires_not_negative": "projected_hires >= 0",
    **_DOMAINS,
}
CAMPAIGN_RULES = {
    "campaign_id_present": "length(cast(campaign_id as string)) between 1 and 64",
    "client_name_length": "length(client_name) between 2 and 128",
    "budget_positive": "total_budget_usd > 0",
    "target_hires_positive": "target_hires > 0",
    "senior_quota_not_negative": "min_senior_hires >= 0",
    "cph_target_positive": "max_cph_target_usd > 0",
    "diversity_share_in_range": "regional_diversity_min_pct between 0 and 0.50",
}
REGISTRY_RULES = {
    "corridor_id_length": "length(corridor_id) between 1 and 64",
    "baseline_positive": "baseline_cpa_usd > 0",
    "capacity_positive": "saturation_capacity > 0",
    "interview_yield_positive": "expected_interview_yield > 0",
    "offer_acceptance_positive": "expected_offer_acceptance > 0",
    **_DOMAINS,
}
CORRIDOR_UNIT_RULES = {
    "cost_positive": "cost_per_applicant_usd > 0",
    "capacity_positive": "max_channel_capacity_applicants > 0",
    "interview_rate_in_unit_interval": "interview_yield_rate > 0 and interview_yield_rate <= 1",
    "offer_rate_in_unit_interval": "offer_acceptance_rate > 0 and offer_acceptance_rate <= 1",
    "channel_in_domain": _listed("channel", schemas.CHANNELS),
    "region_in_domain": _listed("region", schemas.REGIONS),
    "seniority_in_domain": _listed("seniority", schemas.SENIORITIES),
}


def with_failed_rules(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Add ``failed_rules``: names of the rules a row breaks, in declared order."""
    failures = [
        F.when(~F.coalesce(F.expr(f"({predicate})"), F.lit(False)), F.lit(name))
        for name, predicate in rules.items()
    ]
    return df.withColumn("failed_rules", F.array_compact(F.array(*failures)))


def split_quarantine(df: DataFrame, rules: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows that meet every rule, and the others with their reasons."""
    checked = with_failed_rules(df, rules)
    return (
        checked.filter(F.size("failed_rules") == 0).drop("failed_rules"),
        checked.filter(F.size("failed_rules") > 0),
    )


def rule_profile(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """One row per rule with the rows read and the rows that break it, in one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows_read"),
        *[F.count_if(~F.coalesce(F.expr(f"({predicate})"), F.lit(False))).alias(name)
          for name, predicate in rules.items()],
    )
    return counted.unpivot("rows_read", list(rules), "rule_name", "rows_failed")


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Key values held by more than one row; NULL keys are not compared."""
    present = df.dropna(subset=key)
    return present.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def missing_references(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key has no parent row."""
    return child.filter(F.col(key).isNotNull()).join(parent.select(key).distinct(), key, "left_anti")


#: The declared keys: constraint -> (table, columns).
DECLARED_KEYS = {
    "campaign_master_pkey": ("campaign_master", ["campaign_id"]),
    "channel_corridor_registry_pkey": ("channel_corridor_registry", ["corridor_id"]),
    "uq_channel_corridor": ("channel_corridor_registry", schemas.CORRIDOR),
    "pk_sourcing_telemetry": ("sourcing_telemetry", ["event_timestamp", "telemetry_id"]),
    "optimization_runs_audit_pkey": ("optimization_runs_audit", ["run_id"]),
}
#: The declared references: constraint -> (table, column, parent table, parent column).
DECLARED_REFERENCES = {
    "sourcing_telemetry_campaign_id_fkey": ("sourcing_telemetry", "campaign_id", "campaign_master", "campaign_id"),
    "optimization_runs_audit_campaign_id_fkey": ("optimization_runs_audit", "campaign_id", "campaign_master", "campaign_id"),
}


def _key_text(columns: list[str]):
    return F.concat_ws("|", *[F.col(c).cast("string") for c in columns])


def broken_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """(constraint_name, key_value, copies): values that rows of a table with a declared key share. A key
    with a null column isn't compared.

    All tables go through one aggregate over (constraint, key), which counts on the map side first, so
    neither a large table nor a value that many rows share gathers anywhere.
    """
    keys = [
        tables[table].dropna(subset=columns).select(F.lit(name).alias("constraint_name"), _key_text(columns).alias("key_value"))
        for name, (table, columns) in DECLARED_KEYS.items() if table in tables
    ]
    every = functools.reduce(DataFrame.unionByName, keys)
    return every.groupBy("constraint_name", "key_value").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def broken_references(tables: dict[str, DataFrame]) -> DataFrame:
    """(constraint_name, key_value, child_rows): values without a parent row, and how many rows hold them.

    Children are counted by value before they meet the parents, so a value that a third of the rows
    hold is one row of the join.
    """
    found = []
    for name, (table, column, parent, parent_column) in DECLARED_REFERENCES.items():
        if table in tables and parent in tables:
            held = tables[table].where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("key_value")).agg(
                F.count(F.lit(1)).alias("child_rows"))
            known = tables[parent].select(F.col(parent_column).cast("string").alias("key_value")).distinct()
            found.append(held.join(known, "key_value", "left_anti").select(F.lit(name).alias("constraint_name"), "key_value", "child_rows"))
    return functools.reduce(DataFrame.unionByName, found)


def dataset_profile(observations: DataFrame) -> DataFrame:
    """Rows, nulls and bounds of the raw telemetry in one pass."""
    columns = ["cost_per_applicant_usd", "max_channel_capacity_applicants", "interview_yield_rate",
               "offer_acceptance_rate", "overall_conversion_yield"]
    return observations.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.sum(sum((F.col(name).isNull().cast("int") for name in observations.columns), F.lit(0)))
        .alias("null_values"),
        *[F.min(name).cast("double").alias(f"min_{name}") for name in columns],
        *[F.max(name).cast("double").alias(f"max_{name}") for name in columns],
        F.count_if(F.expr("cost_per_applicant_usd <= 0")).alias("cost_not_positive"),
        F.count_if(F.expr("max_channel_capacity_applicants <= 0")).alias("capacity_not_positive"),
        F.count_if(F.expr("overall_conversion_yield <= 0 or overall_conversion_yield > 1")).alias("yield_out_of_range"),
    )
