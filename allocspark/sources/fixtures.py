"""Recruitment tables derived from the star-schema and event tables the driver supplies.

Every value is a rule over the given rows; nothing is generated. Arithmetic stays in
exact decimals so another engine computes the same rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F

from allocspark.sources.readers import read_parquet

# Channel, mean cost, mean capacity, mean interview rate.
CHANNEL_BASE = [
    ("1-URGENT", "signup", "Executive Headhunting", "125.0", 110, "0.440"),
    ("2-HIGH", "purchase", "Talent Network Pool", "24.0", 725, "0.320"),
    ("3-MEDIUM", "click", "Direct AI Sourcing", "48.0", 1600, "0.170"),
    ("4-NOT SPECIFIED", "error", "Sponsored Campaigns", "36.0", 2500, "0.075"),
    ("5-LOW", "view", "Programmatic Job Boards", "16.0", 5000, "0.045"),
]
# Region key, region, cost multiplier.
REGION_BASE = [
    (0, "EMEA", "1.10"),
    (1, "North America", "1.55"),
    (2, "APAC", "0.75"),
    (3, "EMEA", "1.10"),
    (4, "LATAM", "0.65"),
]
# Seniority key, seniority, cost multiplier, interview-rate multiplier.
SENIORITY_BASE = [
    (0, "Junior Specialist", "0.75", "1.15"),
    (1, "Mid-Level Engineer", "1.00", "1.00"),
    (2, "Senior Lead", "1.40", "0.85"),
    (3, "Staff Architect", "1.95", "0.68"),
]


def _values(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A few fixed rows as an in-plan relation; its size is known, so joins broadcast it."""
    literal = ", ".join(
        "(" + ", ".join(f"'{v}'" if isinstance(v, str) and not _is_number(v) else str(v) for v in row) + ")"
        for row in rows
    )
    return spark.sql(f"select * from values {literal} as v({columns})")


def _is_number(text: str) -> bool:
    return text.replace(".", "", 1).isdigit()


def dim_channel(spark: SparkSession) -> DataFrame:
    return _values(spark, CHANNEL_BASE, "prio, etype, channel_name, cb, cap, s1")


def dim_region(spark: SparkSession) -> DataFrame:
    return _values(spark, REGION_BASE, "rk, region, rm")


def dim_seniority(spark: SparkSession) -> DataFrame:
    return _values(spark, SENIORITY_BASE, "sk, seniority, sm, ym")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def campaign_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One campaign per customer with orders; it starts with the customer's first order."""
    first_order = (
        _table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("campaign_id"))
        .agg(F.min("o_orderdate").alias("created_at"))
    )
    customer = _table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "campaign_id")
    return customer.join(first_order, "campaign_id").select(
        "campaign_id",
        F.col("c_name").alias("client_name"),
        F.expr("cast(20000 + 10 * greatest(cast(c_acctbal as decimal(10,2)), cast(0 as decimal(10,2)))"
               " as decimal(12,2))").alias("total_budget_usd"),
        F.expr("cast(30 + campaign_id % 40 as int)").alias("target_hires"),
        F.expr("cast(4 * (campaign_id % 4) as int)").alias("min_senior_hires"),
        F.expr("cast(5000 as decimal(10,2))").alias("max_cph_target_usd"),
        F.expr("cast(case when campaign_id % 5 = 0 then 0.0 else 0.15 end as decimal(5,4))")
        .alias("regional_diversity_min_pct"),
        F.lit(True).alias("is_active"),
        "created_at",
    )


def channel_corridor_registry(spark: SparkSession) -> DataFrame:
    """Every (channel, region, seniority) of the closed domains: 80 rows."""
    regions = {region: F.struct(F.lit(region).alias("region"), F.lit(Decimal(rm)).alias("rm"))
               for _, region, rm in REGION_BASE}
    levels = [F.struct(F.lit(name).alias("seniority"), F.lit(Decimal(sm)).alias("sm"), F.lit(Decimal(ym)).alias("ym"))
              for _, name, sm, ym in SENIORITY_BASE]
    triples = (
        dim_channel(spark).withColumn("r", F.explode(F.array(*regions.values())))
        .withColumn("l", F.explode(F.array(*levels))).select("channel_name", "cb", "cap", "s1", "r.*", "l.*")
    )
    return triples.select(
        F.concat_ws("|", "channel_name", "region", "seniority").alias("corridor_id"),
        "channel_name", "region", "seniority",
        F.expr("cast(cb * rm * sm as decimal(8,2))").alias("baseline_cpa_usd"),
        F.col("cap").alias("saturation_capacity"),
        F.expr("cast(s1 * ym as decimal(6,4))").alias("expected_interview_yield"),
        F.expr("cast(0.3600 as decimal(6,4))").alias("expected_offer_acceptance"),
        F.lit(True).alias("is_active"),
    )


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table's files as an arriving stream."""
    schema = _table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}*.parquet").parquet(sf_dir)


def telemetry_base(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """One observation per order line; the other telemetry shapes are projections of it.

    ``lines`` replaces the table, e.g. by a stream of the same rows.
    """
    line = _table(spark, sf_dir, "lineitem") if lines is None else lines
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    # Joined one table at a time, so that each right side is a file whose size Spark knows.
    placed = (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(F.broadcast(dim_region(spark)), F.col("rk") == F.col("n_regionkey"))
        .join(F.broadcast(dim_channel(spark)), F.col("prio") == F.col("o_orderpriority"))
        .join(F.broadcast(dim_seniority(spark)), F.col("sk") == F.col("l_partkey") % 4)
    )
    observed = placed.select(
        F.expr("concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,"
               " cast(cast(l_shipdate as date) as string))").alias("telemetry_id"),
        F.col("o_custkey").alias("campaign_id"),
        "channel_name", "region", "seniority",
        F.concat_ws("|", "channel_name", "region", "seniority").alias("corridor_id"),
        F.expr("cast(cb * rm * sm * (0.70 + 10 * cast(l_discount as decimal(4,2))"
               " + 4 * cast(l_tax as decimal(4,2))) as decimal(8,2))").alias("cost_per_applicant_usd"),
        F.expr("cast(l_quantity as int)").alias("allocated_applicants"),
        F.expr("cast(cap - 5 + l_partkey % 11 as int)").alias("max_channel_capacity_applicants"),
        F.expr("cast(round(s1 * ym * (0.50 + 0.02 * cast(l_quantity as decimal(4,0))), 4)"
               " as decimal(6,4))").alias("interview_yield_rate"),
        F.expr("cast(round(0.10 + 0.0057 * cast(l_suppkey % 97 as decimal(4,0)), 4)"
               " as decimal(6,4))").alias("offer_acceptance_rate"),
        "l_returnflag",
        F.expr("l_orderkey % 16 <> 0").alias("is_active_corridor"),
        F.col("l_shipdate").alias("event_timestamp"),
    )
    return observed.withColumns({
        "overall_conversion_yield": F.expr(
            "cast(round(interview_yield_rate * offer_acceptance_rate, 5) as decimal(8,5))"),
        "allocated_spend_usd": F.expr(
            "cast(cost_per_applicant_usd * allocated_applicants as decimal(12,2))"),
    })


def sourcing_telemetry(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    return telemetry_base(spark, sf_dir, lines).select(
        "telemetry_id", "campaign_id", "channel_name", "region", "seniority",
        "cost_per_applicant_usd", "allocated_applicants", "allocated_spend_usd",
        "interview_yield_rate", "offer_acceptance_rate", "overall_conversion_yield",
        F.expr("cast(round(allocated_applicants * overall_conversion_yield, 2) as decimal(8,2))")
        .alias("projected_hires"),
        "event_timestamp",
    )


def raw_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_base(spark, sf_dir).select(
        F.col("telemetry_id").alias("allocation_id"), F.col("channel_name").alias("channel"),
        "region", "seniority", "cost_per_applicant_usd", "max_channel_capacity_applicants",
        "interview_yield_rate", "offer_acceptance_rate", "overall_conversion_yield",
        "is_active_corridor", "event_timestamp",
    )


def corridor_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_base(spark, sf_dir).select(
        "telemetry_id", "corridor_id", F.col("channel_name").alias("sourcing_channel"),
        F.col("region").alias("talent_region"), F.col("seniority").alias("role_seniority"),
        "event_timestamp", "cost_per_applicant_usd", "interview_yield_rate", "offer_acceptance_rate",
        F.expr("l_returnflag <> 'N'").alias("passed_interview"),
        F.expr("l_returnflag = 'R'").alias("hired_flag"),
        "is_active_corridor",
    )


def candidate_journeys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One path of channel touches per user of the event table."""
    return (
        _table(spark, sf_dir, "events")
        .join(F.broadcast(dim_channel(spark)), F.col("etype") == F.col("event_type"))
        .select(
            F.col("event_id").alias("telemetry_id"), F.col("user_id").alias("corridor_id"),
            F.col("channel_name").alias("sourcing_channel"), F.col("ts").alias("event_timestamp"),
            F.col("value").cast("decimal(8,2)").alias("cost_per_applicant_usd"),
            F.expr("event_id % 3 <> 1").alias("passed_interview"),
            F.expr("event_id % 3 = 0").alias("hired_flag"),
            F.expr("event_id % 16 <> 0").alias("is_active_corridor"),
        )
    )


def cost_events(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Metric feed for the cost alarm: event time and observed cost."""
    table = _table(spark, sf_dir, "events") if events is None else events
    return table.select(
        F.col("ts").alias("event_timestamp"), F.col("value").cast("decimal(18,4)").alias("cost_usd")
    )
