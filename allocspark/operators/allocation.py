"""Budget allocation: every campaign solved by its own row and the program, without shuffles.

All campaigns choose among the same corridors, at most 80 by the closed domains. The
corridors are folded once into a one-row program that is attached to every campaign as a
scalar subquery. Reports and budget-only plans run as higher-order functions over that array; the
constrained search runs in Arrow batches of campaigns (``search``), so the work is spread by
campaign rows and grows with them alone.

The constrained problem of a campaign is

    maximise   sum(gain x)
    subject to sum(cost x) <= budget
               sum(gain x over senior corridors) >= senior quota
               sum(x over a region) >= floor, for each region present, if diversity is on
               0 <= x <= capacity

Pricing the two coupling constraints leaves one independent fill per region, so any pair of
prices yields a vertex of the feasible set at once. The search follows chords: of two
vertices that bracket the budget, the price at which they tie is tried next, until no
vertex beats the chord; the mix of the two ends then spends the budget exactly. Where that
mix misses the senior quota, the same is done once more between two such mixes. Each try is
exact, so the end is an optimum and its prices prove it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from allocspark import schemas
from allocspark.functions.rounding import half_even, ratio, rounded
from allocspark.operators import search
from allocspark.operators.corridors import OBSERVED_CORRIDOR
from allocspark.session import cut_lineage

REGION_FLOOR_APPLICANTS = 50

# Texts of the solver status.
OPTIMAL = "OPTIMAL_CONVERGENCE"
INFEASIBLE = "SOLVER_INFEASIBLE"


# --------------------------------------------------------------------------- program


def corridor_program(metrics: DataFrame) -> DataFrame:
    """The corridors as one row: sorted units, and the units of each region.

    A corridor outside the closed domains raises, as it has no place in the program; the
    array is therefore never longer than the product of the domains.
    """
    known = (
        F.col("channel").isin(schemas.CHANNELS) & F.col("region").isin(schemas.REGIONS)
        & F.col("seniority").isin(schemas.SENIORITIES)
    )
    name = F.concat_ws("|", *OBSERVED_CORRIDOR)
    gain = F.col("overall_conversion_yield").cast("double")
    # A corridor that costs nothing comes first and is taken whole.
    spend_rate = F.when(F.col("cost_per_applicant_usd") == 0, F.lit(float("inf"))).otherwise(
        ratio(F.col("overall_conversion_yield"), F.col("cost_per_applicant_usd")))
    full_cost = F.col("cost_per_applicant_usd") * F.col("max_channel_capacity_applicants")
    # Costs of all corridors with a better yield per dollar: at most 80 rows.
    best_first = Window.orderBy(F.desc("per_dollar"), *OBSERVED_CORRIDOR)
    priced = metrics.withColumn("per_dollar", spend_rate).withColumn(
        "spent_before",
        F.coalesce(F.sum(full_cost).over(best_first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    )
    unit = F.struct(
        F.when(known, F.col("channel"))
        .otherwise(F.raise_error(F.concat(F.lit("corridor outside the closed domains: "), name)))
        .alias("channel"),
        "region", "seniority",
        F.col("cost_per_applicant_usd").cast("decimal(12,2)").alias("unit_cost"),
        F.col("overall_conversion_yield").cast("decimal(13,8)").alias("unit_yield"),
        F.col("max_channel_capacity_applicants").alias("unit_capacity"),
        F.col("spent_before").cast("decimal(24,2)").alias("spent_before"),
        F.col("cost_per_applicant_usd").cast("double").alias("cost"),
        gain.alias("gain"),
        F.when(F.col("seniority").isin(schemas.SENIOR_LEVELS), gain).otherwise(F.lit(0.0)).alias("senior_gain"),
        F.col("max_channel_capacity_applicants").cast("double").alias("capacity"),
    )
    units = priced.agg(F.sort_array(F.collect_list(unit)).alias("units"))
    numbered = F.transform("units", lambda u, i: u.withField("i", i))
    regions = F.array_distinct(F.transform("units", lambda u: u["region"]))
    by_region = F.transform(regions, lambda r: F.filter("units", lambda u: u["region"] == r))
    return units.withColumn("units", numbered).select(
        F.struct("units", by_region.alias("regions")).alias("program")
    )


def with_program(campaigns: DataFrame, program: DataFrame) -> DataFrame:
    return campaigns.withColumn("program", program.scalar())


# ------------------------------------------------------------------- pro-rata baseline


def pro_rata(campaigns: DataFrame, program: DataFrame) -> DataFrame:
    """The status quo: the budget in equal parts, each capped at its corridor's full cost."""
    planned = with_program(campaigns, program)
    units = F.col("program.units")
    part = F.col("total_budget_usd").cast("double") / F.greatest(F.size(units), F.lit(1))

    def add(total: Column, unit: Column) -> Column:
        spent = F.least(part, unit["capacity"] * unit["cost"])
        return F.struct(
            (total["spend"] + spent).alias("spend"),
            (total["hires"] + F.when(unit["cost"] > 0, spent / unit["cost"]).otherwise(unit["capacity"]) * unit["gain"]).alias("hires"),
        )

    zero = F.struct(F.lit(0.0).alias("spend"), F.lit(0.0).alias("hires"))
    totals = planned.withColumn("naive", F.aggregate(units, zero, add))
    spend, hires = F.col("naive.spend"), F.col("naive.hires")
    return totals.select(
        *campaigns.columns,
        rounded(hires, 2).alias("naive_heuristic_hires"),
        rounded(spend, 2).alias("naive_spend_usd"),
        F.when(hires > 0, rounded(ratio(spend, hires), 2)).otherwise(0).alias("naive_cost_per_hire_usd"),
    )


# ------------------------------------------------------------------------ the two plans


def greedy_plan(campaigns: DataFrame, program: DataFrame) -> DataFrame:
    """Budget-only optimum: corridors are filled by yield per dollar until the money is gone.

    The money a corridor leaves for the next is the same for all campaigns, so it is summed
    once over the corridors and each campaign only compares its budget with it.
    """
    planned = with_program(campaigns, program)
    budget = F.col("total_budget_usd")

    def amount(unit: Column) -> Column:
        left = (budget - unit["spent_before"]).cast("double")
        return F.when(unit["cost"] == 0, unit["capacity"]).otherwise(
            F.least(unit["capacity"], F.greatest(F.lit(0.0), left / unit["cost"])))

    return planned.withColumns({
        "solver_status": F.when(F.size("program.units") == 0, f"{INFEASIBLE}: no corridors").otherwise(OPTIMAL),
        "amounts": F.transform("program.units", amount),
    })


def constrained_plan(
    campaigns: DataFrame, program: DataFrame, region_floor: float | Column = REGION_FLOOR_APPLICANTS
) -> DataFrame:
    """Optimal applicants per corridor for every campaign, with the prices that prove them.

    Adds ``solver_status``, ``amounts`` (in unit order, all zero if infeasible), the prices
    ``budget_price`` and ``quota_price``, and ``dual_bound``, an upper limit on the hires of
    any feasible allocation. ``region_floor`` may be a column of the campaigns.
    """
    floor = region_floor if isinstance(region_floor, Column) else F.lit(float(region_floor))
    # At most 80 units, which a scalar subquery would bring to the driver as well.
    units = search.Units.of(program.select("program.units").first()[0])
    # A few bytes per campaign but many tries: deal the rows out to all cores, since by size
    # alone adaptive execution would gather them into one task.
    spread = campaigns.repartition(campaigns.sparkSession.sparkContext.defaultParallelism).withColumns({
        "_budget": F.coalesce(F.col("total_budget_usd").cast("double"), F.lit(0.0)),
        "_quota": F.greatest(F.col("min_senior_hires").cast("double"), F.lit(0.0)),
        "_floor": F.coalesce(F.when(F.col("regional_diversity_min_pct") > 0, floor), F.lit(0.0)).cast("double"),
    })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _solved(units, batch)

    given = [field for field in spread.schema if field.name not in SEARCHED]
    schema = T.StructType([*given, *T.StructType.fromDDL(
        "_phase int, amounts array<double>, budget_price double, quota_price double, dual_bound double")])
    # Settled once, so that no reader and no filter pushed below it solves the campaigns again.
    searched = with_program(cut_lineage(spread.mapInArrow(run, schema)), program)
    phase = F.col("_phase")
    status = (
        F.when(F.col("total_budget_usd").isNull(), f"{INFEASIBLE}: no budget given")
        .when(F.size("program.units") == 0, f"{INFEASIBLE}: no corridors")
        .when(phase == search.NO_ROOM, f"{INFEASIBLE}: region capacity below its floor")
        .when(phase == search.FLOORS_TOO_DEAR, f"{INFEASIBLE}: region floors exceed the budget")
        .when(phase == search.OUT_OF_REACH, f"{INFEASIBLE}: senior quota out of reach")
        .when(phase == search.SOLVED, OPTIMAL)
        .otherwise(F.raise_error(F.concat(F.lit("search not ended for campaign "), F.col("campaign_id"))))
    )
    solved = F.col("solver_status") == OPTIMAL
    return searched.withColumn("solver_status", status).select(
        *campaigns.columns, "program", "solver_status",
        F.when(solved, F.col("amounts")).otherwise(F.transform("program.units", lambda u: F.lit(0.0))).alias("amounts"),
        *[F.when(solved, F.col(name)).alias(name) for name in ("budget_price", "quota_price", "dual_bound")])


#: What the search reads of a campaign.
SEARCHED = ("_budget", "_quota", "_floor")


def _solved(units: search.Units, batch: pa.RecordBatch) -> pa.RecordBatch:
    """The campaigns of a batch with what the search found in place of what it reads."""
    given = [batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False) for name in SEARCHED]
    found = search.solve(units, *given)
    flat = found.pop("amounts")
    places = np.arange(0, flat.size + 1, flat.shape[1], dtype=np.int32) if flat.size else np.zeros(len(flat) + 1, np.int32)
    kept = [name for name in batch.schema.names if name not in SEARCHED]
    return pa.RecordBatch.from_arrays(
        [*(batch.column(batch.schema.get_field_index(name)) for name in kept), pa.array(found["phase"], pa.int32()),
         pa.ListArray.from_arrays(pa.array(places), pa.array(flat.ravel())),
         *(pa.array(found[name]) for name in ("budget_price", "quota_price", "dual_bound"))],
        names=[*kept, "_phase", "amounts", "budget_price", "quota_price", "dual_bound"])


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times."""
    return F.transform(F.array(value), body)[0]


# --------------------------------------------------------- integer plan and its reports


def integer_allocations(plan: DataFrame) -> DataFrame:
    """Whole applicants (half to even) with spend, hires and unit cost, as ``allocations``.

    Rounding comes after the optimum, so the spend may pass the budget by a few applicants.
    """
    def line(unit: Column, amount: Column) -> Column:
        applicants = F.bround(amount, 0).cast("int")
        spend = half_even(applicants * unit["unit_cost"], 2).cast("decimal(18,2)")
        hires = half_even(applicants * unit["unit_yield"], 2).cast("decimal(18,2)")
        return _let(F.struct(applicants.alias("n"), spend.alias("s"), hires.alias("h")), lambda v: F.struct(
            unit["channel"].alias("channel"), unit["region"].alias("region"),
            unit["seniority"].alias("seniority"),
            unit["unit_cost"].alias("unit_cost_usd"), unit["unit_yield"].alias("unit_yield"),
            unit["unit_capacity"].alias("unit_capacity"),
            v["n"].alias("allocated_applicants"), v["s"].alias("allocated_budget_usd"),
            v["h"].alias("expected_hires"),
            F.when(v["h"] > 0, rounded(ratio(v["s"], v["h"]), 2)).otherwise(0)
            .alias("effective_cost_per_hire_usd"),
        ))

    return plan.withColumn("allocations", F.zip_with("program.units", "amounts", line)).drop(
        "amounts", "program")


def allocation_lines(integers: DataFrame, keep_zero: bool = False) -> DataFrame:
    """One row per campaign and funded corridor (or every corridor).

    The outer form of explode is used on purpose: for the inner one Spark adds a filter on
    the array's size, which would compute all lines once more to evaluate it. The empty
    array's null row is dropped by the filters here.
    """
    lines = integers.select("campaign_id", "solver_status", F.explode_outer("allocations").alias("a"))
    flat = lines.select("campaign_id", "solver_status", "a.*")
    return flat.filter("allocated_applicants is not null" if keep_zero else "allocated_applicants > 0")


def campaign_results(integers: DataFrame) -> DataFrame:
    """Totals of each campaign's rounded lines against its pro-rata baseline.

    Expects the columns of ``pro_rata`` on the plan. Totals are sums over the row's own
    array, so nothing is shuffled.
    """
    def total(field: str, kind: str) -> Column:
        return F.aggregate(F.col("allocations"), F.lit(0).cast(kind),
                           lambda acc, a: (acc + a[field]).cast(kind))

    summed = integers.withColumns({
        "total_budget_allocated_usd": total("allocated_budget_usd", "decimal(20,2)"),
        "total_projected_hires": total("expected_hires", "decimal(20,2)"),
        "total_allocated_applicants": total("allocated_applicants", "bigint"),
        "senior_hires": F.aggregate(F.col("allocations"), F.lit(0).cast("decimal(20,2)"), lambda acc, a: (
            acc + F.when(a["seniority"].isin(schemas.SENIOR_LEVELS), a["expected_hires"]).otherwise(0))
            .cast("decimal(20,2)")),
    })
    spend, hires = F.col("total_budget_allocated_usd"), F.col("total_projected_hires")
    naive = F.col("naive_heuristic_hires")
    used = rounded(ratio(spend * 100, F.col("total_budget_usd")), 2)
    return summed.select(
        "campaign_id", "client_name", "solver_status", "total_budget_usd",
        "total_budget_allocated_usd", "total_projected_hires", "total_allocated_applicants", "senior_hires",
        F.least(used, F.lit(100)).alias("budget_utilization_pct"),
        F.when(hires > 0, rounded(ratio(spend, hires), 2)).otherwise(0).alias("blended_cost_per_hire_usd"),
        "naive_heuristic_hires", "naive_spend_usd", "naive_cost_per_hire_usd",
        F.when(naive > 0, rounded(ratio((hires - naive) * 100, naive), 2)).otherwise(0)
        .alias("efficiency_gain_pct"),
        # Additions: the rounding overshoot, and two targets that are not constraints.
        F.greatest(spend - F.col("total_budget_usd"), F.lit(0)).alias("overspend_usd"),
        (hires >= F.col("target_hires")).alias("meets_min_hires"),
        ((hires > 0) & (ratio(spend, hires) <= F.col("max_cph_target_usd"))).alias("meets_cph_target"),
    )


def tradeoff(results: DataFrame) -> DataFrame:
    """Optimal against pro-rata plan: gains, reductions and the verdict sentence."""
    naive_cost, best_cost = F.col("naive_cost_per_hire_usd"), F.col("blended_cost_per_hire_usd")
    saved = naive_cost - best_cost
    saved_pct = F.when(naive_cost > 0, ratio(saved * 100, naive_cost)).otherwise(0.0)

    def text(value: Column, places: int) -> Column:
        return rounded(value, places).cast(f"decimal(28,{places})").cast("string")

    return results.select(
        "campaign_id", "client_name", "total_budget_usd", "naive_heuristic_hires", "naive_cost_per_hire_usd",
        F.col("total_projected_hires").alias("optimal_linear_hires"),
        best_cost.alias("optimal_cost_per_hire_usd"),
        rounded(F.col("total_projected_hires") - F.col("naive_heuristic_hires"), 2).alias("hires_volume_gain"),
        "efficiency_gain_pct",
        rounded(saved, 2).alias("cost_per_hire_reduction_usd"),
        rounded(saved_pct, 2).alias("cost_per_hire_savings_pct"),
        F.concat(
            F.lit("Optimal allocation changes hires by "), text(F.col("efficiency_gain_pct"), 1),
            F.lit("% and lowers cost per hire by "), text(saved_pct, 1), F.lit("% ($"), text(saved, 2),
            F.lit(" per hire) under the same budget."),
        ).alias("conclusion"),
    )


def certificate(plan: DataFrame) -> DataFrame:
    """Proof data of a constrained plan: its hires, the dual bound, gap and violations."""
    placed = F.zip_with("program.units", "amounts", lambda u, x: F.struct(
        u["region"].alias("region"), x.alias("x"), (x * u["cost"]).alias("spend"),
        (x * u["gain"]).alias("hires"), (x * u["senior_gain"]).alias("senior")))

    def total(field: str) -> Column:
        return F.aggregate(F.col("placed"), F.lit(0.0), lambda acc, p: acc + p[field])

    regions = F.array_distinct(F.transform("placed", lambda p: p["region"]))
    by_region = F.transform(regions, lambda r: F.aggregate(
        F.col("placed"), F.lit(0.0), lambda acc, p: acc + F.when(p["region"] == r, p["x"]).otherwise(0.0)))
    measured = plan.withColumn("placed", placed).withColumns({
        "hires": total("hires"), "spend": total("spend"), "senior_hires": total("senior"),
        "smallest_region": F.array_min(by_region),
    })
    return measured.select(
        "campaign_id", "solver_status", "hires", "dual_bound", "budget_price", "quota_price",
        ((F.col("dual_bound") - F.col("hires")) / F.greatest(F.lit(1.0), F.abs("dual_bound")))
        .alias("relative_gap"),
        F.greatest(F.col("spend") - F.col("total_budget_usd").cast("double"), F.lit(0.0)).alias("budget_excess"),
        F.greatest(F.col("min_senior_hires") - F.col("senior_hires"), F.lit(0.0)).alias("quota_shortfall"),
        F.col("smallest_region").alias("smallest_region_applicants"),
    )


def plan_totals(plan: DataFrame) -> DataFrame:
    """Unrounded totals of each campaign's plan; an infeasible campaign has zeros and says why."""
    placed = F.zip_with("program.units", "amounts", lambda u, x: F.struct(
        x.alias("x"), (x * u["cost"]).alias("spend"), (x * u["gain"]).alias("hires"), (x * u["senior_gain"]).alias("senior")))

    def total(field: str) -> Column:
        return F.aggregate(F.col("placed"), F.lit(0.0), lambda acc, p: acc + p[field])

    return plan.withColumn("placed", placed).select(
        "campaign_id", "solver_status", F.size(F.filter("amounts", lambda x: x > 0)).cast("bigint").alias("funded_corridors"),
        total("x").alias("applicants"), total("spend").alias("spend_usd"), total("hires").alias("hires"),
        total("senior").alias("senior_hires"))
