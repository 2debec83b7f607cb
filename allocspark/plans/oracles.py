"""The SQL each query is checked against, written directly over whole tables.

The statements share a WITH prefix that derives the recruitment tables. They use the
plain forms (direct windows, self-joins, per-campaign windows) that the Spark operators
avoid, so the two sides reach the same rows by different ways.
"""

from __future__ import annotations

from allocspark import schemas


def _fixture_ctes() -> dict[str, str]:
    return {
        "dim_channel": """select * from (values
  ('1-URGENT','signup','Executive Headhunting',125.0,110,0.440),
  ('2-HIGH','purchase','Talent Network Pool',24.0,725,0.320),
  ('3-MEDIUM','click','Direct AI Sourcing',48.0,1600,0.170),
  ('4-NOT SPECIFIED','error','Sponsored Campaigns',36.0,2500,0.075),
  ('5-LOW','view','Programmatic Job Boards',16.0,5000,0.045)) v(prio,etype,channel_name,cb,cap,s1)""",
        "dim_region": """select * from (values
  (0,'EMEA',1.10),(1,'North America',1.55),(2,'APAC',0.75),(3,'EMEA',1.10),(4,'LATAM',0.65)) v(rk,region,rm)""",
        "dim_seniority": """select * from (values
  (0,'Junior Specialist',0.75,1.15),(1,'Mid-Level Engineer',1.00,1.00),
  (2,'Senior Lead',1.40,0.85),(3,'Staff Architect',1.95,0.68)) v(sk,seniority,sm,ym)""",
        "campaign_master": """select c.c_custkey as campaign_id, c.c_name as client_name,
  cast(20000 + 10*greatest(cast(c.c_acctbal as decimal(10,2)),cast(0 as decimal(10,2))) as decimal(12,2)) as total_budget_usd,
  cast(30 + c.c_custkey%40 as int) as target_hires, cast(4*(c.c_custkey%4) as int) as min_senior_hires,
  cast(5000 as decimal(10,2)) as max_cph_target_usd,
  cast(case when c.c_custkey%5=0 then 0.0 else 0.15 end as decimal(5,4)) as regional_diversity_min_pct,
  true as is_active, min(o.o_orderdate) as created_at
  from customer c join orders o on o.o_custkey=c.c_custkey group by c.c_custkey,c.c_name,c.c_acctbal""",
        "channel_corridor_registry": """select concat(channel_name,'|',region,'|',seniority) as corridor_id,
  channel_name, region, seniority, cast(cb*rm*sm as decimal(8,2)) as baseline_cpa_usd,
  cap as saturation_capacity, cast(s1*ym as decimal(6,4)) as expected_interview_yield, 0.36 as expected_offer_acceptance
  from dim_channel cross join (select distinct region,rm from dim_region) r cross join dim_seniority""",
        "base_line": """select
  concat_ws('-',l_orderkey,l_linenumber,l_partkey,l_suppkey,cast(cast(l_shipdate as date) as varchar(10))) as telemetry_id,
  o.o_custkey as campaign_id, channel_name, region, seniority,
  concat(channel_name,'|',region,'|',seniority) as corridor_id,
  cast(cb*rm*sm*(0.70+10*cast(l_discount as decimal(4,2))+4*cast(l_tax as decimal(4,2))) as decimal(8,2)) as cost_per_applicant_usd,
  cast(l_quantity as int) as allocated_applicants,
  cast(cap - 5 + l_partkey%11 as int) as max_channel_capacity_applicants,
  cast(round(s1*ym*(0.50+0.02*cast(l_quantity as decimal(4,0))),4) as decimal(6,4)) as interview_yield_rate,
  cast(round(0.10+0.0057*cast(l_suppkey%97 as decimal(4,0)),4) as decimal(6,4)) as offer_acceptance_rate,
  l_returnflag, l_orderkey%16<>0 as is_active_corridor, l_shipdate as event_timestamp
  from lineitem join orders o on l_orderkey=o.o_orderkey join customer c on o.o_custkey=c.c_custkey
  join nation on c.c_nationkey=n_nationkey join dim_channel on prio=o.o_orderpriority
  join dim_region on rk=n_regionkey join dim_seniority on sk=l_partkey%4""",
        "telemetry_all": """select *, cast(round(interview_yield_rate*offer_acceptance_rate,5) as decimal(8,5)) as overall_conversion_yield,
  cast(cost_per_applicant_usd*allocated_applicants as decimal(12,2)) as allocated_spend_usd from base_line""",
        "sourcing_telemetry": """select telemetry_id, campaign_id, channel_name, region, seniority, cost_per_applicant_usd,
  allocated_applicants, allocated_spend_usd, interview_yield_rate, offer_acceptance_rate, overall_conversion_yield,
  cast(round(allocated_applicants*overall_conversion_yield,2) as decimal(8,2)) as projected_hires, event_timestamp
  from telemetry_all""",
        "raw_observations": """select telemetry_id as allocation_id, channel_name as channel, region, seniority,
  cost_per_applicant_usd, max_channel_capacity_applicants, interview_yield_rate, offer_acceptance_rate,
  overall_conversion_yield, is_active_corridor, event_timestamp from telemetry_all""",
        "corridor_history": """select telemetry_id, corridor_id, channel_name as sourcing_channel, region as talent_region,
  seniority as role_seniority, event_timestamp, cost_per_applicant_usd, interview_yield_rate, offer_acceptance_rate,
  l_returnflag<>'N' as passed_interview, l_returnflag='R' as hired_flag, is_active_corridor from telemetry_all""",
        "candidate_journeys": """select event_id as telemetry_id, user_id as corridor_id, channel_name as sourcing_channel,
  ts as event_timestamp, cast(value as decimal(8,2)) as cost_per_applicant_usd,
  event_id%3<>1 as passed_interview, event_id%3=0 as hired_flag, event_id%16<>0 as is_active_corridor
  from events join dim_channel on etype=event_type""",
    }


_NEEDS = {
    "campaign_master": [], "channel_corridor_registry": ["dim_channel", "dim_region", "dim_seniority"],
    "base_line": ["dim_channel", "dim_region", "dim_seniority"], "telemetry_all": ["base_line"],
    "sourcing_telemetry": ["telemetry_all"], "raw_observations": ["telemetry_all"],
    "corridor_history": ["telemetry_all"], "candidate_journeys": ["dim_channel"],
    "dim_channel": [], "dim_region": [], "dim_seniority": [],
}


def _with(fixtures: list[str], ctes: dict[str, str], final: str) -> str:
    """A statement over the named fixtures (and what they need) and its own CTEs."""
    wanted: list[str] = []

    def need(name: str) -> None:
        for other in _NEEDS[name]:
            need(other)
        if name not in wanted:
            wanted.append(name)

    for name in fixtures:
        need(name)
    texts = _fixture_ctes()
    parts = [f"{name} as ({texts[name]})" for name in wanted] + [f"{name} as ({sql})" for name, sql in ctes.items()]
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + final


def _r(expression: str, places: int) -> str:
    """Round half away from zero on a decimal with 12 places."""
    return f"round(cast({expression} as decimal(38,12)), {places})"


def _d(expression: str, places: int) -> str:
    return f"cast({_r(expression, places)} as double)"


def _f(expression: str) -> str:
    return f"cast({expression} as double)"


def _avg(column: str) -> str:
    return f"(cast(sum({column}) as double) / nullif(count({column}), 0))"


def _div(numerator: str, denominator: str) -> str:
    return f"(cast({numerator} as double) / nullif(cast({denominator} as double), 0))"


def _even(expression: str, places: int) -> str:
    """Round an exact non-negative decimal half to even."""
    scale = 10 ** places
    scaled = f"(({expression}) * {scale})"
    return (f"cast(case when {scaled} - floor({scaled}) = 0.5 and floor({scaled}) % 2 = 0"
            f" then floor({scaled}) / {scale} else round({expression}, {places}) end as decimal(18,{places}))")


C3 = "channel_name, region, seniority"
O3 = "channel, region, seniority"
DAY = "strftime(cast({0} as date), '%Y-%m-%d')"
TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S')"

METRICS = {
    "metrics": f"""select {O3},
  cast({_r(_avg('cost_per_applicant_usd'), 2)} as decimal(12,2)) as cost,
  cast(floor(quantile_cont(max_channel_capacity_applicants, 0.5)) as int) as cap,
  cast({_r(_avg('interview_yield_rate'), 4)} as decimal(6,4)) as interview,
  cast({_r(_avg('offer_acceptance_rate'), 4)} as decimal(6,4)) as offer
  from raw_observations where is_active_corridor group by {O3}""",
    "units": """select *, interview * offer as yld, cast(interview * offer as double) as gain,
  cast(cost as double) as dcost from metrics""",
}

# The registry without some corridors and with inactive ones, and telemetry beside what it lists.
RELATIONAL_TABLES = ["sourcing_telemetry", "channel_corridor_registry"]
RELATIONAL_REGISTRY = {"listed": """select corridor_id, channel_name, region, seniority, saturation_capacity, saturation_capacity < 5000 as listed_active
  from channel_corridor_registry where region <> 'APAC' or seniority <> 'Staff Architect'"""}
RELATIONAL = RELATIONAL_REGISTRY | {"placed": f"""select *, cast(floor(projected_hires) as int) as actual_hires
  from sourcing_telemetry left join listed using ({C3})"""}


def _corridors() -> dict[str, str]:
    clamp = "least(greatest({0}, cast({1} as decimal(6,4))), cast({2} as decimal(6,4)))"
    interview = clamp.format("interview_yield_rate", "0.0150", "0.7500")
    offer = clamp.format("offer_acceptance_rate", "0.1000", "0.6500")
    priced = {
        "held": f"""select allocation_id, o.channel, o.region, o.seniority,
  greatest(cost_per_applicant_usd, cast(5.00 as decimal(8,2))) as cost,
  cast(cb*rm*sm as decimal(8,2)) as expected_cost, {interview} as interview,
  {clamp.format('cast(s1*ym as decimal(6,4))', '0.0150', '0.7500')} as expected_interview, {offer} as offer
  from raw_observations o join dim_channel c on c.channel_name=o.channel
  join (select distinct region, rm from dim_region) r on r.region=o.region
  join dim_seniority s on s.seniority=o.seniority""",
        "priced": """select *, cast(round(interview*offer, 5) as decimal(14,5)) as yld from held""",
    }
    cph = _r(_div("cost", "yld"), 2)
    shown = f"""select {O3}, {_f('cost')} as cost_per_applicant_usd,
  cap as max_channel_capacity_applicants, {_f('interview')} as interview_yield_rate, {_f('offer')} as offer_acceptance_rate,
  gain as overall_conversion_yield,
  case when gain <= 0 then cast('inf' as double) else dcost / gain end as cost_per_hire_benchmark_usd from units"""
    return {
        "corridor_metrics": _with(["raw_observations"], METRICS, shown),
        "relational_corridors": _with(RELATIONAL_TABLES, RELATIONAL | {"raw_observations": """select channel_name as channel, region, seniority,
  cost_per_applicant_usd, saturation_capacity as max_channel_capacity_applicants, interview_yield_rate, offer_acceptance_rate,
  ifnull(listed_active, false) as is_active_corridor from placed"""} | METRICS, shown),
        "observed_funnel": _with(["raw_observations", "channel_corridor_registry"], RELATIONAL_REGISTRY, f"""select
  ifnull(corridor_id, concat(channel, '|', o.region, '|', o.seniority)) as corridor_id, channel as sourcing_channel, o.region as talent_region,
  o.seniority as role_seniority, strftime(event_timestamp, '%Y-%m') as calendar_month, count(allocation_id) as total_applications,
  {_f('sum(cost_per_applicant_usd)')} as monthly_expenditure_usd, {_avg('cost_per_applicant_usd')} as mean_cpa_usd,
  cast(0 as bigint) as stage_interviews_passed, cast(0 as bigint) as stage_hires_achieved,
  {_avg('interview_yield_rate * offer_acceptance_rate')} as empirical_conversion_yield
  from raw_observations o left join listed r on channel = channel_name and o.region = r.region and o.seniority = r.seniority
  where is_active_corridor group by all"""),
        "observed_rollup": _with(["raw_observations"], {}, f"""select concat('C', max_channel_capacity_applicants % 11) as campaign_id,
  channel as channel_name, region, seniority, count(*) as observations, cast(sum(max_channel_capacity_applicants % 50) as bigint) as total_applicants,
  {_f('sum(cost_per_applicant_usd * (max_channel_capacity_applicants % 50))')} as total_spend_usd,
  {_f('sum(round((max_channel_capacity_applicants % 50) * overall_conversion_yield, 2))')} as total_hires
  from raw_observations group by all"""),
        "priced_observations": _with(["raw_observations"], priced, f"""select allocation_id, {O3},
  {_f('cost')} as cost_per_applicant_usd, {_f('expected_cost')} as expected_cpa_usd, {_f('interview')} as interview_yield_rate,
  {_f('expected_interview')} as expected_interview_yield, {_f('offer')} as offer_acceptance_rate,
  {_f('yld')} as overall_conversion_yield, {_f(cph)} as cost_per_hire_benchmark_usd from priced"""),
        "dataset_means": _with(["raw_observations"], priced, f"""select count(*) as observations,
  {_d(_avg('cost'), 2)} as mean_cpa_usd, {_d(_avg(cph), 2)} as mean_benchmark_cph_usd from priced"""),
    }


def _windows() -> dict[str, str]:
    span = f"""over (partition by {C3} order by event_timestamp
    range between interval 7 days preceding and current row)"""
    moving = f"""select t.*, cast(sum(cost_per_applicant_usd) {span} as double) / nullif(count(cost_per_applicant_usd) {span}, 0) as m_cpa,
  cast(sum(overall_conversion_yield) {span} as double) / nullif(count(overall_conversion_yield) {span}, 0) as m_yield from sourcing_telemetry t"""
    upto = "over (partition by t.campaign_id order by event_timestamp, telemetry_id rows between unbounded preceding and current row)"
    known = {"known": "select t.* from sourcing_telemetry t join campaign_master c on t.campaign_id = c.campaign_id"}
    exact = "cast({0} as decimal(38,12))"
    daily = f"""select cast(event_timestamp as date) as day, {C3}, count(distinct campaign_id) as campaigns,
  sum(allocated_applicants) as applicants, sum(allocated_spend_usd) as spend, sum(projected_hires) as hires,
  {_r(_avg('cost_per_applicant_usd'), 2)} as mean_cpa, {_r(_avg(exact.format('m_cpa')), 2)} as roll_cpa,
  {_r('quantile_cont(cast(cost_per_applicant_usd as double), 0.95)', 2)} as p95,
  {_r(_avg('overall_conversion_yield'), 5)} as mean_yield, {_r(_avg(exact.format('m_yield')), 5)} as roll_yield
  from moving group by 1, {C3}"""
    cph = _r(_div("spend", "hires"), 2)
    return {
        "rolling_7d": _with(["sourcing_telemetry"], {"moving": moving}, f"""select {C3},
  {TIME.format('event_timestamp')} as event_timestamp, count(*) as observations,
  min(m_cpa) as moving_cpa_usd, min(m_yield) as moving_yield from moving group by {C3}, event_timestamp"""),
        "campaign_cumulative": _with(["sourcing_telemetry", "campaign_master"], {}, f"""select telemetry_id, t.campaign_id, client_name,
  {C3}, {TIME.format('event_timestamp')} as event_timestamp, {_f('allocated_spend_usd')} as allocated_spend_usd,
  {_f('projected_hires')} as projected_hires,
  {_f(f'sum(allocated_spend_usd) {upto}')} as cumulative_campaign_spend_usd,
  {_f(f'sum(projected_hires) {upto}')} as cumulative_projected_hires
  from sourcing_telemetry t join campaign_master c on t.campaign_id = c.campaign_id"""),
        "efficiency_rollup": _with(
            ["sourcing_telemetry", "campaign_master"],
            known | {"moving": moving.replace("sourcing_telemetry t", "known t"), "daily": daily,
                     "priced": f"select *, {cph} as cph from daily"},
            f"""select {DAY.format('day')} as snapshot_date, {C3}, campaigns as active_campaigns_count,
  cast(applicants as bigint) as total_applicants_acquired, {_f('spend')} as total_spend_usd, {_f('hires')} as total_projected_hires,
  {_f('mean_cpa')} as mean_cpa_usd, {_f('roll_cpa')} as rolling_7d_cpa_usd, {_f('p95')} as p95_cpa_usd,
  {_f('mean_yield')} as mean_conversion_yield, {_f('roll_yield')} as rolling_7d_yield,
  {_f('cph')} as effective_cost_per_hire_usd, {_d(_div('hires', 'spend') + ' * 1000', 3)} as hires_yield_per_1k_usd,
  case when cph <= 1200 and mean_yield >= 0.08 then 'HIGH_YIELD_LOW_COST (STAR)'
       when cph <= 1200 then 'MODERATE_YIELD_AFFORDABLE'
       when mean_yield >= 0.08 then 'HIGH_PRECISION_PREMIUM'
       else 'LOW_YIELD_EXPENSIVE_BOTTLENECK' end as corridor_strategic_tier from priced"""),
    }


def _matrices() -> dict[str, str]:
    life = f"""select {C3}, {_r(_avg('cost_per_applicant_usd'), 2)} as cpa, {_r(_avg('overall_conversion_yield'), 5)} as yld,
  sum(allocated_applicants) as volume, sum(allocated_spend_usd) as spend,
  {_r(_div('sum(allocated_spend_usd)', 'sum(projected_hires)'), 2)} as cph
  from sourcing_telemetry group by {C3} having sum(allocated_applicants) >= 100"""
    corridors = """select *, (select count(*) from life better where better.cpa <= life.cpa and better.yld >= life.yld
  and not (better.cpa = life.cpa and better.yld = life.yld)) as worse_than from life"""
    tiers = f"""select worse_than, row_number() over (order by worse_than) as tier,
  list(corridors order by cpa, {C3}) as members from corridors group by worse_than"""
    neighbours = """select worse_than, tier, unnest(list_zip(members, list_prepend(null, members))) as pair from tiers"""
    ranked = f"""select pair[1].channel_name as channel_name, pair[1].region as region, pair[1].seniority as seniority,
  pair[1].cpa as cpa, pair[1].yld as yld, pair[1].volume as volume, pair[1].spend as spend, pair[1].cph as cph,
  pair[2].cpa as p_cpa, pair[2].yld as p_yld, worse_than, tier from neighbours where pair[1] is not null"""
    usage = f"""select {C3}, strftime(event_timestamp, '%Y-%m') as report_month, sum(allocated_applicants) as used,
  {_r('sum(allocated_spend_usd)', 2)} as spend, {_r('sum(projected_hires)', 1)} as hires,
  {_r(_avg('cost_per_applicant_usd'), 2)} as cpa, {_r(_avg('overall_conversion_yield'), 5)} as yld
  from sourcing_telemetry group by all"""
    load = f"""select usage.*, saturation_capacity as cap, {_r(_div('used * 100', 'saturation_capacity'), 2)} as pct,
  {_r(_div('cpa', 'yld'), 2)} as cph from usage join channel_corridor_registry using ({C3})"""
    s3 = "sourcing_channel, talent_region, role_seniority"
    funnel = f"""select corridor_id, {s3}, strftime(event_timestamp, '%Y-%m') as calendar_month,
  count(telemetry_id) as total_applications, sum(cost_per_applicant_usd) as spend, {_avg('cost_per_applicant_usd')} as mean_cpa,
  count(*) filter (where passed_interview) as interviews, count(*) filter (where hired_flag) as hires,
  {_avg('(interview_yield_rate * offer_acceptance_rate)')} as yld
  from corridor_history where is_active_corridor group by all"""
    changes = """select now.*, earlier.spend as p_spend, earlier.hires as p_hires,
  now.spend - earlier.spend as d_spend, now.hires - earlier.hires as d_hires
  from funnel now asof left join funnel earlier
  on now.corridor_id = earlier.corridor_id and now.calendar_month > earlier.calendar_month"""
    steps = f"""select *, cast(if(d_hires > 0, {_div('d_spend', 'd_hires')}, {_div('spend', 'hires')}) as decimal(38,12)) as marginal,
  cast(if(p_spend > 0 and p_hires > 0 and d_spend > 0, {_div('d_hires', 'p_hires')} / {_div('d_spend', 'p_spend')}, 1.0)
    as decimal(38,12)) as elasticity from changes"""
    regimes = f"""select *, {_r(_div('1000', 'marginal'), 3)} as shadow, {_r('(yld * 1000) / nullif(cast(marginal as double), 0)', 4)} as index_,
  case when elasticity >= 1.20 then 'ELASTIC_HIGH_SCALE' when elasticity between 0.80 and 1.19 then 'CONSTANT_RETURNS'
    when elasticity between 0.30 and 0.79 then 'INELASTIC_SATURATING' else 'DECREASING_CAPITAL_TRAP' end as regime from steps"""
    votes = f"""select {s3}, first(regime order by n desc, regime) as regime from (
    select {s3}, regime, count(*) as n from regimes group by {s3}, regime) group by {s3}"""
    summary = f"""select {s3}, count(distinct calendar_month) as periods, {_r(_avg('spend'), 2)} as spend,
  {_r(_avg('hires'), 1)} as hires, {_avg('marginal')} as marginal, {_r(_avg('elasticity'), 4)} as elasticity,
  {_r(_avg('shadow'), 3)} as shadow from regimes group by {s3}"""
    history = {"funnel": funnel, "changes": changes, "steps": steps, "regimes": regimes}
    changes_by_month = f"""select corridor_id, {s3}, calendar_month,
  total_applications, {_f('spend')} as monthly_expenditure_usd, mean_cpa as mean_cpa_usd,
  interviews as stage_interviews_passed, hires as stage_hires_achieved, yld as empirical_conversion_yield,
  {_f('p_spend')} as prev_monthly_expenditure, p_hires as prev_stage_hires, {_f('marginal')} as marginal_cph_usd,
  {_f('elasticity')} as sourcing_budget_elasticity, {_f('index_')} as capital_efficiency_index,
  {_f('shadow')} as shadow_price_hires_per_k_usd, regime as elasticity_regime from regimes"""
    return {
        "pareto_frontier": _with(["sourcing_telemetry"], {"life": life, "corridors": corridors, "tiers": tiers, "neighbours": neighbours, "ranked": ranked}, f"""select {C3},
  {_f('cpa')} as mean_cpa_usd, {_d('yld * 100', 3)} as conversion_yield_pct, {_f('cph')} as empirical_cph_usd,
  cast(worse_than as bigint) as dominated_by_count, cast(tier as int) as pareto_frontier_rank,
  case when worse_than = 0 then 'PARETO_OPTIMAL_FRONTIER' when worse_than <= 2 then 'NEAR_OPTIMAL_SECOND_TIER'
    else 'SUB_OPTIMAL_DOMINATED' end as pareto_efficiency_status,
  case when cpa - p_cpa > 0 then {_d(_div('(yld - p_yld) * 100', 'cpa - p_cpa'), 4)} end as marginal_yield_per_additional_dollar,
  cast(volume as bigint) as historical_applicants_volume, {_f('spend')} as total_historical_spend_usd from ranked"""),
        "saturation_matrix": _with(["sourcing_telemetry", "channel_corridor_registry"], {"usage": usage, "load": load}, f"""select
  report_month, {C3}, cap as saturation_capacity, cast(used as bigint) as total_allocated_applicants,
  {_f('spend')} as total_spend_usd, {_f('hires')} as total_projected_hires, {_f('pct')} as capacity_utilization_pct,
  cast(cap - used as bigint) as remaining_applicant_headroom, {_d('yld * 100', 2)} as marginal_hires_per_100_extra_capacity,
  {_f('cph')} as corridor_cph_benchmark,
  case when pct >= 95 then 'SEVERELY_SATURATED_HARD_BOTTLENECK' when pct >= 80 then 'CONGESTED_NEAR_CAPACITY'
    when pct <= 30 then 'UNDER_UTILIZED_SLACK_CAPACITY' else 'OPTIMALLY_LOADED' end as channel_saturation_status,
  case when pct >= 80 and cph <= 1500 then 'TIER_1_EXPANSION_TARGET (HIGH ROI)' when pct >= 80 then 'TIER_2_EXPANSION_SELECTIVE'
    else 'MAINTAIN_CURRENT_LIMITS' end as capacity_expansion_recommendation from load"""),
        "elasticity_history": _with(["corridor_history"], history, changes_by_month),
        "relational_elasticity": _with(RELATIONAL_TABLES, RELATIONAL | {"corridor_history": """select telemetry_id,
  ifnull(corridor_id, concat(channel_name, '|', region, '|', seniority)) as corridor_id, channel_name as sourcing_channel,
  region as talent_region, seniority as role_seniority, event_timestamp, cost_per_applicant_usd, interview_yield_rate,
  offer_acceptance_rate, actual_hires > 0 or allocated_applicants * interview_yield_rate >= 1 as passed_interview,
  actual_hires > 0 as hired_flag, ifnull(listed_active, false) as is_active_corridor from placed"""} | history, changes_by_month),
        "budget_elasticity": _with(["corridor_history"], history | {"votes": votes, "summary": summary}, f"""select {s3},
  periods as observation_periods, {_f('spend')} as avg_monthly_expenditure_usd, {_f('hires')} as avg_monthly_hires,
  {_d('marginal', 2)} as blended_marginal_cph_usd, {_f('elasticity')} as avg_budget_elasticity,
  {_f('shadow')} as avg_shadow_price_k_usd, regime as dominant_elasticity_regime,
  case when regime = 'ELASTIC_HIGH_SCALE' and marginal < 250 then 'PRIORITY_AGGRESSIVE_EXPANSION'
    when regime = 'CONSTANT_RETURNS' and marginal < 400 then 'SUSTAIN_OPTIMAL_LP_QUOTA'
    when regime in ('INELASTIC_SATURATING', 'DECREASING_CAPITAL_TRAP') or marginal >= 400 then 'THROTTLE_ALLOCATION_TO_CAPACITY_BOUND'
    else 'RE-BENCHMARK_INTERVIEW_PASS_RATE' end as strategic_capital_action from summary join votes using ({s3})"""),
    }


def _paths() -> dict[str, str]:
    walks = """select corridor_id, len(stops) as depth,
  unnest(list_zip(range(1, len(stops) + 1), stops, stops[2:])) as stop from (
    select corridor_id, list(j order by event_timestamp, telemetry_id) as stops
    from candidate_journeys j where is_active_corridor group by corridor_id)"""
    placed = """select stop[1] as place, depth, stop[2] as touch, corridor_id,
  if(corridor_id is not null and stop[3] is not null, stop[3].sourcing_channel,
    if(stop[2].hired_flag, 'CONVERSION_HIRED', 'DROP_OFF')) as dest, stop[2].sourcing_channel as sourcing_channel,
  stop[2].hired_flag as hired_flag from walks"""
    channels = f"""select sourcing_channel, count(*) as outbound, count(*) filter (where dest = 'CONVERSION_HIRED') as direct,
  {_r(_div("count(*) filter (where dest = 'CONVERSION_HIRED')", 'count(*)'), 4)} as rate,
  count(*) filter (where hired_flag and place = 1) as first_hires,
  count(*) filter (where hired_flag and place = depth) as last_hires,
  round(coalesce(sum(cast(1.0::double / depth as decimal(28,18))) filter (where hired_flag), 0), 2) as linear,
  sum(touch.cost_per_applicant_usd) as spend from placed group by sourcing_channel"""
    whole = """select sum(rate) as rates, sum(linear) as linears from channels"""
    base = {"walks": walks, "placed": placed}
    return {
        "touch_paths": _with(["candidate_journeys"], base, f"""select touch.telemetry_id as telemetry_id, corridor_id, sourcing_channel,
  {TIME.format('touch.event_timestamp')} as event_timestamp, {_f('touch.cost_per_applicant_usd')} as cost_per_applicant_usd,
  touch.passed_interview as passed_interview, hired_flag, touch.is_active_corridor as is_active_corridor,
  cast(place as int) as touchpoint_sequence_number, depth as total_touchpoint_depth, dest as destination_channel from placed"""),
        "markov_transitions": _with(["candidate_journeys"], base | {"channels": channels}, f"""select sourcing_channel as origin_channel,
  dest as destination_channel, count(*) as transition_count, {_d(_div('count(*)', 'any_value(outbound)'), 4)} as transition_probability
  from placed join channels using (sourcing_channel) group by sourcing_channel, dest"""),
        "mta_attribution": _with(["candidate_journeys"], base | {"channels": channels, "whole": whole}, f"""select
  sourcing_channel, {_f('spend')} as channel_total_spend_usd, first_hires as first_touch_hires, last_hires as last_touch_hires,
  {_f('linear')} as linear_attributed_hires, direct as direct_conversions, outbound as total_outbound_transitions,
  {_f('rate')} as direct_absorption_rate, {_d(_div('rate * 100', 'rates'), 2)} as markov_attribution_weight_pct,
  {_d(f"cast(spend as double) / nullif(cast(linears as double) * {_div('rate', 'rates')}, 0)", 2)} as markov_effective_cph_usd,
  case when first_hires > last_hires * 1.5 then 'TOP_FUNNEL_DISCOVERY' when last_hires > first_hires * 1.5 then 'BOTTOM_FUNNEL_CLOSER'
    when rate >= 0.15 then 'CORE_CONVERSION_PILLAR' else 'MID_FUNNEL_NURTURE' end as channel_funnel_archetype
  from channels cross join whole"""),
    }


def _cohorts() -> dict[str, str]:
    members = """select t.*, client_name, strftime(created_at, '%Y-%m') as cohort,
  ntile(4) over (partition by seniority order by cost_per_applicant_usd nulls last, telemetry_id) as quartile
  from sourcing_telemetry t join campaign_master c on t.campaign_id = c.campaign_id"""
    batches = """select log[1].cost_per_applicant_usd as base_cpa, len(log) as n,
  unnest(list_zip(range(1, len(log) + 1), log, list_prepend(null, log), log[2:])) as b from (
    select list(m order by event_timestamp, telemetry_id) as log from members m group by campaign_id)"""
    means = f"""select {C3}, {_avg('cost_per_applicant_usd')} as bench from members group by {C3}"""
    placed = f"""select unnest(b[2]), b[1] as seq, base_cpa, b[3].cost_per_applicant_usd as p_cpa,
  case when b[1] < n then b[4].overall_conversion_yield end as n_yield from batches where b[1] is not null"""
    scored = f"""select *, {_r('cost_per_applicant_usd - base_cpa', 2)} as drift,
  case when p_cpa is null or p_cpa = 0 then 0.0 else {_r(_div('(cost_per_applicant_usd - p_cpa) * 100', 'p_cpa'), 2)} end as velocity,
  case when quartile = 1 and overall_conversion_yield >= 0.08 then 'OPTIMAL_HIGH_PERFORMER'
    when quartile = 4 and overall_conversion_yield <= 0.03 then 'CHRONIC_COST_INEFFICIENCY'
    when quartile in (2, 3) then 'NOMINAL_OPERATIONAL_BAND' else 'STABLE_AVERAGE' end as tier
  from placed join means using ({C3})"""
    ctes = {"members": members, "batches": batches, "means": means, "placed": placed, "scored": scored}
    cost = "cast(cost_per_applicant_usd as double)"
    return {
        "cohort_enriched": _with(["sourcing_telemetry", "campaign_master"], ctes, f"""select telemetry_id, campaign_id, {C3},
  {_f('cost_per_applicant_usd')} as cost_per_applicant_usd, allocated_applicants, {_f('allocated_spend_usd')} as allocated_spend_usd,
  {_f('overall_conversion_yield')} as overall_conversion_yield, {_f('projected_hires')} as projected_hires,
  {TIME.format('event_timestamp')} as event_timestamp, client_name, cohort as onboarding_cohort,
  cast(quartile as int) as cpa_efficiency_quartile, {_f('p_cpa')} as prev_batch_cpa_usd,
  {_f('n_yield')} as next_batch_conversion_yield, {_f('base_cpa')} as baseline_campaign_cpa_usd,
  cast(seq as int) as allocation_batch_sequence, {_f('drift')} as cpa_drift_from_baseline_usd,
  {_f('velocity')} as cpa_velocity_pct_change, tier as longitudinal_performance_tier,
  bench as corridor_benchmark_avg_cpa_usd from scored"""),
        "cohort_matrix": _with(["sourcing_telemetry", "campaign_master"], ctes, f"""select cohort as onboarding_cohort, {C3},
  tier as longitudinal_performance_tier, count(distinct campaign_id) as total_active_campaigns,
  cast(sum(allocated_applicants) as bigint) as total_applicants_routed, {_d('sum(allocated_spend_usd)', 2)} as total_spend_usd,
  {_d('sum(projected_hires)', 1)} as total_projected_hires, {_d(_avg('cost_per_applicant_usd'), 2)} as avg_cpa_usd,
  {_d(_avg('drift'), 2)} as avg_drift_from_inception_usd, {_d(_avg('velocity'), 2)} as avg_cpa_velocity_pct,
  {_d(_div('sum(overall_conversion_yield) * 100', 'count(overall_conversion_yield)'), 3)} as avg_conversion_yield_pct,
  {_d(f'quantile_cont({cost}, 0.5)', 2)} as median_cpa_usd, {_d(f'quantile_cont({cost}, 0.95)', 2)} as p95_cpa_usd,
  {_d(_div('sum(allocated_spend_usd)', 'sum(projected_hires)'), 2)} as effective_cost_per_hire_usd
  from scored group by cohort, {C3}, tier having count(*) >= 2"""),
    }


def _linear_optimum(asked: str, eps: str = "1e-9") -> dict[str, str]:
    """Common table expressions up to ``amounts`` of the constrained optimum, by enumeration.

    With a price l of the budget and a price m of the quota, the dual is convex and linear between the
    lines on which a corridor pays exactly nothing or two corridors of a region tie. Its minimum lies on
    a crossing of two such lines or axes, and these are the same for all campaigns: every campaign takes
    the crossing of the least bound. The plans that are best just beside that crossing are its corners;
    mixed so that budget and quota are met, they are the optimum. ``asked`` gives each campaign's
    budget b, quota q and floor f.
    """
    seniors = ", ".join(map(repr, schemas.SENIOR_LEVELS))
    fill = "case when p > 0 then k else least(k, greatest(0.0, f - before)) end"
    return {
        "u": f"""select row_number() over (order by {O3}) as i, {O3}, dcost as c, gain as g,
  case when seniority in ({seniors}) then gain else 0.0 end as s, cast(cap as double) as k from units""",
        "asked": asked,
        "levels": "select distinct f from asked",
        # What the floors cost, and whether the regions can hold them.
        "cheapest": """select f, sum(x * c) as spend, bool_and(room) as room from (
    select f, c, least(k, greatest(0.0, f - sum(k) over (partition by f, region order by c, i) + k)) as x,
      sum(k) over (partition by f, region) >= f as room from u cross join levels) group by f""",
        # The most senior hires: the same dual with one price, of the budget.
        "stops": """select row_number() over () as id, l from (select distinct l from (
    select s / c as l from u union all select 0.0
    union all select (x.s - y.s) / (x.c - y.c) from u x join u y on x.region = y.region and x.i < y.i and x.c <> y.c) where l >= 0)""",
        "senior_fill": """select id, f, k, p, sum(k) over (partition by id, f, region order by p desc, i) - k as before
    from (select id, l, f, region, i, k, s - l * c as p from stops cross join levels cross join u)""",
        "senior_worth": f"select id, f, sum(p * {fill}) as v from senior_fill group by id, f",
        "reach": """select campaign_id, min(l * b + v) as most from asked join senior_worth using (f) join stops using (id) group by campaign_id""",
        "judged": """select asked.*, case when b is null then 'SOLVER_INFEASIBLE: no budget given'
    when not room then 'SOLVER_INFEASIBLE: region capacity below its floor'
    when cheapest.spend > b then 'SOLVER_INFEASIBLE: region floors exceed the budget'
    when most < q * (1 - 1e-9) then 'SOLVER_INFEASIBLE: senior quota out of reach'
    else 'OPTIMAL_CONVERGENCE' end as solver_status
    from asked join cheapest using (f) left join reach using (campaign_id)""",
        # Lines a l + b m = c, and where two of them cross.
        "breaks": """select row_number() over () as id, * from (
    select c as a, -s as b, g as c from u
    union all select x.c - y.c, y.s - x.s, x.g - y.g from u x join u y on x.region = y.region and x.i < y.i
    union all values (1.0, 0.0, 0.0), (0.0, 1.0, 0.0))""",
        "crossings": """select row_number() over () as id, l, m from (select distinct l + 0.0 as l, m + 0.0 as m from (
    select (x.c * y.b - y.c * x.b) / (x.a * y.b - y.a * x.b) as l, (x.a * y.c - y.a * x.c) / (x.a * y.b - y.a * x.b) as m
    from breaks x join breaks y on x.id < y.id and x.a * y.b - y.a * x.b <> 0) where l >= 0 and m between 0 and 1e6)""",
        "fills": """select id, f, k, p, sum(k) over (partition by id, f, region order by p desc, i) - k as before
    from (select id, f, region, i, k, g + m * s - l * c as p from crossings cross join levels cross join u)""",
        "worth": f"select id, f, sum(p * {fill}) as v from fills group by id, f",
        "priced": """select campaign_id, min(d) as bound, arg_min(l, d) as l, arg_min(m, d) as m from (
    select campaign_id, l, m, l * b - m * q + v as d from judged join worth using (f) join crossings using (id)
    where solver_status = 'OPTIMAL_CONVERGENCE' and (q > 0 or m = 0)) group by campaign_id""",
        # Steps beside the crossing: none without a price, two along one price, all around for two.
        "steps": f"""select campaign_id, f, b, q, l, m, step, l * {eps} * cos((step + 0.37) * pi() / 24) as dl,
    case when m > 0 then (1 + m) * {eps} * sin((step + 0.37) * pi() / 24) else 0.0 end as dm
    from priced join judged using (campaign_id) cross join range(48) t(step)
    where m > 0 or step = 0 or (l > 0 and step = 24)""",
        "beside": """select *, sum(k) over (partition by campaign_id, step, region order by p desc, i) - k as before from (
    select campaign_id, f, step, u.*, g + (m + dm) * s - (l + dl) * c as p from steps cross join u)""",
        "corners": f"select campaign_id, step, i, c, s, {fill} as x from beside",
        "points": """select campaign_id, min(step) as step, spend, senior from (
    select campaign_id, step, round(sum(x * c), 6) as spend, round(sum(x * s), 9) as senior from corners group by all)
    group by campaign_id, spend, senior""",
        # Shares of corners: one, two for the budget, or three for budget and quota.
        "triples": """select x.campaign_id, [x.step, y.step, z.step] as steps,
    [((y.spend - b) * (z.senior - q) - (z.spend - b) * (y.senior - q)) / area,
     ((z.spend - b) * (x.senior - q) - (x.spend - b) * (z.senior - q)) / area,
     ((x.spend - b) * (y.senior - q) - (y.spend - b) * (x.senior - q)) / area] as shares
    from points x join points y on x.campaign_id = y.campaign_id and x.step < y.step
    join points z on x.campaign_id = z.campaign_id and y.step < z.step join priced on priced.campaign_id = x.campaign_id
    join judged on judged.campaign_id = x.campaign_id
    cross join lateral (select (y.spend - x.spend) * (z.senior - x.senior) - (z.spend - x.spend) * (y.senior - x.senior) as area)
    where m > 0 and area <> 0""",
        "shares": """select campaign_id, unnest(steps) as step, unnest(shares) as share from (
    select campaign_id, arg_max(steps, list_min(shares)) as steps, arg_max(shares, list_min(shares)) as shares from triples group by campaign_id)
    union all select x.campaign_id, x.step, case when y.step is null or y.spend = x.spend then if(y.step is null or x.step = 0, 1.0, 0.0)
      else (b - y.spend) / (x.spend - y.spend) end
    from points x join priced on priced.campaign_id = x.campaign_id and m = 0 join judged on judged.campaign_id = x.campaign_id
    left join points y on y.campaign_id = x.campaign_id and y.step <> x.step""",
        "exact": "select campaign_id, i, sum(share * x) as x from corners join shares using (campaign_id, step) group by campaign_id, i",
        "placed": """select judged.campaign_id, solver_status, b, q, u.*, coalesce(x, 0.0) as x
    from judged cross join u left join exact on exact.campaign_id = judged.campaign_id and exact.i = u.i""",
    }


def _allocations() -> dict[str, str]:
    ctes = METRICS | {
        "program": """select c.campaign_id, c.client_name, c.total_budget_usd as budget, c.target_hires, c.max_cph_target_usd, u.*,
  count(*) over (partition by campaign_id) as parts from campaign_master c cross join units u""",
        "naive_sums": """select campaign_id,
  sum(least(cast(budget as double) / parts, cap * dcost)) as spend,
  sum(least(cast(budget as double) / parts, cap * dcost) / dcost * gain) as hires from program group by 1""",
        "naive": f"""select campaign_id, {_r('hires', 2)} as naive_hires, {_r('spend', 2)} as naive_spend,
  case when hires > 0 then {_r('spend / hires', 2)} else 0 end as naive_cph from naive_sums""",
        "filled": f"""select *, coalesce(sum(cost * cap) over (partition by campaign_id order by gain / dcost desc, {O3}
    rows between unbounded preceding and 1 preceding), 0) as before from program""",
        "amounts": """select *, 'OPTIMAL_CONVERGENCE' as solver_status, cast(round_even(least(cast(cap as double),
    greatest(0.0, cast(budget - before as double) / dcost)), 0) as int) as n from filled""",
        "all_lines": f"""select *, cast(n * cost as decimal(18,2)) as line_spend, {_even('n * yld', 2)} as line_hires from amounts""",
        "lines": "select * from all_lines where n > 0",
        "results": """select campaign_id, client_name, max(budget) as budget, sum(line_spend) as spend, sum(line_hires) as hires,
  coalesce(sum(line_hires) filter (where seniority in (SENIORS)), 0) as senior,
  sum(n) as applicants, max(target_hires) as target_hires, max(max_cph_target_usd) as cph_target, max(solver_status) as solver_status
  from all_lines group by campaign_id, client_name""".replace("SENIORS", ", ".join(map(repr, schemas.SENIOR_LEVELS))),
        "result": f"""select *, case when hires > 0 then {_r(_div('spend', 'hires'), 2)} else 0 end as cph,
  least({_r(_div('spend * 100', 'budget'), 2)}, 100) as used,
  case when naive_hires > 0 then {_r(_div('(hires - naive_hires) * 100', 'naive_hires'), 2)} else 0 end as gain_pct
  from results join naive using (campaign_id)""",
    }
    over = ["raw_observations", "campaign_master"]
    line_cph = f"case when line_hires > 0 then {_d(_div('line_spend', 'line_hires'), 2)} else 0 end"
    naive_cost = _div("spend", "greatest(naive_hires, 1)")
    saved, saved_pct = "(naive_cph - cph)", _div("(naive_cph - cph) * 100", "naive_cph")

    def text(expression: str, places: int) -> str:
        return f"cast(cast({_r(expression, places)} as decimal(28,{places})) as varchar)"

    lines = f"""select campaign_id, solver_status, {O3},
  dcost as unit_cost_usd, gain as unit_yield, cap as unit_capacity, n as allocated_applicants,
  {_f('line_spend')} as allocated_budget_usd, {_f('line_hires')} as expected_hires, {line_cph} as effective_cost_per_hire_usd from lines"""
    results = f"""select campaign_id, client_name, solver_status,
  {_f('budget')} as total_budget_usd, {_f('spend')} as total_budget_allocated_usd, {_f('hires')} as total_projected_hires,
  cast(applicants as bigint) as total_allocated_applicants, {_f('senior')} as senior_hires, {_f('used')} as budget_utilization_pct,
  {_f('cph')} as blended_cost_per_hire_usd, {_f('naive_hires')} as naive_heuristic_hires, {_f('naive_spend')} as naive_spend_usd,
  {_f('naive_cph')} as naive_cost_per_hire_usd, {_f('gain_pct')} as efficiency_gain_pct,
  {_f('greatest(spend - budget, 0)')} as overspend_usd, hires >= target_hires as meets_min_hires,
  hires > 0 and {_div('spend', 'hires')} <= cast(cph_target as double) as meets_cph_target from result"""
    verdict = f"""select campaign_id, client_name, {_f('budget')} as total_budget_usd,
  {_f('naive_hires')} as naive_heuristic_hires, {_f('naive_cph')} as naive_cost_per_hire_usd, {_f('hires')} as optimal_linear_hires,
  {_f('cph')} as optimal_cost_per_hire_usd, {_d('hires - naive_hires', 2)} as hires_volume_gain, {_f('gain_pct')} as efficiency_gain_pct,
  {_d(saved, 2)} as cost_per_hire_reduction_usd,
  {_d(f'case when naive_cph > 0 then {saved_pct} else 0 end', 2)} as cost_per_hire_savings_pct,
  concat('Optimal allocation changes hires by ', {text('gain_pct', 1)}, '% and lowers cost per hire by ',
    {text(f'case when naive_cph > 0 then {saved_pct} else 0 end', 1)}, '% ($', {text(saved, 2)}, ' per hire) under the same budget.')
    as conclusion from result"""
    params = "select campaign_id, {0} as b, cast({1} as double) as q, {2} as f from campaign_master"
    floor = "case when regional_diversity_min_pct > 0 then 50.0 else 0.0 end"
    linear = METRICS | _linear_optimum(params.format("cast(total_budget_usd as double)", "min_senior_hires", floor))
    chosen = """select program.*, solver_status, cast(round_even(x, 0) as int) as n
  from program join placed using (campaign_id, channel, region, seniority)"""
    optimal = linear | {k: chosen if k == "amounts" else v for k, v in ctes.items() if k != "filled"}
    certificate = """select campaign_id, solver_status, round(hires, 6) + 0.0 as hires, round(bound, 6) + 0.0 as dual_bound,
  round(l, 9) + 0.0 as budget_price, round(m, 9) + 0.0 as quota_price, round((bound - hires) / greatest(1.0, abs(bound)), 9) + 0.0 as relative_gap,
  round(greatest(spend - b, 0.0), 6) as budget_excess, round(greatest(q - senior, 0.0), 6) as quota_shortfall, round(smallest, 6) as smallest_region_applicants
  from (select campaign_id, solver_status, b, q, sum(x * g) as hires, sum(x * c) as spend, sum(x * s) as senior from placed group by all)
  join (select campaign_id, min(x) as smallest from (select campaign_id, region, sum(x) as x from placed group by all) group by 1) using (campaign_id)
  left join priced using (campaign_id)"""
    # The campaigns as they are, without budget, with a hundredth of it, and with more seniors or applicants asked for.
    strained = METRICS | _linear_optimum(params.format(
        "case campaign_id % 7 when 1 then null when 2 then cast(total_budget_usd as double) / 100 else cast(total_budget_usd as double) end",
        "case campaign_id % 7 when 3 then 100000 when 5 then 150 when 6 then 220 else min_senior_hires end",
        "case campaign_id % 7 when 2 then 50.0 when 4 then 1000000.0 else " + floor + " end"))
    outcome = """select campaign_id, solver_status, count(*) filter (where x > 0) as funded_corridors, round(sum(x), 4) + 0.0 as applicants,
  round(sum(x * c), 4) + 0.0 as spend_usd, round(sum(x * g), 6) + 0.0 as hires, round(sum(x * s), 6) + 0.0 as senior_hires
  from placed group by campaign_id, solver_status"""

    shares = """select campaign_id, dimension, member, sum(line_spend) as spend, sum(line_hires) as hires from (
  select campaign_id, 'channel' as dimension, channel as member, line_spend, line_hires from lines union all
  select campaign_id, 'region', region, line_spend, line_hires from lines union all
  select campaign_id, 'seniority', seniority, line_spend, line_hires from lines) group by all"""
    whole = "over (partition by campaign_id, dimension)"
    table = f"""select campaign_id, unnest([
  {{'line': 1, 'metric': 'Total Campaign Sourcing Budget ($)', 'q': {_d('spend', 6)}, 'o': {_d('spend', 6)}}},
  {{'line': 2, 'metric': 'Aggregate Qualified Hires Delivered', 'q': {_d('naive_hires', 6)}, 'o': {_d('hires', 6)}}},
  {{'line': 3, 'metric': 'Blended Cost per Hire (CPH, $)', 'q': {_d(naive_cost, 6)}, 'o': {_d('cph', 6)}}},
  {{'line': 4, 'metric': 'Budget Utilization Rate (%)', 'q': 1.0::double, 'o': {_d(_div('used', '100'), 6)}}},
  {{'line': 5, 'metric': 'Recruitment Agency Fee Avoidance ($)', 'q': 0.0::double, 'o': {_d('(hires - naive_hires) * 5000', 6)}}}]) as v
  from result"""
    exact6 = "cast({0} as decimal(28,6))"
    recent = METRICS["metrics"].replace("where is_active_corridor", "where is_active_corridor and event_timestamp >= timestamp '2001-07-01'")
    reviewed = f"""select {O3}, campaign_id, n, ifnull(cap_now, 1000) as cap_now,
  {_d(f"ifnull(cast(cost_now as double), {_div('line_spend', 'greatest(n, 1)')})", 2)} as unit_cpa_usd,
  {_d(f"ifnull(cast(yld_now as double), {_div('line_hires', 'greatest(n, 1)')})", 8)} as conversion_yield
  from all_lines left join (select {O3}, cost as cost_now, cap as cap_now, interview * offer as yld_now from recent) using ({O3})"""
    return {
        "allocation_review": _with(over, ctes | {"recent": recent, "reviewed": reviewed}, f"""select {O3}, unit_cpa_usd, conversion_yield,
  cap_now as monthly_capacity, case when n = 0 then 'ZERO_ALLOCATED' when n >= cap_now * 0.99 then 'CAPACITY_SATURATED'
    else 'OPTIMAL_ACTIVE' end as allocation_status, count(*) as campaigns, cast(sum(n) as bigint) as total_applicants from reviewed group by all"""),
        "naive_allocation": _with(over, {k: ctes[k] for k in ("metrics", "units", "program", "naive_sums", "naive")}, f"""select campaign_id,
  {_f('naive_hires')} as naive_heuristic_hires, {_f('naive_spend')} as naive_spend_usd, {_f('naive_cph')} as naive_cost_per_hire_usd from naive"""),
        "greedy_allocation": _with(over, ctes, lines), "greedy_results": _with(over, ctes, results), "greedy_tradeoff": _with(over, ctes, verdict),
        "constrained_allocation": _with(over, optimal, lines), "constrained_results": _with(over, optimal, results),
        "constrained_tradeoff": _with(over, optimal, verdict),
        "allocation_certificate": _with(over, linear, certificate), "strained_allocation": _with(over, strained, outcome),
        "allocation_rollup": _with(over, ctes | {"shares": shares}, f"""select campaign_id, dimension, member, {_f('spend')} as budget_usd,
  {_d(_div('spend', f'greatest(sum(spend) {whole}, 1)'), 6)} as budget_share, {_f('hires')} as hires,
  {_d(_div('hires', f'greatest(sum(hires) {whole}, 1)'), 6)} as hires_share,
  {_d(_div('spend', 'greatest(hires, 0.001)'), 2)} as effective_cph_usd from shares"""),
        "allocation_measures": _with(over, ctes, f"""select campaign_id, cast(applicants as bigint) as total_applicants,
  {_f('spend')} as allocated_budget_usd, {_f('hires')} as total_expected_hires, {_d(_div('spend', 'hires'), 2)} as blended_cph_usd,
  {_f('gain_pct')} as efficiency_gain_pct, coalesce({_d(_div('senior', 'hires'), 6)}, 0) as senior_staff_ratio
  from result"""),
        "allocation_totals": _with(over, ctes, f"""select count(distinct campaign_id) as campaigns, cast(sum(n) as bigint) as total_applicants,
  {_f('sum(line_spend)')} as total_budget_usd, {_f('sum(line_hires)')} as total_hires,
  {_d(_div('sum(line_spend)', 'sum(line_hires)'), 2)} as blended_cph_usd from lines"""),
        "allocation_schedule": _with(over, ctes, f"""select campaign_id, {O3}, dcost as unit_cpa_usd, {_d('yld', 8)} as conversion_yield,
  cap as monthly_capacity, n as allocated_applicants, {_f('line_spend')} as allocated_budget_usd, {_f('line_hires')} as expected_hires,
  {line_cph} as effective_cost_per_hire_usd, case when n > 0 and n >= cap * 0.99 then 'CAPACITY_SATURATED'
    when n > 0 then 'OPTIMAL_ACTIVE' else 'ZERO_ALLOCATED' end as allocation_status from all_lines"""),
        "executive_variance": _with(over, ctes | {"flat": table}, f"""select campaign_id, v.line as line, v.metric as metric, v.q as status_quo,
  v.o as optimal, {_f(exact6.format('v.o') + ' - ' + exact6.format('v.q'))} as absolute_variance,
  case when v.q = 0 then 0 else {_d(_div(exact6.format('v.o') + ' - ' + exact6.format('v.q'), 'v.q'), 6)} end as efficiency_delta from flat"""),
        "kpi_cards": _with(over, ctes, f"""select campaign_id, {_f('spend')} as sourcing_budget_usd, {_f('naive_hires')} as status_quo_hires,
  {_d(naive_cost, 2)} as status_quo_cph_usd, {_f('hires')} as optimal_hires, {_f('cph')} as optimal_cph_usd,
  {_f('hires - naive_hires')} as hires_gain, {_f('gain_pct')} as efficiency_gain_pct,
  {_d(f'{naive_cost} - cast(cph as double)', 2)} as cph_reduction_usd,
  {_d(f'({naive_cost} - cast(cph as double)) * 100 / {naive_cost}', 2)} as cph_reduction_pct from result"""),
    }


def _streams() -> dict[str, str]:
    measured = f"""select t.*, coalesce(r.baseline_cpa_usd, 40.00) as baseline, client_name,
  {_r(_div('t.cost_per_applicant_usd', 'coalesce(r.baseline_cpa_usd, 40.00)'), 2)} as surge
  from sourcing_telemetry t left join channel_corridor_registry r
  on t.channel_name=r.channel_name and t.region=r.region and t.seniority=r.seniority
  left join campaign_master c on t.campaign_id = c.campaign_id"""
    tier = """case when surge >= 2 or overall_conversion_yield <= 0.002 then 'P1_CRITICAL_BUDGET_DRAIN'
  else 'P2_ELEVATED_DRIFT_WARNING' end as escalation_tier"""
    action = """case when surge >= 2 then 'Immediate Channel Throttling & Reallocate to Talent Network'
  else 'Adjust Linear Optimization Channel Upper Bound' end as recommended_action"""
    common = f"""campaign_id, {C3}, {_f('cost_per_applicant_usd')} as observed_cpa_usd, {_f('baseline')} as baseline_cpa_usd,
  {_f('overall_conversion_yield')} as observed_yield, {tier}, coalesce(client_name, 'Enterprise Client') as client_name,
  concat(region, ' - ', seniority) as corridor, {_f('surge')} as surge_multiplier, {action}"""
    payload = f"""'Sourcing Corridors Anomaly Triggered' as event, channel_name as channel, {_f('cost_per_applicant_usd')} as cpa_observed,
  {_f('baseline')} as cpa_baseline, {_f('overall_conversion_yield')} as conversion_yield"""
    breach = "from measured where surge >= 1.45 or overall_conversion_yield <= 0.005"
    over = ["sourcing_telemetry", "channel_corridor_registry", "campaign_master"]
    periods = f"""select time_bucket(interval 5 minutes, ts) as period, {_avg('cast(value as decimal(18,4))')} as mean_cost
  from events group by 1"""
    paired = """select *, lag(period) over (order by period) as before, lag(mean_cost) over (order by period) as mean_before from periods"""
    alarms = f"""select {TIME.format('period')} as period_start, {TIME.format('period + interval 5 minutes')} as alarm_at,
  round(mean_before, 6) as previous_mean, round(mean_cost, 6) as current_mean
  from paired where mean_cost > 120 and mean_before > 120 and before = period - interval 5 minutes"""
    surge = _with([], {"periods": periods, "paired": paired}, alarms)
    return {
        "anomaly_detect": _with(over, {"measured": measured}, f"select {common}, {payload} {breach}"),
        "anomaly_stream": _with(over, {"measured": measured}, f"""select {common}, {payload},
  campaign_id as payload_campaign_id, true as evaluated_before_now {breach}"""),
        "cost_surge_alarm": surge,
        "cost_surge_alarm_stream": surge,
    }


# The constraints as the tables declare them: what a valid row meets.
IN_DOMAIN = {
    "channel": "('Programmatic Job Boards', 'Direct AI Sourcing', 'Sponsored Campaigns', 'Talent Network Pool', 'Executive Headhunting')",
    "region": "('LATAM', 'EMEA', 'North America', 'APAC')",
    "seniority": "('Junior Specialist', 'Mid-Level Engineer', 'Senior Lead', 'Staff Architect')",
}


def _checks() -> dict[str, dict[str, str]]:
    def domains(channel: str) -> dict[str, str]:
        return {"channel_in_domain": f"{channel} in {IN_DOMAIN['channel']}", "region_in_domain": f"region in {IN_DOMAIN['region']}",
                "seniority_in_domain": f"seniority in {IN_DOMAIN['seniority']}"}

    telemetry = {
        "campaign_present": "campaign_id is not null", "event_time_present": "event_timestamp is not null",
        "cost_positive": "cost_per_applicant_usd > 0", "applicants_not_negative": "allocated_applicants >= 0",
        "spend_not_negative": "allocated_spend_usd >= 0", "interview_rate_not_negative": "interview_yield_rate >= 0",
        "offer_rate_not_negative": "offer_acceptance_rate >= 0", "yield_not_negative": "overall_conversion_yield >= 0",
        "hires_not_negative": "projected_hires >= 0", **domains("channel_name")}
    return {
        "sourcing_telemetry": telemetry,
        "strained_telemetry": telemetry,
        "campaign_master": {
            "campaign_id_present": "campaign_id is not null and length(campaign_id::varchar) <= 64",
            "client_name_length": "length(client_name) >= 2 and length(client_name) <= 128", "budget_positive": "total_budget_usd > 0",
            "target_hires_positive": "target_hires > 0", "senior_quota_not_negative": "min_senior_hires >= 0",
            "cph_target_positive": "max_cph_target_usd > 0",
            "diversity_share_in_range": "regional_diversity_min_pct >= 0 and regional_diversity_min_pct <= 0.5"},
        "channel_corridor_registry": {
            "corridor_id_length": "corridor_id <> '' and length(corridor_id) <= 64", "baseline_positive": "baseline_cpa_usd > 0",
            "capacity_positive": "saturation_capacity > 0", "interview_yield_positive": "expected_interview_yield > 0",
            "offer_acceptance_positive": "expected_offer_acceptance > 0", **domains("channel_name")},
        "corridor_units": {
            "cost_positive": "cost > 0", "capacity_positive": "cap > 0", "interview_rate_in_unit_interval": "interview > 0 and not interview > 1",
            "offer_rate_in_unit_interval": "offer > 0 and not offer > 1", **domains("channel")},
    }


def _quality() -> dict[str, str]:
    strained = {"strained_telemetry": """select * replace (
    case allocated_applicants % 10 when 1 then 0 when 2 then -cost_per_applicant_usd when 3 then null else cost_per_applicant_usd end as cost_per_applicant_usd,
    case when allocated_applicants % 10 = 4 then 'Carrier Pigeon' else channel_name end as channel_name,
    case allocated_applicants % 10 when 5 then null when 6 then -campaign_id else campaign_id end as campaign_id,
    case when allocated_applicants % 10 = 7 then -1 - projected_hires else projected_hires end as projected_hires) from sourcing_telemetry"""}
    units = METRICS | {"corridor_units": "select * from units"}
    counts = " union all ".join(
        f"select '{table}' as table_name, '{name}' as rule_name, count(*) as rows_read, count(*) - count(*) filter (where {rule}) as rows_failed from {table}"
        for table, rules in _checks().items() for name, rule in rules.items())
    measures = ["cost_per_applicant_usd", "max_channel_capacity_applicants", "interview_yield_rate",
                "offer_acceptance_rate", "overall_conversion_yield"]
    columns = ["allocation_id", "channel", "region", "seniority", *measures, "is_active_corridor", "event_timestamp"]
    nulls = " + ".join(f"cast({c} is null as int)" for c in columns)
    copies = "group by 1, 2 having count(*) > 1"
    moment = "strftime(event_timestamp, '%Y-%m-%d %H:%M:%S')"
    return {
        "dq_rules": _with(["sourcing_telemetry", "campaign_master", "channel_corridor_registry", "raw_observations"], units | strained, counts),
        "dq_quarantine": _with(["sourcing_telemetry"], {"checked": """select telemetry_id, concat_ws(',',
    case when cost_per_applicant_usd <= 100 then null else 'cost_at_most_100' end,
    case when overall_conversion_yield > 0.005 then null else 'yield_above_collapse' end,
    case when projected_hires > 0 then null else 'some_hire_expected' end) as failed_rules from sourcing_telemetry"""},
                               "select telemetry_id, failed_rules from checked where failed_rules <> ''"),
        "dq_duplicates": "select l_orderkey, l_linenumber, count(*) as copies from lineitem group by 1, 2 having count(*) > 1",
        "dq_missing_references": """select c_custkey as campaign_id, c_name from customer
  where c_custkey not in (select o_custkey from orders where o_custkey is not null)""",
        # Each repeated row is one that the rule of the strained tables takes a second time.
        "dq_declared_keys": _with(["sourcing_telemetry", "campaign_master", "channel_corridor_registry"], strained, f"""
  select 'campaign_master_pkey' as constraint_name, campaign_id::varchar as key_value, 2::bigint as copies from campaign_master where campaign_id % 50 = 0
  union all select 'uq_channel_corridor', concat(channel_name, '|', region, '|', seniority), 2 from channel_corridor_registry where region = 'APAC'
  union all select 'pk_sourcing_telemetry', concat({moment}, '|', telemetry_id), sum(if(allocated_applicants % 25 = 0, 2, 1))::bigint as copies
    from strained_telemetry where event_timestamp is not null and telemetry_id is not null group by 1, 2 having copies > 1
  union all select 'optimization_runs_audit_pkey', (campaign_id // 2)::varchar, count(*) from campaign_master {copies}"""),
        "dq_declared_references": _with(["sourcing_telemetry", "campaign_master"], strained, """
  select 'sourcing_telemetry_campaign_id_fkey' as constraint_name, t.campaign_id::varchar as key_value,
    sum(if(allocated_applicants % 25 = 0, 2, 1))::bigint as child_rows
  from strained_telemetry t where t.campaign_id is not null and t.campaign_id not in (select campaign_id from campaign_master) group by 1, 2
  union all select 'optimization_runs_audit_campaign_id_fkey', (3 * campaign_id)::varchar, count(*)
  from campaign_master where 3 * campaign_id not in (select campaign_id from campaign_master) group by 1, 2"""),
        "dq_profile": _with(["raw_observations"], {}, f"""select count(*) as rows_read, cast(sum({nulls}) as bigint) as null_values,
  {", ".join(f"{_f(f'min({m})')} as min_{m}, {_f(f'max({m})')} as max_{m}" for m in measures)},
  count(*) filter (where cost_per_applicant_usd <= 0) as cost_not_positive,
  count(*) filter (where max_channel_capacity_applicants <= 0) as capacity_not_positive,
  count(*) filter (where overall_conversion_yield <= 0 or overall_conversion_yield > 1) as yield_out_of_range from raw_observations"""),
    }


def _stored(known: dict[str, str]) -> dict[str, str]:
    """Statements over what sinks and sketches give back, from those of the reports."""
    quarter = "concat(year(event_timestamp), 'Q', quarter(event_timestamp))"
    places = {
        "corridors": (known["corridor_metrics"], O3, O3),
        "daily_rollup": (known["efficiency_rollup"], f"snapshot_date desc, total_spend_usd desc, {C3}", f"snapshot_date, {C3}"),
        "allocation_rollup": (known["allocation_rollup"], "campaign_id, dimension, member", "campaign_id, dimension, member"),
        "allocation_schedule": (known["allocation_schedule"], f"campaign_id, allocated_budget_usd desc, expected_hires desc, {O3}", f"campaign_id, {O3}"),
    }
    return {
        "rollup_refreshed": known["efficiency_rollup"],
        "reach_estimates": _with(["sourcing_telemetry"], {}, f"""select {quarter} as quarter, {C3}, count(distinct campaign_id) as active_campaigns,
  count(*) as observations, true as estimate_in_bounds from sourcing_telemetry group by 1, {C3}"""),
        "quantile_estimates": _with(["sourcing_telemetry"], {}, f"""select {C3}, count(cost_per_applicant_usd) as observations,
  true as p5_in_bounds, true as p50_in_bounds, true as p95_in_bounds, true as p99_in_bounds from sourcing_telemetry group by {C3}"""),
        "quarter_activity": _with(["sourcing_telemetry"], {}, f"""select {quarter} as event_quarter, channel_name, count(*) as observations,
  {_f('sum(allocated_spend_usd)')} as total_spend_usd from sourcing_telemetry where quarter(event_timestamp) = 1 group by 1, 2"""),
        "run_audit": f"""select sha256(concat('budget-only|', campaign_id)) as run_id, campaign_id, solver_status, total_budget_usd,
  total_budget_allocated_usd as allocated_budget_usd, budget_utilization_pct, total_projected_hires as projected_hires,
  blended_cost_per_hire_usd, naive_heuristic_hires, efficiency_gain_pct, cast(null as double) as solve_time_ms
  from ({known['greedy_results']})""",
        "report_positions": " union all ".join(
            f"select '{name}' as report, concat_ws('|', {key}) as row_key, cast(row_number() over (order by {order}) as int) as report_position from ({sql})"
            for name, (sql, order, key) in places.items()),
    }


def oracle_sql() -> dict[str, str]:
    """Statement per query."""
    known = {**_corridors(), **_windows(), **_matrices(), **_paths(), **_cohorts(), **_allocations(), **_streams(), **_quality()}
    return known | _stored(known)
