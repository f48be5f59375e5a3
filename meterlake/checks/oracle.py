"""The same questions in SQL, for another engine to answer on the same tables.

Written from the definitions, not from the Spark code: percentiles by sorting, votes
by case expressions, top-n by ranking.
"""

from __future__ import annotations

_VIEWS = """
usage as (
  select case when event_id % 211 = 0 then null else event_id end as event_id,
         ts, cast(ts as date) as event_date,
         case when user_id % 29 = 0 then user_id + 1000000 else user_id end as org_id,
         event_type as service,
         case when event_id % 3 = 0 then 'requests' else 'cpu_hours' end as metric,
         case when event_id % 17 = 0 then null else value end as value,
         case when event_id % 23 = 0 then null else 'count' end as unit,
         case when event_id % 191 = 0 then -value else value end as cost_usd,
         case when ts >= timestamp '2024-01-16' then 2 else 1 end as schema_version,
         case when ts >= timestamp '2024-01-16' then value / 100 end as carbon_kg,
         coalesce(case when ts >= timestamp '2024-01-16' and event_type = 'signup'
           then cast(json_extract_string(props, '$.k') as bigint) end, 0)
           as genai_tokens,
         case when event_id % 3 = 0 and event_id % 17 <> 0 then value end as requests,
         event_id as source_id
  from events),
tagged as (
  select *, case when event_id is null then 'event_id_null'
                 when value is not null and unit is null
                 then 'unit_missing_with_value' end as dq_rule
  from usage),
clean as (select * from tagged where dq_rule is null),
org as (
  select c_custkey as org_id, c_name as org_name, n_name as industry,
         r_name as hq_region, c_mktsegment as plan_tier
  from customer left join nation on c_nationkey = n_nationkey
                left join region on n_regionkey = r_regionkey),
enriched as (
  select c.*, o.org_name, o.plan_tier, o.industry, o.hq_region
  from clean c left join org o on c.org_id = o.org_id),
band as (
  select service, count(cost_usd) as n_values, avg(cost_usd) as mean_cost,
         stddev_samp(cost_usd) as std_cost,
         quantile_disc(cost_usd, 0.01) as p01, quantile_disc(cost_usd, 0.5) as p50,
         quantile_disc(cost_usd, 0.99) as p99
  from clean group by service),
profile as (
  select b.*, d.mad from band b join (
    select c.service, quantile_disc(abs(c.cost_usd - b.p50), 0.5) as mad
    from clean c join band b on c.service = b.service group by c.service) d
  on b.service = d.service),
scores as (
  select e.*,
         case when std_cost > 0 then abs(cost_usd - mean_cost) / std_cost end
           as score_zscore,
         case when mad > 0 then 0.6745::double * abs(cost_usd - p50) / mad end
           as score_mad,
         case when cost_usd > p99 then cost_usd - p99
              when cost_usd < p01 then p01 - cost_usd
              when cost_usd is not null then 0.0::double end as score_ptiles,
         case when cost_usd < -0.01 then -cost_usd end as score_negative,
         coalesce(cost_usd < p01 or cost_usd > p99, false) as flag_ptiles,
         coalesce(cost_usd < -0.01, false) as flag_negative
  from enriched e left join profile p on e.service = p.service),
votes as (
  select *, coalesce(score_zscore > 3, false) as flag_zscore,
         coalesce(score_mad > 3.5, false) as flag_mad
  from scores),
silver as (
  select *, flag_negative
            or (flag_zscore and flag_mad) or (flag_zscore and flag_ptiles)
            or (flag_mad and flag_ptiles) as cost_anomaly_flag
  from votes),
daily as (
  select org_id, service, event_date, sum(cost_usd) as cost_usd,
         sum(requests) as requests, cast(sum(genai_tokens) as bigint) as genai_tokens,
         sum(carbon_kg) as carbon_kg, count(*) as event_count,
         max(org_name) as org_name, max(plan_tier) as plan_tier,
         max(industry) as industry, max(hq_region) as hq_region
  from enriched group by all),
flags_by_day as (
  select org_id, service, event_date, bool_or(cost_anomaly_flag) as has_anomaly
  from silver group by all),
newest as (select max(event_date) as day from clean),
cost_14d as (
  select org_id, service, sum(cost_usd) as total_cost_usd, max(org_name) as org_name
  from daily, newest where event_date > newest.day - 14 group by org_id, service),
tickets as (
  select o_orderkey as ticket_id, o_custkey as org_id,
         case o_orderpriority when '1-URGENT' then 'critical' when '2-HIGH' then 'high'
              when '3-MEDIUM' then 'medium' else 'low' end as severity,
         cast(o_orderdate as date) as event_date,
         case when o_orderkey % 4 = 0 then null
              else cast(o_orderkey % 5 + 1 as double) end as csat,
         case when o_orderstatus = 'F' then 1 else 0 end as breached
  from orders),
newest_ticket as (select max(event_date) as day from tickets),
ticket_days as (
  select org_id, event_date, severity, count(*) as ticket_count,
         cast(sum(breached) as bigint) as sla_breach_count,
         round(avg(breached), 6) as sla_breach_rate, round(avg(csat), 6) as avg_csat
  from tickets group by org_id, event_date, severity),
recent_tickets as (
  select t.* from ticket_days t, newest_ticket where event_date > newest_ticket.day - 30),
busiest_tickets as (
  select org_id, cast(sum(ticket_count) as bigint) as tickets
  from recent_tickets group by org_id order by tickets desc, org_id limit 1),
invoices as (
  select o_custkey as org_id, cast(date_trunc('month', o_orderdate) as date) as month,
         o_totalprice as subtotal,
         case when o_orderkey % 7 = 0 then o_totalprice * 0.1::double
              else 0.0::double end as credits,
         case when o_orderkey % 11 = 0 then 0.0::double
              else o_totalprice * 0.21::double end as taxes,
         case when o_orderkey % 3 = 0 then 'ARS' when o_orderkey % 3 = 1 then 'EUR'
              else 'USD' end as currency,
         case when o_orderkey % 3 = 0 then 0.0016::double
              when o_orderkey % 3 = 1 then 1.08::double else 1.0::double end as rate
  from orders),
revenue as (
  select org_id, month, (subtotal - credits + taxes) * rate as revenue_usd,
         subtotal, credits, taxes, currency from invoices),
revenue_months as (
  select org_id, month, sum(revenue_usd) as revenue_usd,
         case when count(distinct currency) = 1 then sum(subtotal) end as subtotal,
         case when count(distinct currency) = 1 then sum(credits) end as credits,
         case when count(distinct currency) = 1 then sum(taxes) end as taxes,
         case when count(distinct currency) = 1 then max(currency) end as currency,
         count(*) as invoice_count
  from revenue group by org_id, month),
genai as (
  select org_id, event_date, cast(sum(genai_tokens) as bigint) as total_tokens,
         sum(cost_usd) as cost_usd, count(*) as event_count
  from clean where service = 'signup' group by org_id, event_date),
anomalies as (
  select org_id, service, event_date, count(*) as event_count,
         max(org_name) as org_name,
         max(score_zscore) filter (where flag_zscore) as max_zscore,
         max(score_mad) filter (where flag_mad) as max_mad,
         max(score_ptiles) filter (where flag_ptiles) as max_ptiles,
         max(score_negative) filter (where flag_negative) as max_negative
  from silver where cost_anomaly_flag group by org_id, service, event_date),
anomaly_rows as (
  select org_id, service, cast(event_date as varchar) as event_date,
         round(greatest(coalesce(max_zscore, 0), coalesce(max_mad, 0),
                        coalesce(max_ptiles, 0), coalesce(max_negative, 0)), 10)
           as anomaly_score,
         event_count, org_name,
         concat_ws(',', case when max_mad is not null then 'mad' end,
                        case when max_negative is not null then 'negative' end,
                        case when max_ptiles is not null then 'ptiles' end,
                        case when max_zscore is not null then 'zscore' end) as methods,
         round(max_zscore, 10) as max_zscore, round(max_mad, 10) as max_mad,
         round(max_ptiles, 10) as max_ptiles, round(max_negative, 10) as max_negative
  from anomalies),
busiest_events as (
  select org_id, count(*) as n from clean group by org_id order by n desc, org_id limit 1)
"""

_EVENT = """cast(event_id as varchar) as event_id, org_id, service, metric,
  cast(event_date as varchar) as event_date, round(cost_usd, 6) as cost_usd,
  round(requests, 6) as requests, genai_tokens, round(carbon_kg, 6) as carbon_kg"""
_FLAGS = "flag_zscore, flag_mad, flag_ptiles, flag_negative, cost_anomaly_flag"
_TICKETS = """org_id, cast(event_date as varchar) as event_date, severity,
  ticket_count, sla_breach_count, sla_breach_rate, avg_csat"""
_RANGE = """org_id, cast(event_date as varchar) as event_date, service,
  round(cost_usd, 6) as cost_usd, round(requests, 6) as requests"""
_WORST = """org_id, event_date, service, anomaly_score, event_count, methods,
  max_zscore, max_mad, max_ptiles, max_negative"""
_REVENUE = """org_id, cast(month as varchar) as month,
  round(revenue_usd, 8) as revenue_usd, round(subtotal, 8) as subtotal,
  round(credits, 8) as credits, round(taxes, 8) as taxes, currency"""
_DAILY = """select d.org_id, d.service, cast(d.event_date as varchar) as event_date,
  round(cost_usd, 6) as cost_usd, round(requests, 6) as requests, genai_tokens,
  round(carbon_kg, 6) as carbon_kg, event_count, has_anomaly, org_name, plan_tier,
  industry, hq_region
  from daily d join flags_by_day f on d.org_id = f.org_id
    and d.service = f.service and d.event_date = f.event_date"""
_TOP = """from (select *, row_number() over (
    partition by org_id order by total_cost_usd desc, service) as pos from cost_14d)
  where pos <= 3"""
_ZONE_COUNTS = {
    "bronze": "usage",
    "silver": "clean",
    "quarantine": "tagged where dq_rule is not null",
    "daily": "daily",
    "cost_14d": "cost_14d",
    "tickets": "ticket_days",
    "revenue": "revenue_months",
    "genai": "genai",
}
_SERVING_COUNTS = {
    "org_daily_usage_by_service": "daily",
    "org_service_cost_14d": "cost_14d",
    "tickets_by_org_date": "ticket_days",
    "revenue_by_org_month": "revenue_months",
    "genai_tokens_by_org_date": "genai",
    "cost_anomaly_by_org_date": "anomalies",
}


def _counts(zones: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{zone}' as zone, count(*) as rows from {source}"
        for zone, source in zones.items()
    )


_RESOURCES = """(
  select o_orderkey as k, cast(o_custkey as varchar) as org_id, o_orderkey % 17 = 0 as cut,
         case when o_orderkey % 13 <> 0 then cast(o_orderkey as varchar) end as id,
         case when o_orderkey % 7 = 0 then 'soon'
              when o_orderkey % 11 = 0 then '2024-13-45' end as bad,
         cast(cast(o_orderdate as date) as varchar) as day,
         '{"note": "a,' || chr(10) || o_orderstatus || '"}' as tags
  from orders) r"""

_BODIES = {
    "conform_usage": f"select {_EVENT}, schema_version from usage",
    "dq_clean": f"select {_EVENT} from clean",
    "dq_quarantine": f"""select {_EVENT}, round(value, 6) as value, unit, dq_rule
        from tagged where dq_rule is not null""",
    "dq_breakdown": """select dq_rule, count(*) as rows from tagged
        where dq_rule is not null group by dq_rule""",
    "dq_samples": """select cast(event_id as varchar) as event_id, service, metric,
        round(value, 6) as value, unit, dq_rule
        from tagged where dq_rule is not null
        order by dq_rule, tagged.event_id nulls first, service, metric,
                 tagged.value nulls first, unit nulls first limit 5""",
    "dq_conservation": """select count(*) as bronze_rows,
        count(*) filter (where dq_rule is null) as clean_rows,
        count(dq_rule) as quarantine_rows, true as conserved from tagged""",
    "enrich_usage": f"""select {_EVENT}, org_name, plan_tier, industry, hq_region
        from enriched""",
    "unknown_org_events": f"""select {_EVENT} from clean
        where org_id not in (select c_custkey from customer)""",
    "service_statistics": """select service, n_values,
        round(mean_cost, 6) as mean_cost, round(std_cost, 6) as std_cost,
        round(p01, 6) as p01, round(p50, 6) as p50, round(p99, 6) as p99,
        round(mad, 6) as mad from profile""",
    "outlier_scores": """select cast(event_id as varchar) as event_id, service,
        round(score_zscore, 10) as score_zscore, round(score_mad, 10) as score_mad,
        round(score_ptiles, 10) as score_ptiles,
        round(score_negative, 10) as score_negative from silver""",
    "outlier_flags": f"""select cast(event_id as varchar) as event_id, {_FLAGS}
        from silver""",
    "outlier_union_flag": """select cast(event_id as varchar) as event_id, c.service,
        round(cost_usd, 6) as cost_usd,
        cost_usd < -0.01 or cost_usd < p01 or cost_usd > p99 as cost_anomaly_flag
        from clean c left join band b on c.service = b.service""",
    "daily_usage": _DAILY,
    "cost_rolling_14d": """select org_id, service,
        round(total_cost_usd, 6) as total_cost_usd, org_name from cost_14d""",
    "tickets_by_day": f"select {_TICKETS} from ticket_days",
    "revenue_per_invoice": f"select {_REVENUE} from revenue",
    "revenue_by_org_month": f"select {_REVENUE}, invoice_count from revenue_months",
    "genai_by_day": """select org_id, cast(event_date as varchar) as event_date,
        total_tokens, round(cost_usd, 6) as cost_usd, event_count from genai""",
    "anomaly_mart": "select * from anomaly_rows",
    "q_daily_range": f"""select {_RANGE} from daily, newest
        where event_date >= date_trunc('month', newest.day)
          and event_date < date_trunc('month', newest.day) + interval 15 day""",
    "q_daily_range_one_org": f"""select {_RANGE} from daily
        where org_id = (select org_id from busiest_events)""",
    "q_top_services": f"""select org_id, service,
        round(total_cost_usd, 6) as total_cost_usd {_TOP}""",
    "q_top_services_one_org": f"""select org_id, service,
        round(total_cost_usd, 6) as total_cost_usd {_TOP}
        and org_id = (select org_id from busiest_events)""",
    "busiest_org_30d": "select org_id, tickets from busiest_tickets",
    "q_tickets": f"select {_TICKETS} from recent_tickets",
    "q_tickets_busiest_org": f"""select {_TICKETS} from recent_tickets
        where org_id = (select org_id from busiest_tickets)""",
    "q_critical_tickets": f"""select {_TICKETS} from recent_tickets
        where severity = 'critical'""",
    "q_revenue": f"select {_REVENUE} from revenue_months",
    "q_genai": """select org_id, cast(event_date as varchar) as event_date,
        total_tokens, round(cost_usd, 6) as cost_usd, event_count
        from genai, newest where event_date > newest.day - 14""",
    "q_worst_anomalies": f"""select {_WORST} from (select *, row_number() over (
          partition by org_id order by anomaly_score desc, event_date desc, service)
          as pos from anomaly_rows) where pos <= 2""",
    "q_worst_anomalies_one_org": f"""select {_WORST} from anomaly_rows
        where org_id = (select org_id from anomalies group by org_id
                        order by sum(event_count) desc, org_id limit 1)
        order by anomaly_score desc, event_date desc, service limit 10""",
    "master_scan": """select cast(o_orderkey as varchar) as resource_id,
        cast(o_custkey as varchar) as org_id, o_orderpriority as service,
        cast(null as varchar) as region,
        cast(cast(o_orderdate as date) as varchar) as created_at,
        o_orderstatus as state,
        '{"o_orderpriority":"' || o_orderpriority || '","o_orderstatus":"'
          || o_orderstatus || '"}' as tags_json from orders""",
    "master_dedupe": """select l_orderkey,
        cast(cast(l_shipdate as date) as varchar) as l_shipdate,
        round(l_extendedprice, 6) as l_extendedprice, l_linenumber, l_partkey
        from (select *, row_number() over (partition by l_orderkey
                order by cast(l_shipdate as date) desc, l_extendedprice desc,
                         l_linenumber desc, l_partkey desc) as pos from lineitem)
        where pos = 1""",
    "latest_snapshot": """select cast(org_id as varchar) as org_id, org_name, industry,
        hq_region, lower(plan_tier) as plan_tier, org_id % 2 = 0 as is_enterprise,
        '2024-01-01' as signup_date, cast(null as varchar) as sales_rep,
        cast(null as varchar) as lifecycle_stage,
        cast(null as varchar) as marketing_source,
        case when org_id % 5 <> 0 then cast(org_id % 10 as double) end as nps_score,
        '2024-02-02' as ingest_date from org where org_id % 10 <> 0""",
    "stream_dedupe": """select distinct cast(event_id as varchar) as event_id,
        cast(org_id as varchar) as org_id, service,
        cast(event_date as varchar) as event_date,
        round(cost_usd, 6) as cost_usd_increment,
        case when schema_version = 2 and service = 'signup' then genai_tokens end
          as genai_tokens from usage where event_id is not null""",
    "malformed_rescue": """select outcome, count(*) as rows,
        cast(sum(broken) as bigint) as broken_lines,
        round(sum(value), 6) as value, cast(sum(tokens) as bigint) as genai_tokens,
        cast(sum(version) as bigint) as schema_versions
        from (select case when event_id is null or event_id % 101 = 0
                            then 'event_id_null'
                          when not damaged and value is not null and unit is null
                            then 'unit_missing_with_value'
                          when damaged then 'malformed_value'
                          else 'accepted' end as outcome,
                     case when event_id % 101 = 0 then 1 else 0 end as broken,
                     case when event_id % 101 = 0 or damaged then null
                          else value end as value,
                     case when event_id % 101 = 0 then 0 else genai_tokens end as tokens,
                     case when event_id % 101 = 0 then null
                          else schema_version end as version
              from (select *, coalesce(event_id % 13 = 0 or event_id % 19 = 0
                                       or event_id % 31 = 0, false) as damaged
                    from usage)) group by outcome""",
    "stream_quality_split": """select cast(event_date as varchar) as event_date,
        coalesce(dq_rule, 'accepted') as outcome, count(*) as rows,
        round(sum(cost_usd), 6) as cost_usd from tagged group by all""",
    "stream_scored": f"""select cast(event_id as varchar) as event_id, {_FLAGS}
        from silver""",
    "profile_by_state": """select service, n_values, round(mean_cost, 6) as mean_cost,
  round(std_cost, 6) as std_cost, true as p01_within, true as p50_within,
  true as p99_within, true as mad_within from band""",
    "stream_daily_window": """select cast(event_date as varchar) as event_date, service,
        round(sum(cost_usd), 6) as cost_usd,
        cast(sum(genai_tokens) as bigint) as genai_tokens, count(*) as event_count
        from clean group by event_date, service""",
    "stream_late_windows": """select cast(event_date as varchar) as event_date, service,
        round(sum(cost_usd), 6) as cost_usd,
        cast(sum(genai_tokens) as bigint) as genai_tokens, count(*) as event_count,
        false as opened_twice from clean group by event_date, service""",
    "stream_mart_refresh": _DAILY,
    "upsert_merge": """select org_id, cast(event_date as varchar) as event_date,
        service, round(sum(cost_usd), 6) as cost_usd,
        round(sum(requests), 6) as requests, count(*) as event_count
        from clean where schema_version = 2 or metric <> 'requests' group by all""",
    "reload_snapshot": """select org_id, round(total_cost_usd, 6) as total_cost_usd,
        service, org_name from cost_14d""",
    "serving_newest_first": """select 'tickets' as "table",
        row_number() over (order by event_date desc, severity) as place,
        event_date || ' ' || severity as row
        from ticket_days, newest_ticket
        where org_id = (select org_id from busiest_tickets)
          and event_date >= newest_ticket.day - 400
        union all
        select 'revenue', row_number() over (order by month desc), cast(month as varchar)
        from revenue_months where org_id = (select org_id from busiest_tickets)
        union all
        select 'genai', row_number() over (order by event_date desc), cast(event_date as varchar)
        from genai where org_id = (select min(org_id) from genai)""",
    "reload_interrupted": """select 'reloaded' as seen, org_id,
        round(total_cost_usd, 6) as total_cost_usd, service, org_name from cost_14d
        union all
        select 'interrupted', org_id, round(sum(cost_usd), 6), service, max(org_name)
        from daily, newest where event_date between newest.day - 20 and newest.day - 7
        group by org_id, service""",
    "stream_cost_14d": """select org_id, round(total_cost_usd, 6) as total_cost_usd,
        service, org_name from cost_14d""",
    "stream_genai": """select org_id, cast(event_date as varchar) as event_date,
        total_tokens, round(cost_usd, 6) as cost_usd, event_count from genai""",
    "stream_anomalies": "select * from anomaly_rows",
    "compaction": """select cast(event_date as varchar) as event_date, count(*) as rows,
        round(sum(cost_usd), 6) as cost_usd, true as one_file, true as settled
        from clean group by event_date""",
    "serving_counts": _counts(_SERVING_COUNTS),
    "first_org": "select min(org_id) as org_id from daily",
    "master_audit": """select cast(org_id as varchar) as org_id,
        '2024-02-01' as ingest_date, true as landed, true as stamped from org""",
    "master_quarantine": """select org_name,
        case when org_id % 7 = 0 then 'org_id_null' else 'accepted' end as dq_rule,
        '2024-02-01' as ingest_date from org""",
    "master_malformed": f"""
        select case when id is null then 'resource_id_null' else 'accepted' end as outcome,
               id as resource_id, org_id, case when bad is null then day end as created_at,
               tags as tags_json, cast(null as varchar) as text
        from {_RESOURCES} where not cut
        union all
        select 'broken_line', null, null, null, null, k || ',' || org_id || ',d'
        from {_RESOURCES} where cut
        union all
        select 'malformed_value', '["' || coalesce(id, '') || '"]', null, null, null,
               'created_at=' || bad from {_RESOURCES} where not cut and bad is not null""",
    "zone_size": """select count(distinct event_date) as partitions, true as adds_up
        from clean""",
    "zone_manifest": _counts(_ZONE_COUNTS),
    "written_counts": """select zone, rows, rows as counted, true as conserved from (
          select 'bronze' as zone, count(*) as rows from usage union all
          select 'silver', count(*) from clean union all
          select 'quarantine', count(dq_rule) from tagged union all
          select 'daily', count(*) from daily)""",
    "supervised_run": """select cast(event_date as varchar) as event_date, count(*) as rows,
        round(sum(cost_usd), 6) as cost_usd, 1 as failures, true as all_noted
        from clean group by event_date""",
    "rerun_stability": """select zone, rows as first_rows, rows as second_rows,
        true as stable from (
          select 'silver' as zone, count(*) as rows from clean union all
          select 'quarantine', count(dq_rule) from tagged union all
          select 'daily', count(*) from daily)""",
    "partition_report": """select cast(event_date as varchar) as event_date,
        count(*) as rows, true as stored from clean group by event_date""",
}

# The same question asked in another way, or in two ways at once.
_BODIES["enrich_usage_spread"] = _BODIES["enrich_usage"]
_BODIES["outlier_flags_levels"] = _BODIES["outlier_flags"]
_BODIES["upsert_retry"] = _BODIES["upsert_merge"]
_BODIES["service_statistics_levels"] = (
    _BODIES["service_statistics"]
    + """ union all select null, count(cost_usd), round(avg(cost_usd), 6),
        round(stddev_samp(cost_usd), 6), null, null, null, null from clean"""
)
_BODIES["stream_future_event"] = (
    _BODIES["stream_dedupe"]
    + " union all select '-1', '1', 'signup', '2099-01-01', 1.0::double, null"
)


def _asked_twice(every: str, one: str) -> str:
    return f"select *, 'all' as asked from ({every}) union all select *, 'one' from ({one})"


_BUSIEST = " where org_id = (select org_id from busiest_events)"
_BODIES |= {
    "serving_daily_range": _asked_twice(
        _BODIES["q_daily_range"], _BODIES["q_daily_range_one_org"]
    ),
    "serving_top_services": _asked_twice(
        _BODIES["q_top_services"], _BODIES["q_top_services_one_org"]
    ),
    "serving_tickets": _asked_twice(_BODIES["q_tickets"], _BODIES["q_tickets_busiest_org"]),
    "serving_revenue": _asked_twice(_BODIES["q_revenue"], _BODIES["q_revenue"] + _BUSIEST),
    "serving_genai": _asked_twice(
        _BODIES["q_genai"],
        _BODIES["q_genai"] + " and org_id = (select org_id from busiest_events)",
    ),
    "serving_anomalies": _asked_twice(
        _BODIES["q_worst_anomalies"], _BODIES["q_worst_anomalies_one_org"]
    ),
}

ORACLE: dict[str, str] = {
    name: f"with {_VIEWS.strip()}\n{body}" for name, body in _BODIES.items()
}
