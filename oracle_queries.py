"""DuckDB SQL that computes the same results as the registered queries, written independently."""

from __future__ import annotations

from prevascope.config import STATE_CODES

EM = """
em as (
  select n_name as state_code, r_name as state_name, c_name as county_name,
         cast(c_custkey as varchar) as county_fips,
         cast(case when c_acctbal < 0 then 0 else floor(c_acctbal * 10) end as int) as total_population,
         cast(100.0e0 * e / n as decimal(5,2)) as pct_uninsured,
         cast(100.0e0 * nullif(a, 0) / n as decimal(5,2)) as pct_diabetes,
         cast(100.0e0 * nullif(c, 0) / n as decimal(5,2)) as pct_current_smoker,
         cast(100.0e0 * nullif(b, 0) / n as decimal(5,2)) as pct_obesity,
         cast(100.0e0 * nullif(f, 0) / n as decimal(5,2)) as pct_arthritis,
         cast(100.0e0 * nullif(g, 0) / n as decimal(5,2)) as pct_heart_disease,
         cast(100.0e0 * nullif(h, 0) / n as decimal(5,2)) as pct_stroke
  from customer
  join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey
  left join (
    select o_custkey, count(*) as n,
           sum(case when o_orderstatus = 'F' then 1 else 0 end) as a,
           sum(case when o_orderpriority = '1-URGENT' then 1 else 0 end) as b,
           sum(case when o_orderstatus = 'P' then 1 else 0 end) as c,
           sum(case when o_orderpriority = '5-LOW' then 1 else 0 end) as e,
           sum(case when o_orderpriority = '2-HIGH' then 1 else 0 end) as f,
           sum(case when o_orderpriority = '3-MEDIUM' then 1 else 0 end) as g,
           sum(case when o_orderpriority = '4-NOT SPECIFIED' then 1 else 0 end) as h
    from orders group by o_custkey
  ) o on o_custkey = c_custkey
)"""

KEYS = "state_code, state_name, county_name, county_fips, total_population"
MEASURES = (
    "pct_uninsured, pct_diabetes, pct_current_smoker, pct_obesity, pct_arthritis, pct_heart_disease, pct_stroke"
)


def _r2(expression: str) -> str:
    return f"round(cast({expression} as double), 2)"


def _rank(column: str, name: str) -> str:
    return (
        f"cast(row_number() over (partition by state_code order by {column} desc nulls last, county_fips)"
        f" as bigint) as {name}"
    )


RANKS = ", ".join(
    [_rank("pct_diabetes", "diabetes_rank"), _rank("pct_obesity", "obesity_rank"),
     _rank("pct_current_smoker", "smoking_rank")]
)

RANKED = f"""
averaged as (
  select *, avg(pct_diabetes) over (partition by state_code) as state_avg_diabetes,
         avg(pct_obesity) over (partition by state_code) as state_avg_obesity,
         avg(pct_current_smoker) over (partition by state_code) as state_avg_smoking,
         {RANKS}
  from em
),
ranked as (
  select {KEYS}, {MEASURES}, state_avg_diabetes, state_avg_obesity, state_avg_smoking,
         {_r2("pct_diabetes - state_avg_diabetes")} as diabetes_deviation_from_state_avg,
         {_r2("pct_obesity - state_avg_obesity")} as obesity_deviation_from_state_avg,
         {_r2("pct_current_smoker - state_avg_smoking")} as smoking_deviation_from_state_avg,
         diabetes_rank, obesity_rank, smoking_rank
  from averaged
)"""

PROFILE = f"""
with_median as (
  select *, quantile_cont(pct_diabetes, 0.5) over (partition by state_code) as median_diabetes,
         quantile_cont(pct_obesity, 0.5) over (partition by state_code) as median_obesity
  from em
),
profile as (
  select state_code, state_name, count(distinct county_fips) as num_counties,
         cast(sum(total_population) as bigint) as state_total_population,
         {", ".join(f"{_r2(f'avg({m})')} as avg_{m}" for m in MEASURES.split(", "))},
         min(pct_diabetes) as min_pct_diabetes, max(pct_diabetes) as max_pct_diabetes,
         max(pct_diabetes) - min(pct_diabetes) as diabetes_disparity_range,
         min(pct_obesity) as min_pct_obesity, max(pct_obesity) as max_pct_obesity,
         max(pct_obesity) - min(pct_obesity) as obesity_disparity_range,
         min(pct_current_smoker) as min_pct_smoking, max(pct_current_smoker) as max_pct_smoking,
         max(pct_current_smoker) - min(pct_current_smoker) as smoking_disparity_range,
         cast(sum(case when pct_diabetes >= median_diabetes then 1 else 0 end) as bigint) as counties_high_diabetes,
         cast(sum(case when pct_obesity >= median_obesity then 1 else 0 end) as bigint) as counties_high_obesity
  from with_median group by state_code, state_name
)"""

BURDEN = _r2(
    "abs(pct_diabetes - state_avg_diabetes) + abs(pct_obesity - state_avg_obesity)"
    " + abs(pct_current_smoker - state_avg_smoking)"
)
STATUS = """case when pct_diabetes is null or pct_obesity is null or pct_current_smoker is null then 'Incomplete Data'
         when total_population < 10000 then 'Small Population' else 'Valid' end"""
FLAGS = """case when pct_diabetes > state_avg_diabetes + (state_diabetes_range * 0.1) then true else false end as flag_high_diabetes,
         case when pct_obesity > state_avg_obesity + (state_obesity_range * 0.1) then true else false end as flag_high_obesity"""

MART = f"""
joined as (
  select r.*, p.avg_pct_diabetes as state_avg_diabetes_agg, p.avg_pct_obesity as state_avg_obesity_agg,
         p.avg_pct_current_smoker as state_avg_smoking_agg,
         p.diabetes_disparity_range as state_diabetes_range, p.obesity_disparity_range as state_obesity_range
  from ranked r left join profile p on r.state_code = p.state_code
),
mart as (
  select {KEYS}, {MEASURES}, state_avg_diabetes, state_avg_obesity, state_avg_smoking,
         diabetes_rank, obesity_rank, smoking_rank,
         state_avg_diabetes_agg, state_avg_obesity_agg, state_avg_smoking_agg,
         state_diabetes_range, state_obesity_range,
         {FLAGS},
         {BURDEN} as health_burden_score,
         {STATUS} as data_quality_status
  from joined
)"""

ORDER = "state_code nulls last, health_burden_score desc nulls last, county_name nulls last, county_fips"
AS_OF = "timestamp '2024-01-31 00:00:00'"

LONG = f"""
select {KEYS}, 'Uninsured' as health_measure, pct_uninsured as prevalence_percent from em where pct_uninsured is not null
union all
select {KEYS}, 'Diabetes', pct_diabetes from em where pct_diabetes is not null
union all
select {KEYS}, 'Current Smoker', pct_current_smoker from em where pct_current_smoker is not null
union all
select {KEYS}, 'Obesity', pct_obesity from em where pct_obesity is not null"""

ABSENT_MEASURES = [
    "pct_healthcare_checkup", "pct_cancer", "pct_copd", "pct_hypertension", "pct_asthma", "pct_depression",
    "pct_binge_drinking", "pct_low_physical_activity", "pct_mental_health_days", "pct_physical_health_days",
    "pct_general_health_fair_poor", "pct_social_isolation", "pct_food_insecurity", "pct_housing_insecurity",
    "pct_any_disability",
]


def _instant(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"


HOURS = f"(epoch_us({AS_OF}) - epoch_us(last_ts)) / 3.6e9"
DAYS = f"floor((epoch_us({AS_OF}) - epoch_us(last_ts)) / 86400000000.0)"

CHECKS = f"""
facts as (
  select min(ts) as first_ts, max(ts) as last_ts, count(distinct cast(ts as date)) as dates, count(*) as n,
         cast(sum(case when event_type is null then 1 else 0 end) as bigint) as no_state,
         cast(sum(case when user_id is null then 1 else 0 end) as bigint) as no_county,
         cast(sum(case when event_type = 'error' or value is null then 1 else 0 end) as bigint) as no_diabetes
  from events
),
checks as (
  select 1 as check_no, 'Data Freshness' as name, case when {HOURS} <= 24 then 'PASS' else 'FAIL' end as status,
         case when {HOURS} > 24 then 'Data is ' || {_r2(HOURS)} || ' hours old (max: 24)' end as reason,
         case when {HOURS} <= 24 then {_instant("last_ts")} end as last_load,
         case when {HOURS} <= 24 then {_r2(HOURS)} end as hours_old,
         cast(null as bigint) as places_records, cast(null as bigint) as total_records,
         cast(null as bigint) as null_states, cast(null as bigint) as null_counties,
         cast(null as bigint) as null_diabetes, cast(null as varchar) as min_date,
         cast(null as varchar) as max_date, cast(null as bigint) as distinct_dates
  from facts
  union all
  select 2, 'Record Counts', case when n > 0 then 'PASS' else 'FAIL' end, null, null, null, n, n,
         null, null, null, null, null, null from facts
  union all
  select 3, 'Null Values Check', case when no_state = 0 and no_county = 0 then 'PASS' else 'FAIL' end, null, null, null,
         null, null, no_state, no_county, no_diabetes, null, null, null from facts
  union all
  select 4, 'Date Range Check', case when {DAYS} < 7 then 'PASS' else 'FAIL' end, null, null, null, null, null,
         null, null, null, {_instant("first_ts")}, {_instant("last_ts")}, dates from facts
)"""

PARTIES = """select s_suppkey as id, s_name as name, s_nationkey as nation, s_acctbal as balance from supplier
            union all select c_custkey, c_name, c_nationkey, c_acctbal from customer"""

LAYER_RULES = [
    *[(model, name, column, "not_null", f"{column} is null") for model, name, column in [
        ("staging", "em", "state_code"), ("staging", "em", "county_name"), ("ranking", "ranked", "state_code"),
        ("ranking", "ranked", "county_name"), ("profile", "profile", "state_code"), ("mart", "mart", "state_code"),
        ("mart", "mart", "county_fips"),
    ]],
    # nations of the sample stand for states
    ("profile", "profile", "state_code", "accepted_values", f"state_code not in {tuple(STATE_CODES)}"),
    ("mart", "mart", "data_quality_status", "accepted_values",
     "data_quality_status not in ('Valid', 'Incomplete Data', 'Small Population')"),
]

MEDIANS_OF_LINES = """
with numbered as (
  select l_returnflag, l_quantity, l_extendedprice,
         row_number() over (partition by l_returnflag order by l_quantity) as quantity_no,
         row_number() over (partition by l_returnflag order by l_extendedprice) as price_no,
         count(*) over (partition by l_returnflag) as n
  from lineitem
)
select l_returnflag,
       sum(l_quantity) filter (where quantity_no in ((n + 1) // 2, n // 2 + 1))
         / count(*) filter (where quantity_no in ((n + 1) // 2, n // 2 + 1)) as median_quantity,
       sum(l_extendedprice) filter (where price_no in ((n + 1) // 2, n // 2 + 1))
         / count(*) filter (where price_no in ((n + 1) // 2, n // 2 + 1)) as median_price
from numbered group by l_returnflag"""

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def oracle_sql() -> dict[str, str]:
    ranked = f"with {EM}, {RANKED}"
    mart = f"with {EM}, {RANKED}, {PROFILE}, {MART}"
    ranking_sql = f"{ranked} select * from ranked"
    rank_sql = f"with {EM} select {KEYS}, {RANKS} from em"
    median_sql = f"""with {EM} select state_code, quantile_cont(pct_diabetes, 0.5) as median_diabetes,
        quantile_cont(pct_obesity, 0.5) as median_obesity from em group by state_code"""
    recent = "select * from events order by ts desc nulls last, event_id limit {}"
    return {
        "entity_mart": f"{mart} select * from mart",
        "entity_mart_sorted": f"{mart} select * from mart",
        "group_profile": f"with {EM}, {PROFILE} select * from profile",
        "entity_ranking": ranking_sql,
        "entity_ranking_sorted": ranking_sql,
        "group_deviation": f"""{ranked} select state_code, county_fips, state_avg_diabetes, state_avg_obesity,
            state_avg_smoking, diabetes_deviation_from_state_avg, obesity_deviation_from_state_avg,
            smoking_deviation_from_state_avg from ranked""",
        "group_median": median_sql,
        "group_median_wide_type": median_sql,
        "group_median_bracketed": MEDIANS_OF_LINES,
        "distinct_by_load": """with o as (select *, year(o_orderdate) as y from orders)
            select o_orderpriority, count(distinct o_custkey) as customers,
                   nullif(count(distinct case when y > (select max(y) from o) - 2 then o_custkey end), 0) as recent_customers
            from o group by o_orderpriority""",
        "group_profile_by_load": f"with {EM}, {PROFILE} select * from profile",
        "rank_in_group": rank_sql,
        "rank_in_group_sorted": rank_sql,
        "count_at_or_above_median": f"""with {EM}, {PROFILE}
            select state_code, state_name, counties_high_diabetes, counties_high_obesity from profile""",
        "left_join_context": f"""{mart} select state_code, county_fips, state_avg_diabetes_agg, state_avg_obesity_agg,
            state_avg_smoking_agg, state_diabetes_range, state_obesity_range from joined""",
        "threshold_flags": f"{mart} select county_fips, flag_high_diabetes, flag_high_obesity from mart",
        "burden_score": f"{ranked} select county_fips, {BURDEN} as health_burden_score from ranked",
        "quality_status": f"with {EM} select county_fips, {STATUS} as data_quality_status from em",
        "mart_ordered": f"""{mart} select row_number() over (order by {ORDER}) as position, state_code, county_fips,
            health_burden_score from mart""",
        "mart_ordered_top": f"{mart} select * from mart order by {ORDER} limit 50",
        "staging": f"""with {EM} select {KEYS}, total_population as adult_population, {MEASURES},
            {", ".join(f"cast(null as decimal(5,2)) as {m}" for m in ABSENT_MEASURES)} from em""",
        "unpivot_measures": f"with {EM} {LONG}",
        "state_filter": f"with {EM} select * from em where state_code in ('NATION_3', 'NATION_7', 'NATION_11')",
        "measure_filter": f"""with {EM}, long as ({LONG})
            select * from long where health_measure in ('Diabetes', 'Obesity')""",
        "json_roundtrip": "select * from customer",
        "json_dir_scan": """select s_suppkey as id, s_name as name, s_nationkey as nation, s_acctbal as balance from supplier
            union all select c_custkey, c_name, c_nationkey, c_acctbal from customer""",
        "json_document_scan": f"""{PARTIES} union all {PARTIES.partition("union all")[0]}
            union all select r_regionkey, r_name, null, null from region""",
        "landing_quarantine": """select 'records' as table_name, count(*) as records from supplier where s_suppkey // 10 % 2 = 0
            union all select 'quarantine', count(distinct s_suppkey // 10) from supplier where s_suppkey // 10 % 2 = 1""",
        "ingest_once": PARTIES,
        "ingest_after_lost_checkpoint": PARTIES,
        "layer_tables": f"{mart} select * from mart",
        "layer_rebuild": f"{mart} select * from mart",
        "ranking_stored_order": f"with {EM} select count(*) as records, cast(0 as bigint) as misplaced from em",
        "profile_stored_order": f"with {EM} select state_code, row_number() over (order by state_code) as position from (select distinct state_code from em)",
        "quality_gate": """with g as (select cast(unnest([1, 8760]) as int) as hours),
              c as (select count(*) filter (where user_id is null) as bad from events where event_type is not null)
            select hours, concat_ws('; ',
                case when hours > 24 then 'Data Freshness: FAIL Data is ' || hours || '.0 hours old (max: 24)' end,
                case when bad > 0 then 'Null Values Check: FAIL' end,
                case when hours >= 24 * 7 then 'Date Range Check: FAIL' end) as refusal
            from g, c""",
        "layer_contracts": f"with {EM}, {RANKED}, {PROFILE}, {MART} " + " union all ".join(
            f"""select '{model}' as model, '{column}' as column_name, '{rule}' as rule, f as failures,
                case when f = 0 then 'PASS' else 'FAIL' end as status
                from (select cast(count(*) filter (where {broken}) as bigint) as f from {name})"""
            for model, name, column, rule, broken in LAYER_RULES
        ),
        "layer_audit": f"""with {EM}, counted as (
            select unnest(['staging', 'ranking', 'mart']) as model, (select count(*) from em) as records
            union all select 'profile', (select count(*) from (select distinct state_code, state_name from em)))
            select model, records, records as stamped, cast(1 as bigint) as stamps from counted""",
        "list_tables": """select 'nation.nation' as table_name, count(*) as records, 'ok' as status from nation
            union all select 'region.region', count(*), 'ok' from region union all select 'region.absent', null, 'missing'""",
        "year_filter": "select *, cast(year(o_orderdate) as int) as year from orders where year(o_orderdate) = 1995",
        "report_top_groups": f"""with {EM}, newest as (select * from em order by county_fips desc limit 1000)
            select state_code, cast(sum(total_population) as bigint) as total_population
            from newest group by state_code order by 2 desc, 1 limit 20""",
        "append_loads": """with loads as (select 1 as load_no, * from customer union all select 2, * from customer)
            select load_no, count(*) as records, cast(sum(cast(c_acctbal as decimal(18,2))) as decimal(28,2)) as balance,
                   case when load_no = 2 then count(*) else 0 end as added from loads group by load_no""",
        **dict.fromkeys(["latest_per_entity", "merge_batch"], """select c_custkey, c_name, case when c_acctbal < 0 then 0 else c_acctbal end as c_acctbal,
            case when c_acctbal < 0 then 'second' else 'first' end as source_file from customer"""),
        "provenance": """select c_custkey, 'customer.parquet' as source_file, timestamp '2024-02-01 06:00:00' as loaded_at,
            timestamp '2024-02-01 05:00:00' as extracted_at, 'CDC_PLACES' as source, 'd3i6-k6z5' as dataset_id
            from customer""",
        "page_of_table": "select * from orders order by o_orderkey limit 50 offset 100",
        "page_of_table_deep": """select *, row_number() over (order by o_orderkey) as position
            from (select * from orders order by o_orderkey limit 500 offset 10000)""",
        "page_by_index": """select * from (select *, row_number() over (order by o_orderkey) as position from orders)
            where position between 10001 and 10500 or position > (select count(*) - 100 from orders)""",
        "latest_by_index": """select * from (select *, row_number() over (order by ts nulls last, event_id) as position from events)
            where position > (select count(*) - 1000 from events)""",
        "pages_by_cursor": """select *, cast((position - 1) // 7 as integer) as page
            from (select *, row_number() over (order by s_nationkey, s_suppkey) as position from supplier) where position <= 35""",
        **dict.fromkeys(
            ["record_counts", "record_counts_of_files"],
            " union all ".join(f"select '{t}' as table_name, count(*) as records from {t}" for t in TABLES),
        ),
        "table_counts": " union all ".join(
            [f"select '{t}' as table_name, count(*) as records, 'ok' as status from {t}" for t in TABLES]
            + ["select 'absent', null, 'missing'"]
        ),
        **dict.fromkeys(
            ["freshness", "freshness_of_files"],
            f"with {CHECKS} select status, reason, last_load, hours_old from checks where check_no = 1",
        ),
        "date_range": f"""with {CHECKS} select status, reason, min_date, max_date, distinct_dates
            from checks where check_no = 4""",
        "null_counts": f"""with {EM} select
            {", ".join(f"cast(sum(case when {c} is null then 1 else 0 end) as bigint) as null_{c}"
                       for c in "state_code county_name pct_diabetes pct_obesity pct_current_smoker".split())} from em""",
        **dict.fromkeys(["dq_report", "dq_report_by_load"], f"with {CHECKS} select *, cast(null as varchar) as error from checks"),
        "dq_report_flat": f"with {CHECKS} select * exclude (check_no), cast(null as varchar) as error from checks",
        "dq_summary": f"""with {CHECKS} select count(*) as total_checks,
            cast(sum(case when status = 'PASS' then 1 else 0 end) as bigint) as passed,
            cast(sum(case when status <> 'PASS' then 1 else 0 end) as bigint) as failed,
            case when sum(case when status <> 'PASS' then 1 else 0 end) = 0 then 'PASS' else 'FAIL' end as status
            from checks""",
        "contract_not_null": f"""with {EM}, f as (select
              cast(sum(case when state_code is null then 1 else 0 end) as bigint) as a,
              cast(sum(case when county_name is null then 1 else 0 end) as bigint) as b,
              cast(sum(case when pct_diabetes is null then 1 else 0 end) as bigint) as c from em)
            select 'staging' as model, 'state_code' as column_name, 'not_null' as rule, a as failures,
                   case when a = 0 then 'PASS' else 'FAIL' end as status from f
            union all select 'staging', 'county_name', 'not_null', b, case when b = 0 then 'PASS' else 'FAIL' end from f
            union all select 'staging', 'pct_diabetes', 'not_null', c, case when c = 0 then 'PASS' else 'FAIL' end from f""",
        "contract_accepted_values": f"""with {EM},
            o as (select cast(sum(case when o_orderstatus not in ('F', 'O') then 1 else 0 end) as bigint) as a from orders),
            m as (select cast(sum(case when s not in ('Valid', 'Incomplete Data', 'Small Population') then 1 else 0 end)
                  as bigint) as b from (select {STATUS} as s from em))
            select 'orders' as model, 'o_orderstatus' as column_name, 'accepted_values' as rule, a as failures,
                   case when a = 0 then 'PASS' else 'FAIL' end as status from o
            union all select 'mart', 'data_quality_status', 'accepted_values', b,
                   case when b = 0 then 'PASS' else 'FAIL' end from m""",
        "top_groups_by_metric": f"""with {EM} select state_code, cast(sum(total_population) as bigint) as total_population
            from em group by state_code order by 2 desc, 1 limit 20""",
        "top_groups_by_count": """select n_name as state_code, count(*) as count from customer
            join nation on c_nationkey = n_nationkey group by n_name order by 2 desc, 1 limit 20""",
        "metric_totals": f"select {_r2('sum(value)')} as total, {_r2('avg(value)')} as mean from events",
        "metric_fallback": f"""select 'total_cases' as metric, 'total_cases' as column_name, {_r2('sum(value)')} as figure from events
            union all select 'total_deaths', null, null
            union all select 'mean_rate', 'ili_percent', {_r2('avg(o_totalprice)')} from orders""",
        "source_fallback": "select * from customer",
        "latest_value": """select event_type, ts as latest_ts, value as latest_value from (
              select *, row_number() over (partition by event_type order by ts desc nulls last, event_id desc) as n
              from events) where n = 1""",
        "recent_rows": f"""select *, row_number() over (order by ts desc nulls last, event_id) as position
            from ({recent.format(10000)})""",
        "recent_rows_sample": recent.format(10),
        "series_by_date": "select ts, value from events",
        "series_positions": "select ts, value, row_number() over (order by ts, event_id) as position from events where user_id = 7",
    }
