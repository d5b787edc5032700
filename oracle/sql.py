"""The SQL that each registered query must agree with."""

from __future__ import annotations

from oracle.prelude import (
    clean_zip, crosswalk, display, implied, lit, n, norm, ratio, rnd, sql, sql_over, stripped, trim, zip_shape,
)
from plaintlens import defaults as D
from plaintlens.plans.queries import CATEGORY_PAIRS, GRAINS
from plaintlens.plans.rules import LISTED, REQUIRED, UNIQUE

ORACLE: dict[str, str] = {}


def oracle(**bodies: str) -> None:
    for name, body in bodies.items():
        ORACLE[name] = sql(body)


def era(date: str) -> str:
    return (f"case when {date} < date '1997-01-01' then 'pre_1997' "
            f"when {date} < date '1999-01-01' then '1997_1998' else '1999_plus' end")


def month(date: str, grain: str = "month") -> str:
    return f"cast(date_trunc('{grain}', {date}) as date)"


def declared() -> list[str]:
    """One row per declared test of a column."""
    tests = [(f"{m}.{c}.not_null", "error", f"select count(*) from {m} where {c} is null")
             for m, (_, columns) in REQUIRED.items() for c in columns]
    tests += [(f"{m}.{c}.not_null", "error", f"select count(*) from {m} where {c} is null and {where}")
              for m, c, where in (("bank_dim", "total_assets_usd", "fdic_top_holder is not null"),
                                  ("bank_dim", "bank_size_bucket", "fdic_top_holder is not null"),
                                  ("banks", "total_assets", "top_holder is not null"))]
    tests += [(f"{m}.{c}.unique", "error",
               f"select count(*) from (select {c} from {m} where {c} is not null group by 1 having count(*) > 1)")
              for m, columns in UNIQUE.items() for c in columns]
    tests += [(f"{m}.{c}.accepted", severity,
               f"select count(distinct {c}) from {m} where {where or 'true'} and {c} not in ({', '.join(map(lit, values))})")
              for m, c, values, where, severity in LISTED]
    tests += [(f"{m}.company_sk.{parent}", "error",
               f"select count(distinct company_sk) from {m} where company_sk not in (select company_sk from {parent})")
              for m, parent in (("fact", "companies"), ("monthly", "bank_dim"))]
    return [f"select '{name}', '{severity}', ({count})" for name, severity, count in tests]


# the feed after two upserts of later and amended complaints, 30 days back from the newest
UPSERTED = """
    late as (select * from feed where date_received > date '1997-12-31'),
    amended as (
        select * replace (
            case when cast(complaint_id as bigint) % 7 = 0 then date_received + 25 else date_received end as date_received,
            case when cast(complaint_id as bigint) % 5 = 0 then 'Nation 9 Holdings' else company_name end as company_name,
            case when cast(complaint_id as bigint) % 4 = 0 then 'Mortgage' else product end as product)
        from late where cast(complaint_id as bigint) % 3 = 0),
    again as (
        select * replace (false as timely_response, 'Nation 24 Holdings' as company_name)
        from amended where cast(complaint_id as bigint) % 2 = 0),
    loaded as (select * from feed where date_received <= date '1998-02-28'),
    recent as (
        select * from (
            select * exclude (version) from (select *, 1 as version from late union all select *, 2 from amended)
            qualify row_number() over (partition by complaint_id order by version desc) = 1)
        where date_received > (select max(date_received) - 30 from loaded)),
    once as (
        select * from loaded where complaint_id not in (select complaint_id from recent) union all select * from recent),
    newest as (select * from again where date_received > (select max(date_received) - 30 from once)),
    raw as (
        select * from once where complaint_id not in (select complaint_id from newest) union all select * from newest)"""
ORACLE["monthly_maintained"] = sql_over(UPSERTED, "select * from monthly")

# end products
oracle(
    bank_metrics="select * from bank_metrics",
    complaint_staging="select * from complaints",
    complaint_fact="select * from fact",
    company_dim="select * from companies",
    holder_rollup="select * from holders",
    bank_dim="select * from bank_dim",
    date_dim=f"""
        select date_day, cast(year(date_day) as int) as year, cast(quarter(date_day) as int) as quarter,
            cast(month(date_day) as int) as month_num, monthname(date_day) as month_name,
            cast(strftime(date_day, '%U') as int) as week_of_year, cast(dayofweek(date_day) + 1 as int) as day_of_week,
            dayname(date_day) as day_name, {month('date_day')} as first_day_of_month,
            {month('date_day', 'quarter')} as first_day_of_quarter, {month('date_day', 'year')} as first_day_of_year
        from spine""",
    time_spine="select date_day from spine",
    monthly_components="select * from monthly",
    complaints_read="select * from raw",
    banks_read="select * from raw_banks",
    seed_read="select * from raw_names",
    rollup_from_components=f"""
        select *, {ratio('timely_response_count', 'complaint_count')} as timely_response_rate,
            {ratio('routed_same_day_count', 'complaint_count')} as same_day_rate,
            {ratio('sum_days_to_company', 'complaint_count')} as avg_days_to_company,
            {ratio('disputed_count', 'complaint_count_dispute_era')} as dispute_rate,
            {ratio('narrative_count', 'complaint_count_narrative_era')} as narrative_rate
        from (select b.bank_size_bucket, f.product_category, {n('f.timely_response')} as timely_response_count,
                  count(*) as complaint_count, {n('f.days_to_company = 0')} as routed_same_day_count,
                  cast(sum(f.days_to_company) as bigint) as sum_days_to_company,
                  {n('f.is_dispute_era and f.consumer_disputed')} as disputed_count,
                  {n('f.is_dispute_era')} as complaint_count_dispute_era,
                  {n('f.is_narrative_era and f.has_narrative')} as narrative_count,
                  {n('f.is_narrative_era')} as complaint_count_narrative_era
              from fact f join bank_dim b using (company_sk) where b.total_assets_usd is not null group by all)""",
    tier_rollup=f"""
        select bank_size_bucket, count(*) as bank_count, cast(sum(complaint_count) as bigint) as complaint_count,
            cast(sum(cast(total_assets_billions as decimal(20, 1))) as double) as total_assets_billions,
            {ratio('sum(complaint_count)', 'sum(cast(total_assets_billions as decimal(20, 1)))', 2)}
                as complaints_per_billion_assets
        from bank_metrics group by bank_size_bucket""",
    category_comparison=f"""
        select category, count(*) as complaint_count,
            {ratio(n('timely_response'), 'count(*)', 4)} as timely_response_rate,
            {ratio(n('consumer_disputed and is_dispute_era'), n('is_dispute_era'), 4)} as dispute_rate,
            {ratio(n('has_narrative and is_narrative_era'), n('is_narrative_era'), 4)} as narrative_rate
        from fact group by category""",
    quarterly_category_feed=f"""
        select {month('date_received', 'quarter')} as quarter_start, product_category, count(*) as complaint_count
        from fact where product_category <> 'credit_reporting' group by all""",
    top20_by_category="""
        select canonical_name, category, count(*) as complaint_count from fact where is_crosswalked
        group by all order by complaint_count desc, canonical_name limit 20""",
)

# sources and staging
oracle(
    lean_table="select doc_id, lang, source, n_chars, lang <> 'de' and text is not null as has_text from documents",
    schema_listing="""
        select t.*, cast(case table_name when 'orders' then (select count(*) from orders)
                                         else (select count(*) from customer) end as bigint) as n_rows
        from (values ('customer', 1, 'c_custkey', 'bigint', true), ('customer', 2, 'c_name', 'string', true),
                     ('customer', 3, 'c_nationkey', 'int', true), ('customer', 4, 'c_acctbal', 'double', true),
                     ('customer', 5, 'c_mktsegment', 'string', true), ('orders', 1, 'o_orderkey', 'bigint', true),
                     ('orders', 2, 'o_custkey', 'bigint', true), ('orders', 3, 'o_orderstatus', 'string', true),
                     ('orders', 4, 'o_totalprice', 'double', true), ('orders', 5, 'o_orderdate', 'timestamp_ntz', true),
                     ('orders', 6, 'o_orderpriority', 'string', true))
             t(table_name, ordinal_position, column_name, data_type, is_nullable)""",
    bank_staging="select * from banks",
    crosswalk_staging=crosswalk("raw_names"),
)

# row-level cleaning
oracle(
    name_normalized=f"""
        select complaint_id, {trim('company_name')} as company_name, {norm('company_name')} as company_name_normalized,
            {norm('company_name', '.,;:')} as company_name_profiled
        from raw""",
    code_clean="select complaint_id, state from staged",
    zip_clean=f"""
        select r.complaint_id, s.zip_code, {clean_zip('r.zip_code', private=True)} as zip_code_private,
            coalesce(regexp_full_match(s.zip_code, '[0-9]{{5}}'), false) as zip_code_is_valid
        from raw r join staged s using (complaint_id)""",
    tag_flags="select complaint_id, tags, tags_is_servicemember, tags_is_older_american from staged",
    sentinels_relabel="""
        select complaint_id, company_response_to_consumer, company_public_response, consumer_consent_provided
        from staged""",
    display_name=f"select fdic_cert, top_holder, {display('top_holder')} as top_holder_normalized from banks",
    legal_suffix_strip=f"""
        select fdic_cert, {stripped('top_holder')} as holder_stripped,
            {stripped('institution_name')} as institution_stripped
        from banks""",
    regex_classify=f"""
        select p_partkey, firm, {implied('firm')} as implied_category
        from (select p_partkey, upper(concat_ws(' ', p_name, case p_size % 7 when 0 then 'Mortgage'
                  when 1 then 'Student Loan' when 2 then 'Recovery' when 3 then 'Toyota' when 4 then 'PayPal'
                  when 5 then 'Savings' else 'Trading' end, p_brand)) as firm from part)""",
    zip_pattern=f"select complaint_id, {zip_shape('zip_code')} as zip_pattern from staged",
)

# flags and buckets
oracle(
    era_flags="""
        select complaint_id, date_received, date_received < date '1998-04-24' as is_dispute_era,
            date_received >= date '1996-06-01' as is_narrative_era
        from raw""",
    lag_bucket="select complaint_id, days_to_company, days_to_company_bucket from fact",
    category_buckets="""
        select complaint_id, product_normalized, product_category, response_category, had_monetary_relief from fact""",
    asset_tier="""
        select top_holder, total_assets_usd, bank_size_bucket, bank_size_rank, offices_count, is_branchless
        from holders""",
    full_year_flag=f"select complaint_id, has_full_year_data, {era('date_received')} as analysis_era from staged",
)

# lookups
oracle(
    map_taxonomy="""
        select s.complaint_id, s.product, coalesce(m.product_normalized, s.product) as product_normalized
        from staged s left join product_map m on s.product = m.raw_product""",
    map_composite_null="select complaint_id, product, subproduct, subproduct_normalized from complaints",
    map_default="select complaint_id, issue, issue_category from complaints",
    map_override="select complaint_id, product, subproduct, product_normalized from complaints",
)

# entities
oracle(
    entity_resolve="""
        select complaint_id, company_name_normalized, canonical_name, category, company_parent_as_of, is_crosswalked,
            cast('0x' || substr(md5(canonical_name), 1, 15) as bigint) as company_sk
        from resolved""",
    entity_coverage=f"""
        select f.category, count(*) as complaint_count, {n('d.fdic_top_holder is not null')} as has_fdic,
            {ratio('count(*)', 'any_value(t.total)', 3)} as pct_of_total,
            {ratio(n('d.fdic_top_holder is not null'), 'count(*)', 3)} as fdic_fill_rate
        from fact f left join companies d using (company_sk), (select count(*) as total from fact) t
        group by f.category""",
    match_rate=f"""
        select count(*) as distinct_names, cast(sum(w) as bigint) as total_complaints,
            count(*) filter (where h) as matched_top_holder,
            cast(sum(case when h then w else 0 end) as bigint) as complaints_matched_top_holder,
            count(*) filter (where i) as matched_institution,
            cast(sum(case when i then w else 0 end) as bigint) as complaints_matched_institution,
            count(*) filter (where h or i) as matched_either,
            cast(sum(case when h or i then w else 0 end) as bigint) as complaints_matched_either
        from (select company_name, count(*) as w,
                  upper({trim('company_name')}) in (select upper({trim('top_holder')}) from banks where top_holder is not null) as h,
                  upper({trim('company_name')}) in (select upper({trim('institution_name')}) from banks where institution_name is not null) as i
              from raw where company_name is not null group by company_name)""",
    match_status="""
        select canonical_name, fdic_top_holder,
            case when fdic_top_holder in (select top_holder from banks where top_holder is not null)
                 then 'match' else 'no match' end as join_status
        from companies where category = 'bank'""",
    unmatched_top=f"""
        select company_name, count(*) as complaints from raw
        where company_name is not null
          and upper({trim('company_name')}) not in (select upper({trim('top_holder')}) from banks where top_holder is not null)
          and upper({trim('company_name')}) not in (select upper({trim('institution_name')}) from banks where institution_name is not null)
        group by all order by complaints desc, company_name limit 50""",
    suffix_match_report=f"""
        , wanted as (
            select canonical_name, fdic_top_holder || ', Inc.' as crosswalk_fdic_top_holder from companies
            where fdic_top_holder is not null),
        candidates as (
            select top_holder, sum(total_assets) as assets from banks where top_holder is not null group by all)
        select w.canonical_name, w.crosswalk_fdic_top_holder, c.top_holder as fdic_top_holder_matched,
            {rnd('c.assets / 1e9', 1)} as combined_assets_bn,
            {stripped('w.crosswalk_fdic_top_holder')} as cfpb_stripped,
            {stripped('c.top_holder')} as fdic_stripped,
            {stripped('w.crosswalk_fdic_top_holder')} = {stripped('c.top_holder')} as exact_strip_match
        from wanted w left join candidates c
            on {stripped('w.crosswalk_fdic_top_holder')} = {stripped('c.top_holder')}""",
    token_scan="""
        select top_holder, institution_name, cast(sum(total_assets) as bigint) as combined_assets,
            count(*) as charters
        from banks where upper(top_holder) like '%NATION 1%' or upper(institution_name) like '%NATION 1%'
        group by all order by combined_assets desc nulls last, top_holder nulls first, institution_name limit 20""",
    implied_composition=f"""
        select {implied('firm')} as implied_category, count(distinct firm) as distinct_companies,
            count(*) as complaint_count, {ratio('count(*)', 'sum(count(*)) over ()', 3)} as pct_of_uncrosswalked
        from (select concat_ws(' ', case l_suppkey % 7 when 0 then 'MORTGAGE' when 1 then 'STUDENT LOAN'
                  when 2 then 'COLLECTION' when 3 then 'HONDA' when 4 then 'VENMO' when 5 then 'SAVINGS'
                  else 'TRADING' end, l_suppkey) as firm from lineitem)
        group by 1""",
    name_union="""
        select upper(top_holder) as name from banks where top_holder is not null
        union select upper(institution_name) from banks""",
)

# metrics
def simple(measure: str, by: str, where: str = "true") -> str:
    return f"select {by}, {measure} from fact where {where} group by all"


oracle(
    metric_simple=simple("count(complaint_id) as complaint_count",
                         f"product_category, {month('date_received', 'quarter')} as period"),
    metric_timely_count=simple(n("timely_response") + " as timely_response_count", "submitted_via"),
    metric_disputed_count=simple(n("consumer_disputed") + " as disputed_count", "state"),
    metric_narrative_count=simple(n("has_narrative") + " as narrative_count",
                                  f"tags_is_servicemember, {month('date_received', 'year')} as period"),
    metric_avg_days=f"""
        select b.bank_size_bucket as company__bank_size_bucket, {month('f.date_received', 'year')} as period,
            {ratio('sum(f.days_to_company)', 'count(f.days_to_company)')} as avg_days_to_company
        from fact f left join bank_metrics b using (company_sk) group by all""",
    metric_total_assets="""
        select is_branchless as company__is_branchless,
            cast(sum(cast(total_assets_billions as decimal(20, 1))) as double) as total_assets_billions
        from bank_metrics group by all""",
    metric_ratio=f"""
        select category, {month('date_received')} as period,
            {ratio(n('timely_response'), 'count(*)')} as timely_response_rate
        from fact group by all""",
    metric_ratio_era=f"""
        select product_category, {ratio(n('consumer_disputed'), 'count(*)')} as dispute_rate
        from fact where is_dispute_era group by all""",
    metric_ratio_narrative=f"""
        select {month('date_received', 'quarter')} as period,
            {ratio(n('has_narrative'), 'count(*)')} as narrative_rate
        from fact where is_narrative_era group by all""",
    metric_mom=f""", counts as (
            select category, {month('date_received')} as period, count(*) as c from fact group by all)
        select a.category, a.period, {ratio('a.c - b.c', 'b.c')} as complaint_count_mom_pct_change
        from counts a left join counts b
            on a.category is not distinct from b.category and b.period = a.period - interval 1 month""",
    metric_yoy=f""", counts as (
            select {month('date_received', 'quarter')} as period, count(*) as c from fact group by all)
        select a.period, {ratio('a.c - b.c', 'b.c')} as complaint_count_yoy_pct_change
        from counts a left join counts b on b.period = a.period - interval 1 year""",
    metric_per_billion=f""", volumes as (
            select b.bank_size_bucket as k, count(*) as c from fact f left join bank_metrics b using (company_sk)
            group by all),
        assets as (
            select bank_size_bucket as k, sum(cast(total_assets_billions as decimal(20, 1))) as a
            from bank_metrics group by all)
        select coalesce(v.k, s.k) as company__bank_size_bucket, {ratio('v.c', 's.a')} as complaints_per_billion_assets
        from volumes v full join assets s on v.k is not distinct from s.k""",
    metric_per_billion_total=f"""
        select {ratio('(select count(*) from fact join bank_metrics using (company_sk))',
                      '(select sum(cast(total_assets_billions as decimal(20, 1))) from bank_metrics)')}
            as complaints_per_billion_assets""",
    metric_by_entity_dim="""
        select b.primary_specialization as company__primary_specialization, f.product_category,
            count(*) as complaint_count
        from fact f left join bank_metrics b using (company_sk) where f.has_full_year_data group by all""",
    metric_over_spine="""
        select s.date_day as period, c.complaint_count
        from spine s left join (
            select date_received, count(*) as complaint_count from fact group by all) c on s.date_day = c.date_received""",
    metric_over_spine_by="""
        , counted as (
            select state, product_category, cast(date_trunc('month', date_received) as date) as period,
                count(*) as complaint_count
            from fact group by all)
        select k.state, k.product_category, s.period, c.complaint_count
        from (select distinct state, product_category from counted) k
        cross join (select distinct cast(date_trunc('month', date_day) as date) as period from spine) s
        left join counted c on c.product_category is not distinct from k.product_category
            and c.state is not distinct from k.state and c.period = s.period""",
)

# checks
oracle(
    check_not_null="""
        select complaint_id, date_received from raw where date_sent_to_company is null and not timely_response""",
    check_unique="""
        select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by all having count(*) > 1""",
    check_accepted="""
        select submitted_via as value, count(*) as n_rows from staged
        where submitted_via not in ('Web', 'Phone', 'Referral', 'Postal mail', 'Fax', 'Email', 'Web Referral')
        group by all""",
    check_relationship="""
        select o_custkey, count(*) as n_rows from orders
        where o_custkey not in (select c_custkey from customer where c_mktsegment <> 'BUILDING') group by all""",
    check_dates_ordered="""
        select complaint_id, date_received, date_sent_to_company from raw
        where date_sent_to_company < date_received and date_received > date '1997-04-26'""",
    check_coverage=f"""
        select {ratio('100 * ' + n('is_crosswalked'), 'count(*)', 1)} as coverage_pct
        from resolved having coverage_pct < 95""",
    check_era_null="""
        select complaint_id, date_received, consumer_disputed from raw
        where not date_received < date '1998-04-24' and consumer_disputed is not null""",
    check_no_fanout="""
        select * from (
            select (select count(*) from staged) as staging_n,
                (select count(*) from staged s left join (
                     select * from crosswalk union all select * from crosswalk where parent_as_of is not null) x
                 on s.company_name_normalized = x.raw_company_name) as int_n)
        where staging_n <> int_n""",
    check_range="""
        select canonical_name, timely_response_rate, dispute_rate from bank_metrics
        where timely_response_rate < 0.32 or timely_response_rate > 0.67
           or dispute_rate < 0.32 or dispute_rate > 0.67""",
    check_coherence="""
        select canonical_name, month_start, product_category, complaint_count_dispute_era,
            coalesce(disputed_count, 0) as disputed_count, complaint_count_narrative_era, narrative_count
        from monthly where complaint_count_dispute_era = 0
            or (narrative_count is null) <> (complaint_count_narrative_era = 0)""",
    check_totals="""
        select * from (
            select (select cast(sum(complaint_count) as bigint) from monthly where product_category <> 'other')
                       as monthly_n,
                (select count(*) from fact join bank_dim using (company_sk) where total_assets_usd is not null)
                       as fct_n)
        where monthly_n is distinct from fct_n""",
    check_grain="""
        select canonical_name, product_category, count(*) as n_rows from monthly group by all having count(*) > 1""",
    check_summary="""
        , dates as (select cast(unnest(generate_series(date '1995-01-01', date '2001-12-31', interval 1 day)) as date) as date_day),
        failed as (
            select 'complaint_id_not_null' as name, 'error' as severity,
                (select count(*) from complaints where complaint_id is null) as n_failed
            union all select 'complaint_id_unique', 'error',
                (select count(*) from (select complaint_id from complaints group by 1 having count(*) > 1))
            union all select 'fact_company_exists', 'error',
                (select count(distinct company_sk) from fact
                 where company_sk not in (select company_sk from companies))
            union all select 'response_category_accepted', 'error',
                (select count(distinct response_category) from fact
                 where response_category not in ('relief', 'explanation_only', 'other'))
            union all select 'lag_bucket_accepted', 'error',
                (select count(distinct days_to_company_bucket) from fact
                 where days_to_company_bucket not in ('0_same_day', '1_to_3', '4_to_14', '15_plus'))
            union all select 'bank_tier_accepted', 'error',
                (select count(distinct bank_size_bucket) from bank_dim where fdic_top_holder is not null
                 and bank_size_bucket not in
                     ('mega (>$1T)', 'large ($400B-$1T)', 'mid ($175B-$400B)', 'smaller (<$175B)'))
            union all select 'dates_ordered', 'error',
                (select count(*) from complaints
                 where date_sent_to_company < date_received and date_received > date '1997-04-26')
            union all select 'crosswalk_coverage', 'error',
                (select cast(round(cast(avg(case when is_crosswalked then 100.0 else 0 end) as decimal(38, 12)), 1) < 74
                        as int) from resolved)
            union all select 'dispute_era_nulls', 'warn',
                (select count(*) from fact where not is_dispute_era and consumer_disputed is not null)
            union all select 'resolution_keeps_rows', 'error',
                cast((select count(*) from complaints) <> (select count(*) from resolved) as int)
            union all select 'bank_rates_in_range', 'error',
                (select count(*) from bank_metrics where not timely_response_rate between 0 and 1
                 or not dispute_rate between 0 and 1)
            union all select 'monthly_era_coherence', 'error',
                (select count(*) from monthly where (disputed_count is null) <> (complaint_count_dispute_era = 0)
                 or (narrative_count is null) <> (complaint_count_narrative_era = 0))
            union all select 'monthly_matches_fact', 'error',
                cast((select sum(complaint_count) from monthly) is distinct from
                     (select count(*) from fact join bank_dim using (company_sk)
                      where total_assets_usd is not null) as int)
            union all select 'monthly_grain', 'error',
                (select count(*) from (select 1 from monthly group by canonical_name, month_start, product_category
                                       having count(*) > 1))
            union all select 'one_current_parent', 'error',
                (select count(*) from (select canonical_name from crosswalk
                     where parent_as_of is null and fdic_top_holder is not null
                     group by 1 having count(distinct fdic_top_holder) > 1))
            union all """ + " union all ".join(declared()) + """)
        select name, severity, n_failed,
            case when n_failed = 0 then 'pass' when severity = 'warn' then 'warn' else 'fail' end as status
        from failed""",
)

# history
VERSIONS = """
    , first as (select * from customer where c_acctbal < 9000),
    second as (
        select c_custkey, case when c_mktsegment = 'HOUSEHOLD' then upper(c_name) else c_name end as c_name,
            c_nationkey, c_acctbal,
            case when c_mktsegment = 'MACHINERY' and c_nationkey < 5 then 'BUILDING'
                 when c_mktsegment = 'FURNITURE' and c_nationkey < 2 then null else c_mktsegment end as c_mktsegment
        from customer where c_acctbal > 0),
    versions as (
        select f.*, date '2020-01-01' as valid_from,
            case when s.c_custkey is not null and (f.c_mktsegment is distinct from s.c_mktsegment
                 or f.c_nationkey is distinct from s.c_nationkey) then date '2021-06-01' end as valid_to
        from first f left join second s on f.c_custkey = s.c_custkey
        union all
        select s.*, date '2021-06-01', null
        from second s left join first f on f.c_custkey = s.c_custkey
        where f.c_custkey is null or f.c_mktsegment is distinct from s.c_mktsegment
           or f.c_nationkey is distinct from s.c_nationkey)
    select *, coalesce(valid_to, valid_from) as updated_at,
        md5(c_custkey || '|' || valid_from || ' 00:00:00') as row_id
    from versions"""
oracle(
    scd2_merge=VERSIONS,
    scd2_as_of=VERSIONS + """
    where valid_from <= date '2020-12-31' and (valid_to is null or valid_to > date '2020-12-31')""",
    company_history=f"""
        , x as (select * from ({crosswalk('raw_names')})),
        feeds as (
            select *, case when category = 'fintech' then canonical_name || ' Digital' else canonical_name end as name_2,
                case when category = 'bank' then 'regional bank' else category end as category_2,
                case when parent_as_of is null then fdic_top_holder end as holder_3
            from x),
        changes as (
            select *, name_2 is distinct from canonical_name as at_2, holder_3 is distinct from fdic_top_holder as at_3
            from feeds),
        versions as (
            select raw_company_name, canonical_name, category, fdic_top_holder, parent_as_of, date '2020-01-01' as valid_from,
                case when at_2 then date '2021-01-01' when at_3 then date '2022-01-01' end as valid_to from changes
            union all
            select raw_company_name, name_2, category_2, fdic_top_holder, parent_as_of, date '2021-01-01',
                case when at_3 then date '2022-01-01' end from changes where at_2
            union all
            select raw_company_name, name_2, category_2, holder_3, parent_as_of, date '2022-01-01', null
            from changes where at_3)
        select *, coalesce(valid_to, valid_from) as updated_at,
            md5(raw_company_name || '|' || valid_from || ' 00:00:00') as row_id
        from versions""",
    as_of_join="""
        , numbered as (
            select raw_company_name, canonical_name, cast(regexp_extract(raw_company_name, '[0-9]+') as int) as k from crosswalk),
        listed(label, lo, hi, which) as (values
            ('first', date '1992-06-01', date '1996-07-01', 'thirds'), ('first', date '1992-06-01', null, 'others'),
            ('second', date '1996-07-01', date '1997-03-01', 'thirds'), ('third', date '1997-06-01', null, 'sixths'),
            ('side', date '1996-01-01', date '1997-12-31', 'sevenths')),
        versions as (
            select raw_company_name, canonical_name, label as version, lo, hi,
                lead(lo) over (partition by raw_company_name order by lo) as following
            from numbered, listed
            where case which when 'thirds' then k % 3 = 0 when 'others' then k % 3 <> 0
                             when 'sixths' then k % 6 = 0 else k % 7 = 0 end),
        named as (select complaint_id, date_received, company_name_normalized as raw_company_name from staged)
        select n.*, v.version, v.canonical_name
        from named n left join versions v on n.raw_company_name = v.raw_company_name and n.date_received >= v.lo
            and n.date_received < coalesce(least(v.hi, v.following), date '9999-01-01')""",
    known_rebrands=f"select * from ({crosswalk('raw_names')}) where parent_as_of is not null",
    upsert_lookback="""
        , e as (select event_id, cast(ts as date) as day, event_type, value, 1 as version from events),
        stored as (select event_id, day, value, version, null as event_type from e where day <= date '2024-01-20'),
        fresh as (
            select event_id, day, if(event_type = 'purchase', value * 2, value) as value,
                if(event_type = 'purchase', 2, 1) as version, event_type
            from e where day > date '2024-01-10' and day > (select max(day) - 7 from stored))
        select * from stored where event_id not in (select event_id from fresh)
        union all select * from fresh""",
    schema_append="""
        select event_id, cast(ts as date) as day, event_type, value,
            case when cast(ts as date) >= date '2024-01-15' then props end as props
        from events""",
    freshness="""
        select m as max_loaded_at, cast(date '2024-02-10' - m as int) as age_days,
            case when date '2024-02-10' - m > 14 then 'error' when date '2024-02-10' - m > 7 then 'warn'
                 else 'pass' end as status
        from (select max(cast(ts as date)) as m from events)""",
)

# profiling
RAW_COLUMNS = [
    "complaint_id", "date_received", "date_sent_to_company", "product", "subproduct", "issue", "subissue",
    "company_name", "state", "zip_code", "tags", "submitted_via", "company_response_to_consumer",
    "company_public_response", "timely_response", "consumer_disputed", "consumer_consent_provided", "has_narrative",
]
RESPONSES = ["company_response_to_consumer", "company_public_response", "consumer_consent_provided"]


def pareto(source: str, column: str, digits: tuple[int, int], order: str, limit: str = "") -> str:
    return f"""
        select rnk, {column}, n, cum_n, {ratio('100 * n', 'total', digits[0])} as pct,
            {ratio('100 * cum_n', 'total', digits[1])} as cum_pct
        from (select {column}, n, row_number() over (order by n desc, {order}) as rnk,
                  cast(sum(n) over (order by n desc, {order} rows unbounded preceding) as bigint) as cum_n,
                  sum(n) over () as total
              from (select {column}, count(*) as n from {source} group by all))
        {limit}"""


def lag_quantiles(kind: str) -> str:
    q = [f"quantile_{kind}(days, {p}) as {name}" for p, name in ((0.5, "p50"), (0.9, "p90"), (0.99, "p99"))]
    return f"""
        select {era('date_received')} as grp, count(*) as n, {n('days < 0')} as n_negative, {n('days = 0')} as n_zero,
            min(days) as min_days, max(days) as max_days, {ratio('sum(days)', 'count(days)')} as mean_days,
            {', '.join(q)}
        from (select date_received, cast(date_sent_to_company - date_received as int) as days
              from names where date_sent_to_company is not null)
        group by 1"""


oracle(
    shape="""
        select count(*) as total_rows, count(distinct company_name) as distinct_companies,
            count(distinct product) as distinct_products, count(distinct subproduct) as distinct_subproducts,
            count(distinct issue) as distinct_issues, count(distinct state) as distinct_states,
            count(*) filter (where has_narrative) as has_narrative, count(consumer_disputed) as has_disputed,
            count(date_sent_to_company) as has_sent_date, count(company_public_response) as has_public_response,
            count(tags) as has_tags, min(date_received) as min_date, max(date_received) as max_date
        from raw""",
    column_profile=" union all ".join(
        f"select '{c}' as column_name, count(*) as n_rows, count(*) - count({c}) as n_nulls, "
        f"count(distinct {c}) as n_distinct from raw" for c in RAW_COLUMNS),
    recent_sample="select * from raw order by date_received desc, complaint_id desc limit 20",
    distribution_pct=f"""
        select state, count(*) as n, min(date_received) as first_seen, max(date_received) as last_seen,
            {ratio('100 * count(*)', 'sum(count(*)) over ()', 2)} as pct
        from raw group by state""",
    source_distribution=f"""
        select source, count(*) as n, {ratio('100 * count(*)', 'sum(count(*)) over ()', 2)} as pct
        from documents group by source""",
    null_bucket_counts="""
        select 'tags' as field, coalesce(tags, '(null)') as value, count(*) as n from raw group by all""",
    multi_field_counts=" union all ".join(
        f"select '{c}' as field, {c} as value, count(*) as n from raw group by {c}" for c in RESPONSES),
    cooccurrence="""
        select tags, count(*) as n, count(*) filter (where tags like '%Servicemember%') as n_servicemember,
            count(*) filter (where tags like '%Older American%') as n_older_american,
            count(*) filter (where tags like '%Servicemember%' and tags like '%Older American%') as n_all
        from raw where tags is not null group by tags""",
    topk_entities="""
        select company_name, count(*) as complaints, count(distinct product) as products_touched,
            min(date_received) as first_seen, max(date_received) as last_seen
        from raw where company_name is not null group by company_name
        order by complaints desc, company_name limit 50""",
    entity_list="""
        select l_partkey, count(*) as complaints, count(distinct l_suppkey) as products_touched,
            cast(min(l_shipdate) as date) as first_seen, cast(max(l_shipdate) as date) as last_seen
        from lineitem group by l_partkey""",
    pareto=pareto("lineitem", "l_partkey", (2, 2), "md5(cast(l_partkey as varchar))"),
    pareto_issues=pareto("raw", "issue", (2, 2), "md5(issue)"),
    pareto_top=pareto("names", "company_name_normalized", (3, 2), "company_name_normalized", "where rnk <= 100"),
    size_histogram="""
        select case when c <= 1 then '1' when c <= 5 then '2-5' when c <= 20 then '6-20' when c <= 100 then '21-100'
                    when c <= 1000 then '101-1000' else '1001+' end as size_bucket,
            count(*) as company_count, cast(sum(c) as bigint) as total_complaints, min(c) as smallest
        from (select l_orderkey, count(*) as c from lineitem group by all) group by 1""",
    rate_by_entity=f"""
        select company_name_normalized, count(*) as n_complaints, {n('timely_response is null')} as n_null,
            {n('timely_response')} as n_true, {n('not timely_response')} as n_false,
            {ratio(n('timely_response'), 'count(timely_response)')} as rate
        from names group by all having count(*) >= 100 order by n_complaints desc, 1 limit 100""",
    yearly_fill=f"""
        select cast(year(date_received) as int) as period, count(*) as complaints,
            count(distinct company_name) as distinct_companies, count(consumer_disputed) as disputed_known,
            count(company_public_response) as public_response, {n('has_narrative')} as with_narrative,
            {ratio('count(consumer_disputed)', 'count(*)')} as disputed_known_rate,
            {ratio('count(company_public_response)', 'count(*)')} as public_response_rate,
            {ratio(n('has_narrative'), 'count(*)')} as with_narrative_rate
        from raw group by 1""",
    lag_quantiles=lag_quantiles("cont"),
    lag_quantiles_approx=lag_quantiles("disc"),
    crosstab="select product, subproduct, count(*) as complaints from raw group by all",
    crosstab_issues="select issue, subissue, count(*) as complaints from raw group by all",
    frequent_semi="""
        select l_partkey, l_returnflag, count(*) as complaints from lineitem
        where l_partkey in (select l_partkey from lineitem group by 1 having count(*) >= 30) group by all""",
    rate_by_year=f"""
        select cast(year(date_received) as int) as year, product, count(*) as n_complaints,
            {n('has_narrative is null')} as n_null, {n('has_narrative')} as n_true, {n('not has_narrative')} as n_false,
            {ratio(n('has_narrative'), 'count(has_narrative)')} as rate
        from raw where date_received between date '1996-06-01' and date '2000-12-31' group by 1, 2""",
    violations_by_size="""
        select cast(date_received - date_sent_to_company as int) as days_early, count(*) as complaints,
            min(date_received) as earliest, max(date_received) as latest
        from raw where date_sent_to_company < date_received group by 1""",
    violations_by_entity="""
        select cast(year(date_received) as int) as year, company_name_normalized, count(*) as violations,
            avg(date_received - date_sent_to_company) as avg_days_early
        from staged where date_sent_to_company < date_received group by 1, 2
        order by violations desc, year, company_name_normalized limit 30""",
    null_by_status="""
        select coalesce(company_response_to_consumer, '(null)') as status, count(*) as n_total,
            count(*) - count(date_sent_to_company) as n_null
        from raw group by 1 having n_null > 0 or status = 'In progress'""",
    zip_pattern_summary=f"select {zip_shape('zip_code')} as pattern, count(*) as n from staged group by 1",
    invalid_drill="""
        select zip_code, count(*) as n, cast(length(zip_code) as int) as length from staged
        where zip_code is not null and zip_code <> '' and not regexp_full_match(zip_code, '[0-9]{5}')
        group by zip_code order by n desc, zip_code limit 100""",
    residue_counts=f"""
        select v.legacy_value, count(m.complaint_id) as n
        from (values {', '.join('(' + lit(p) + ')' for p in D.LEGACY_PRODUCTS)}) v(legacy_value)
        left join (
            select s.complaint_id, coalesce(p.product_normalized, s.product) as product_normalized
            from staged s left join product_map p on s.product = p.raw_product and p.raw_product <> 'Payday loan') m
            on m.product_normalized = v.legacy_value
        group by all""",
    normalized_crosstab="""
        select product_normalized, subproduct_normalized, count(*) as complaints
        from complaints where product = 'Consumer Loan' group by all""",
    subproducts_per_product="""
        select product_normalized, count(distinct subproduct_normalized) as subproduct_count from fact group by all""",
    largest_institutions="""
        select institution_name, top_holder, fdic_cert, state, city, total_assets from banks
        order by total_assets desc nulls last, fdic_cert limit 50""",
    largest_parents="""
        select top_holder, count(*) as subsidiaries, cast(sum(total_assets) as bigint) as combined_assets
        from banks where top_holder is not null group by top_holder
        order by combined_assets desc nulls last, top_holder limit 50""",
    normalize_preview=f"""
        select top_holder as raw_top_holder, {display('top_holder')} as top_holder_normalized,
            count(*) as charter_count, cast(sum(total_assets) as bigint) as total_assets_thousands
        from banks where top_holder is not null group by top_holder
        order by total_assets_thousands desc nulls last, top_holder limit 30""",
    tier_preview=f"""
        select d.canonical_name, {rnd('f.assets / 1e6', 1)} as total_assets_billions, f.charter_count,
            f.is_supervised_cfpb, f.avg_roa,
            case when f.assets >= 250000000 then 'mega (>$250B)' when f.assets >= 50000000 then 'large ($50B-$250B)'
                 when f.assets >= 10000000 then 'mid ($10B-$50B)' when f.assets >= 1000000 then 'regional ($1B-$10B)'
                 else 'community (<$1B)' end as bank_size_bucket
        from companies d join (
            select top_holder, sum(total_assets) as assets, count(*) as charter_count,
                max(cfpb_supervisory_flag) as is_supervised_cfpb, {rnd('avg(return_on_assets)', 4)} as avg_roa
            from banks where top_holder is not null group by top_holder) f on d.fdic_top_holder = f.top_holder
        where d.category = 'bank'""",
)


# components that roll up, orders of all rows
MEASURED = f"""count(*) as complaint_count, {n('timely_response')} as timely_response_count,
    {n('days_to_company = 0')} as routed_same_day_count, cast(sum(days_to_company) as bigint) as sum_days_to_company,
    {n('is_dispute_era')} as complaint_count_dispute_era, {n('is_narrative_era')} as complaint_count_narrative_era,
    case when {n('is_dispute_era')} > 0 then {n('is_dispute_era and consumer_disputed')} end as disputed_count,
    case when {n('is_narrative_era')} > 0 then {n('is_narrative_era and has_narrative')} end as narrative_count"""


def one_grain(grain: str, kept: list[str]) -> str:
    """A single rollup with the columns of all."""
    period = "cast(null as date)" if grain == "all" else month("date_received", grain)
    dims = ", ".join(f"{d if d in kept else 'cast(null as varchar)'} as {d}, {str(d not in kept).lower()} as all_{d}"
                     for d in ("product_category", "category", "state"))
    keys = ", ".join([*([] if grain == "all" else [period]), *kept])
    return f"select '{grain}' as grain, {period} as period_start, {dims}, {MEASURED} from fact" + (f" group by {keys}" if keys else "")


def in_rank(p: int) -> str:
    return f"min(case when upto * 100 >= whole * {p} then days_to_company end) as p{p}_exact, true as p{p}_within"


def windows(order: str, value: str) -> str:
    return (f"rank() over o as rank, percent_rank() over o as percent_rank, cume_dist() over o as cume_dist, "
            f"cast(sum({value}) over (order by {order}) as bigint) as running_{value}")


oracle(
    many_grains=f"""
        , x as ({" union all ".join(one_grain(grain, kept) for grain, kept in GRAINS)})
        select *, {ratio('timely_response_count', 'complaint_count')} as timely_response_rate,
            {ratio('routed_same_day_count', 'complaint_count')} as same_day_rate,
            {ratio('sum_days_to_company', 'complaint_count')} as avg_days_to_company,
            {ratio('disputed_count', 'complaint_count_dispute_era')} as dispute_rate,
            {ratio('narrative_count', 'complaint_count_narrative_era')} as narrative_rate
        from x""",
    lag_rollup=f"""
        , x as (
            select bank_size_bucket, product_category, {month('date_received', 'quarter')} as quarter_start, days_to_company, count(*) as n
            from fact join bank_dim using (company_sk) where days_to_company is not null group by all),
        y as (
            select *, sum(n) over (g order by days_to_company) as upto, sum(n) over g as whole
            from x window g as (partition by bank_size_bucket, product_category, quarter_start))
        select bank_size_bucket, product_category, quarter_start, cast(any_value(whole) as bigint) as values_count,
            {in_rank(50)}, {in_rank(90)}, {in_rank(99)}
        from y group by all""",
    distinct_rollup=f"""
        select {month('date_received', 'quarter')} as quarter_start, product_category,
            count(distinct company_name_normalized) as distinct_count
        from fact group by all""",
    distinct_common=f"""
        , x as (select distinct product_category, company_name_normalized as name from fact where company_name_normalized is not null),
        asked as (select * from (values {', '.join(map(str, CATEGORY_PAIRS))}) as t (first, second))
        select first, second, count(*) filter (name in (select name from x where product_category = second)) as in_both,
            count(*) filter (name not in (select name from x where product_category = second)) as in_first_only
        from asked join x on product_category = first
        where second in (select product_category from x) group by all""",
    ranked_complaints=f"""
        , x as (select complaint_id, date_received, cast(date_sent_to_company - date_received as int) as days from raw)
        select *, {windows('days desc nulls last, date_received nulls first', 'days')}
        from x window o as (order by days desc nulls last, date_received nulls first)""",
    ranked_banks=f"""
        select fdic_certificate_number, offices_count, total_assets, {windows('offices_count nulls first', 'total_assets')}
        from raw_banks window o as (order by offices_count nulls first)""",
)
ORACLE["company_history_stored"] = ORACLE["company_history"]
