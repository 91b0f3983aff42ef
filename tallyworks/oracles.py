"""DuckDB twins of the registered queries, for checking results. Nothing here runs on Spark."""

from __future__ import annotations

VIEWS = {
    "ads_data": """
        select event_id, ad_id, user_id as client_union_id, user_id % 20 as campaign_union_id,
               ts as time, cast(ts as date) as date, event_type as event,
               case when event_id % 10 < 2 then 'web' when event_id % 10 < 5 then 'ios' else 'android' end as platform,
               case when ad_id % 2 = 0 then 'CPM' else 'CPC' end as ad_cost_type,
               cast(100 + (user_id % 8) * 25 as double) as ad_cost,
               (user_id + k % 10) % 3 = 0 as has_video,
               ad_id * 37 as target_audience_count
        from (select *, user_id * 10 + k % 10 as ad_id
              from (select *, cast(json_extract_string(props, '$.k') as int) as k from events)
              where event_type in ('view', 'click'))""",
    "ads_clients_data": """
        select c_custkey as client_union_id, date '2023-01-01' + cast(c_custkey % 300 as int) as create_date
        from customer""",
    "trips": """
        select *, trip_start_timestamp + to_seconds(trip_seconds) as trip_end_timestamp
        from (select l_orderkey, l_linenumber, l_partkey, l_suppkey, nullif(l_suppkey, 0) as taxi_id,
                     l_shipdate + to_minutes(cast((l_orderkey * 7 + l_linenumber * 131 + l_partkey) % 1440 as int))
                         as trip_start_timestamp,
                     cast(l_quantity * 60 + l_partkey % 60 as int) as trip_seconds,
                     l_quantity as trip_miles,
                     l_extendedprice * (1 - l_discount) as fare,
                     l_extendedprice * l_discount as tips,
                     l_extendedprice as trip_total,
                     case l_returnflag when 'R' then 'Cash' when 'A' then 'Credit Card' else 'Unknown' end
                         as payment_type
              from lineitem)""",
    "cars": """
        select s_suppkey as taxi_id, p_name as car_model from supplier join part on p_partkey = s_suppkey""",
    "employee": """
        select p_partkey as id, split_part(p_name, ' ', 1) as name, split_part(p_name, ' ', 2) as surname,
               p_retailprice as salary
        from part""",
    "company": "select n_nationkey as id, n_name as name from nation",
    "office": "select c_custkey as id, c_nationkey as company_id, c_mktsegment as country from customer",
    "passengers": """
        select o_orderkey as PassengerId,
               case when o_orderstatus = 'F' then 1 else 0 end as Survived,
               cast(substr(o_orderpriority, 1, 1) as int) as Pclass,
               'name' as Name,
               case when o_custkey % 2 = 0 then 'male' else 'female' end as Sex,
               case when o_orderkey % 5 = 0 then null else cast(o_custkey % 80 as double) end as Age,
               cast(o_orderkey % 4 as int) as SibSp,
               cast(o_custkey % 3 as int) as Parch,
               'ticket' as Ticket,
               o_totalprice / 1000 as Fare,
               'cabin' as Cabin,
               case when o_orderkey % 97 = 0 then null when o_orderkey % 7 < 4 then 'S'
                    when o_orderkey % 7 < 6 then 'C' else 'Q' end as Embarked
        from orders""",
    "per_ad": """
        select ad_id, count(*) as events, count(*) filter (event = 'view') as views,
               count(*) filter (event = 'click') as clicks
        from ads_data group by ad_id""",
    "ctr_ranked": """
        select ctr, row_number() over (order by ctr) as position, count(*) over () as n
        from (select cast(clicks as double) / views as ctr from per_ad where views <> 0)""",
    "ad_days": """
        select ad_id, date, count(event) as all_events, count(*) filter (event = 'view') as views,
               count(*) filter (event = 'click') as clicks
        from ads_data group by ad_id, date""",
    "ad_rows": """
        select *, cast(ad_cost_type = 'CPM' as int) as is_cpm, cast(ad_cost_type = 'CPC' as int) as is_cpc
        from ads_data""",
    "features": """
        select ad_id, target_audience_count, has_video, is_cpm, is_cpc, ad_cost,
               count(distinct date) filter (event = 'view') as day_count,
               cast(count(*) filter (event = 'click') as double)
                   / nullif(count(*) filter (event = 'view'), 0) as ctr
        from ad_rows group by all""",
    "prepared": """
        select Survived, Pclass, Sex,
               coalesce(Age, (select round_even(avg(Age), 0) from passengers)) as Age,
               SibSp, Parch, Fare, coalesce(Embarked, 'S') as Embarked, SibSp + Parch as Family_Size,
               case when SibSp + Parch = 0 then 1 else 0 end as Alone
        from passengers""",
    "sex_index": """
        select Sex, cast(row_number() over (order by count(*) desc, Sex) - 1 as double) as Sex_index
        from prepared group by Sex""",
    "embarked_index": """
        select Embarked, cast(row_number() over (order by count(*) desc, Embarked) - 1 as double) as Embarked_index
        from prepared group by Embarked""",
}

NEEDS = {
    "per_ad": ["ads_data"],
    "ctr_ranked": ["ads_data", "per_ad"],
    "ad_days": ["ads_data"],
    "ad_rows": ["ads_data"],
    "features": ["ads_data", "ad_rows"],
    "prepared": ["passengers"],
    "sex_index": ["passengers", "prepared"],
    "embarked_index": ["passengers", "prepared"],
}


def on(views: str, body: str) -> str:
    """The query text, preceded by the views it names."""
    names: list[str] = []
    for view in views.split():
        names += [name for name in [*NEEDS.get(view, []), view] if name not in names]
    prefix = ",\n".join(f"{name} as ({VIEWS[name]})" for name in names)
    return f"with {prefix}\n{body}" if names else body


def employees_where(condition: str) -> str:
    return on("employee", f"select count(*) as rows from employee where {condition}")


PASSENGER_COLUMNS = {
    "PassengerId": "bigint",
    "Survived": "int",
    "Pclass": "int",
    "Name": "string",
    "Sex": "string",
    "Age": "double",
    "SibSp": "int",
    "Parch": "int",
    "Ticket": "string",
    "Fare": "double",
    "Cabin": "string",
    "Embarked": "string",
}

LABELLED = "select count(ctr) as n from features"
HELD_OUT = "select count(*) as n from passengers where (PassengerId % 100 * 7919) % 100 >= 80"
JOINT_GRID = """
    select 'LinearRegression' as family, 'elasticNetParam=0.8, maxIter=40, regParam=0.4' as params
    union all
    select 'GBTRegressor', format('maxBins={}, maxDepth={}, maxIter={}', bins, depth, iterations)
    from (values (32), (33)) as b(bins), (values (5), (6), (7)) as d(depth), (values (4), (5), (6), (7)) as i(iterations)
    union all
    select 'RandomForestRegressor', format('featureSubsetStrategy={}, maxDepth={}, numTrees={}', subset, depth, trees)
    from (values ('onethird'), ('0.5'), ('sqrt')) as f(subset), (values (2), (3), (4), (5)) as d(depth),
         (values (19), (20), (21)) as t(trees)
    union all
    select 'DecisionTreeRegressor', format('maxBins={}, maxDepth={}, minInfoGain={}', bins, depth, gain)
    from (values (28), (32), (33)) as b(bins), (values (4), (5), (6)) as d(depth), (values ('0.0'), ('0.1'), ('0.2')) as g(gain)"""

SPIKE = "date '2024-01-05'"

SOURCES = {
    "scan_parquet": "select count(*) as rows from lineitem",
    "csv_header_scan": on("passengers", "select * from passengers"),
    "csv_infer_scan": on("passengers", "select * replace (cast(PassengerId as int) as PassengerId) from passengers"),
    "csv_roundtrip": on(
        "trips",
        """
        select column_name, written_type, read_type,
               case when column_name = 'taxi_id' then known else total end as non_null
        from (values ('l_orderkey', 'bigint', 'int'), ('l_linenumber', 'int', 'int'),
                     ('l_partkey', 'bigint', 'int'), ('l_suppkey', 'bigint', 'int'), ('taxi_id', 'bigint', 'int'),
                     ('trip_start_timestamp', 'timestamp_ntz', 'timestamp'),
                     ('trip_end_timestamp', 'timestamp_ntz', 'timestamp'),
                     ('trip_seconds', 'int', 'int'), ('trip_miles', 'double', 'double'),
                     ('fare', 'double', 'double'), ('tips', 'double', 'double'),
                     ('trip_total', 'double', 'double'), ('payment_type', 'string', 'string'))
             as t(column_name, written_type, read_type),
             (select count(*) as total, count(taxi_id) as known from trips)""",
    ),
    "json_roundtrip": on("employee", "select * from employee"),
    "parquet_roundtrip": on("employee", "select * from employee"),
    "text_roundtrip": """
        select count(*) as rows, min(o_orderkey) as lowest, max(o_orderkey) as highest,
               cast(sum(o_orderkey) as varchar) as total
        from orders""",
    "table_scan": on("employee", "select * from employee"),
    "sql_view_filter": on("employee", "select name from employee where id <= 2"),
    "range_filter_sum": """
        select cast(sum(o_orderkey + 100) as varchar) as total from orders
        where power(cast(o_orderkey as double), 2) > 1000""",
    "union_count": """
        select count(*) as rows from (select o_orderkey from orders union all select o_orderkey from orders)""",
    "repartition_report": """
        select cast(4 as bigint) as partitions, count(*) as rows, true as even from orders""",
    "tuples_source": """
        select status, count(*) as orders
        from orders join (values ('F', 'finished'), ('O', 'open'), ('P', 'pending')) as t(code, status)
          on o_orderstatus = code
        group by status""",
    "pandas_batches": on("employee", "select id, name, id * 10 as age from employee"),
    "labelled_union": """
        select vec_id, label as kind, cast(len(embedding) as int) as length from embeddings where label in (0, 1)""",
    "partition_count": on("ads_data", "select count(distinct date) as partitions, count(*) as rows from ads_data"),
    "first_rows": on("employee", "select id, name, surname from employee order by id limit 10"),
    "column_profile": on(
        "passengers",
        "\nunion all\n".join(
            f"""
            select {position}::int as position, '{name}' as column_name, '{kind}' as data_type, count(*) as rows,
                   count({name}) as non_null, count(distinct {name}) as distinct_values
            from passengers"""
            for position, (name, kind) in enumerate(PASSENGER_COLUMNS.items(), start=1)
        ),
    ),
}

STAFF = {
    "project_cols": on("employee", "select id, name, surname from employee"),
    "concat_names": on("employee", "select id, name || ' ' || surname as fio from employee"),
    "first_char": on("employee", "select id, name, substr(name, 1, 1) as name_alias from employee"),
    "row_count": employees_where("true"),
    "salary_summary": on(
        "employee",
        """
        select count(*) as employees, max(salary) as max_salary, min(salary) as min_salary,
               round(avg(salary), 6) as avg_salary
        from employee""",
    ),
    "filter_gt": employees_where("salary > 910"),
    "filter_and": employees_where("salary > 910 and salary < 950"),
    "filter_or": employees_where("salary >= 950 or salary <= 910"),
    "filter_eq": employees_where("name = 'red'"),
    "filter_in": employees_where("name in ('red', 'blue', 'new')"),
    "filter_like": employees_where("name like 'b%'"),
    "filter_like_len": employees_where("name like 'b___'"),
    "filter_length": employees_where("length(name) = 4"),
    "count_by_name": on(
        "employee", "select name, count(name) as employees from employee where length(name) > 3 group by name"
    ),
    "having_count": on(
        "employee",
        """
        select name, count(name) as employees from employee where length(name) > 3
        group by name having count(name) >= 150 order by employees desc, name""",
    ),
    "top3_names": on(
        "employee",
        "select name, count(name) as employees from employee group by name order by employees desc, name limit 3",
    ),
    "office_company": on(
        "office company", "select c.name, o.country from office o join company c on o.company_id = c.id"
    ),
    "office_company_distinct": on(
        "office company",
        """
        select distinct c.name, o.country from office o join company c on o.company_id = c.id
        order by name, country""",
    ),
    "above_avg_salary": on(
        "employee", "select name, surname from employee where salary > (select avg(salary) from employee)"
    ),
}

ADS = {
    "daily_stats": on(
        "ads_data",
        """
        select date, count(event) as all_events, count(*) filter (event = 'view') as views,
               count(*) filter (event = 'click') as clicks, count(distinct ad_id) as unique_ads,
               count(distinct campaign_union_id) as unique_campaigns
        from ads_data group by date""",
    ),
    "daily_event_mix": on(
        "ads_data",
        """
        select date, count(event) as all_events, count(*) filter (event = 'view') as views,
               count(*) filter (event = 'click') as clicks
        from ads_data group by date order by date""",
    ),
    "daily_revenue": on(
        "ads_data",
        """
        select date, round(cpc, 6) as cpc, round(cpm, 6) as cpm, round(cpc + cpm, 6) as revenue
        from (select date,
                     sum(case when ad_cost_type = 'CPC' and event = 'click' then ad_cost else 0 end) as cpc,
                     sum(case when ad_cost_type = 'CPM' and event = 'view' then ad_cost / 1000 else 0 end) as cpm
              from ads_data group by date)""",
    ),
    "date_keys": on(
        "ads_data",
        "select cast(strftime(date, '%Y%m%d') as int) as date_key, count(event) as all_events from ads_data group by 1",
    ),
    "ad_day_stats": on("ad_days", "select * from ad_days order by ad_id desc, date"),
    "ads_active_on_day": on(
        "ad_days", f"select * from ad_days where ad_id in (select ad_id from ads_data where date = {SPIKE})"
    ),
    "spike_ads_ranked": on(
        "ads_data",
        f"""
        select ad_id, count(event) as all_events_count from ads_data
        where ad_id in (select ad_id from ads_data where date = {SPIKE})
        group by ad_id order by all_events_count desc""",
    ),
    "top5_ads_daily": on(
        "ad_days",
        f"""
        select * from ad_days
        where ad_id in (select ad_id from ads_data
                        where ad_id in (select ad_id from ads_data where date = {SPIKE})
                        group by ad_id order by count(event) desc, ad_id limit 5)
        order by ad_id desc, date""",
    ),
    "spike_diagnosis": on(
        "ad_days",
        f"""
        select count(*) as ads,
               cast(count(*) filter (peak) * 100 as double) / count(*) as perc_peak_on_day,
               cast(count(*) filter (first) * 100 as double) / count(*) as perc_first_on_day,
               cast(count(*) filter (peak and first) * 100 as double) / count(*) as perc_first_and_peak
        from (select ad_id, max(all_events) = max(case when date = {SPIKE} then all_events end) as peak,
                     min(date) = {SPIKE} as first
              from ad_days where ad_id in (select ad_id from ads_data where date = {SPIKE}) group by ad_id)""",
    ),
    "ad_peak_day": on(
        "ad_days",
        f"""
        select ad_id, cast(position as int) as day_index, most as max_events_in_day,
               cast(all_events = most as int) as peak_on_day, cast(position = 1 as int) as first_on_day
        from (select *, row_number() over (partition by ad_id order by date) as position,
                     max(all_events) over (partition by ad_id) as most
              from ad_days)
        where date = {SPIKE}""",
    ),
    "array_ops": on(
        "ad_days",
        f"""
        select ad_id, cast(len(days) as int) as days, days[1] as first_key, days[2] as second_key,
               cast(coalesce(list_position(days, 20240105), 0) as int) as index_of_day,
               list_max(events) as max_events, cast(list_sum(events) as bigint) as all_events,
               case when list_min(events) = list_max(events) then 1 else 2 end as distinct_low_high
        from (select ad_id, list(cast(strftime(date, '%Y%m%d') as int) order by date) as days,
                     list(all_events order by date) as events
              from ad_days group by ad_id)""",
    ),
    "ctr_by_ad": on(
        "per_ad", "select ad_id, views, clicks, cast(clicks as double) / views as ctr from per_ad where views <> 0"
    ),
    "top10_ctr": on(
        "per_ad",
        """
        select ad_id, views, clicks, cast(clicks as double) / views as ctr from per_ad where views <> 0
        order by ctr desc, ad_id limit 10""",
    ),
    "ctr_by_video": on(
        "ads_data",
        """
        select has_video, count(*) filter (event = 'view') as views, count(*) filter (event = 'click') as clicks,
               cast(count(*) filter (event = 'click') as double) / count(*) filter (event = 'view') as ctr
        from ads_data group by has_video having count(*) filter (event = 'view') <> 0""",
    ),
    "ctr_median_avg": on(
        "ctr_ranked",
        """
        select max(case when position = least(floor(cast(0.5 as double) * n) + 1, n) then ctr end) as median_ctr,
               quantile_disc(ctr, 0.5) as median_ctr_discrete,
               round(avg(ctr), 9) as avg_ctr
        from ctr_ranked""",
    ),
    "ctr_p95": on(
        "ads_data",
        f"""
        select n as ads, ctr as ctr_p95
        from (select ctr, row_number() over (order by ctr) as position, count(*) over () as n
              from (select cast(count(*) filter (event = 'click') as double)
                               / count(*) filter (event = 'view') as ctr
                    from ads_data where date = {SPIKE}
                    group by ad_id having count(*) filter (event = 'view') <> 0))
        where position = least(floor(cast(0.95 as double) * n) + 1, n)""",
    ),
    "platform_view_share": on(
        "ads_data",
        """
        select platform, count(*) filter (event = 'view') as platform_views,
               cast(count(*) filter (event = 'view') * 100 as double)
                   / (select count(*) from ads_data where event = 'view') as perc
        from ads_data group by platform order by platform_views desc, platform""",
    ),
    "platform_sets": on(
        "ads_data",
        """
        select platforms, count(*) as ads, total as sum_ads, cast(count(*) as double) / total * 100 as perc_ads
        from (select ad_id, string_agg(distinct platform, ',' order by platform) as platforms
              from ads_data where event = 'view' group by ad_id),
             (select count(distinct ad_id) as total from ads_data)
        group by platforms, total""",
    ),
    "android_views": on(
        "ads_data", "select count(event) as views from ads_data where platform = 'android' and event = 'view'"
    ),
    "mobile_views": on(
        "ads_data",
        """
        select count(*) filter (platform = 'android') as android_views, count(*) filter (platform = 'ios') as ios_views,
               count(*) filter (platform in ('android', 'ios')) as mobile_views
        from ads_data where event = 'view'""",
    ),
    "distinct_platforms": on("ads_data", "select count(distinct platform) as platforms from ads_data"),
    "max_platforms_per_ad": on(
        "ads_data",
        """
        select max(n) as max_platforms
        from (select count(distinct platform) as n from ads_data where event = 'view' group by ad_id)""",
    ),
    "clicked_never_viewed": on("per_ad", "select count(ad_id) as ads from per_ad where views = 0 and clicks <> 0"),
    "orphan_click_platforms": on(
        "per_ad",
        """
        select count(*) filter (platform = 'android') as androids, count(*) filter (platform = 'ios') as ios,
               count(*) filter (platform = 'web') as web
        from ads_data where ad_id in (select ad_id from per_ad where views = 0 and clicks <> 0)""",
    ),
    "orphan_click_platforms_all": on(
        "per_ad",
        """
        select count(*) filter (platform = 'android') as androids, count(*) filter (platform = 'ios') as ios,
               count(*) filter (platform = 'web') as web
        from ads_data where ad_id in (select ad_id from per_ad where views = 0 and clicks <> 0)""",
    ),
    "click_first_ads": on(
        "ads_data",
        """
        select count(distinct ad_id) as ads
        from (select ad_id, row_number() over (partition by ad_id, platform
                                               order by time, event = 'click', event_id) as position, event
              from ads_data)
        where position = 1 and event = 'click'""",
    ),
    "approx_click_first": on(
        "ads_data",
        """
        select count(distinct ad_id) as ads, false as outside_bound
        from (select ad_id, row_number() over (partition by ad_id, platform
                                               order by time, event = 'click', event_id) as position, event
              from ads_data)
        where position = 1 and event = 'click'""",
    ),
    "daily_ads_sketches": on(
        "ads_data", "select date, count(distinct ad_id) as ads, false as outside_bound from ads_data group by date"
    ),
    "merged_ads_sketches": on(
        "ads_data",
        "select count(distinct ad_id) as ads, false as outside_bound, false as other_than_whole from ads_data",
    ),
    "trailing_ads_sketches": on(
        "ads_data",
        """
        select day, count(distinct ad_id) as ads, false as outside_bound
        from (select distinct date as day from ads_data)
        join ads_data on date between day - interval 6 day and day
        group by day""",
    ),
    "late_click_count": on(
        "ads_data",
        """
        select count(*) filter (late and event <> previous) as late_changes,
               count(*) filter (late and event = 'click' and previous = 'view') as late_clicks_after_view
        from (select event, lag(event) over rows as previous, time > lag(time) over rows + interval 1 hour as late
              from ads_data
              window rows as (partition by ad_id order by time, event = 'click', event_id))""",
    ),
    "clients_without_ads": on(
        "ads_data ads_clients_data",
        """
        select * from ads_clients_data c
        where not exists (select 1 from ads_data a where a.client_union_id = c.client_union_id)""",
    ),
    "never_active_share": on(
        "ads_data ads_clients_data",
        """
        select total, never, oldest, earliest_client, round(cast(never * 100 as double) / total, 0) as part
        from (select count(distinct client_union_id) as total, min(create_date) as earliest_client
              from ads_clients_data),
             (select count(client_union_id) as never, min(create_date) as oldest from ads_clients_data c
              where not exists (select 1 from ads_data a where a.client_union_id = c.client_union_id))""",
    ),
    "ad_gap_rows": on(
        "ads_data ads_clients_data",
        """
        select created, diff, count(*) as events
        from (select c.create_date as created,
                     cast(abs(date_diff('day', c.create_date, cast(a.time as date))) as int) as diff
              from ads_clients_data c join ads_data a on c.client_union_id = a.client_union_id)
        group by created, diff""",
    ),
    "first_ad_gap": on(
        "ads_data ads_clients_data",
        """
        select cast(min(diff) as int) as min_diff, round(avg(diff), 0) as avg_diff, cast(max(diff) as int) as max_diff
        from (select abs(date_diff('day', c.create_date, cast(min(a.time) as date))) as diff
              from ads_clients_data c join ads_data a on c.client_union_id = a.client_union_id
              group by c.client_union_id, c.create_date)""",
    ),
    "cost_type_onehot": on("ad_rows", "select event_id, is_cpm, is_cpc from ad_rows"),
    "rename_agg": on(
        "ads_data", "select ad_id, count(distinct date) as days_count from ads_data where event = 'view' group by ad_id"
    ),
    "view_days_per_ad": on(
        "ads_data",
        "select ad_id, count(distinct case when event = 'view' then date end) as day_count from ads_data group by ad_id",
    ),
    "ad_features": on("features", "select * from features"),
    "ad_features_event_grain": on(
        "features",
        """
        select r.ad_id, r.target_audience_count, r.has_video, r.is_cpm, r.is_cpc, r.ad_cost, f.day_count, f.ctr
        from ad_rows r left join features f on r.ad_id = f.ad_id""",
    ),
    "ad_features_two_joins": on(
        "features",
        """
        select r.ad_id, r.target_audience_count, r.has_video, r.is_cpm, r.is_cpc, r.ad_cost,
               d.days_count, f.ctr
        from ad_rows r
        left join (select ad_id, count(distinct date) as days_count from ads_data where event = 'view' group by ad_id) d
          on r.ad_id = d.ad_id
        left join features f on r.ad_id = f.ad_id""",
    ),
}
SOURCES["csv_one_file"] = ADS["platform_view_share"]
ADS["ad_features_bucketed"] = ADS["ad_features_event_grain"]

TAXI = {
    "miles_total_corr": on("trips", "select round(corr(trip_miles, trip_total), 5) as corr from trips"),
    "miles_total_cov": on("trips", "select round(covar_samp(trip_miles, trip_total), 5) as cov from trips"),
    "describe_trips": on(
        "trips",
        """
        select 'trip_miles' as column, count(trip_miles) as count, round(avg(trip_miles), 1) as mean,
               round(stddev_samp(trip_miles), 1) as stddev, min(trip_miles) as min, max(trip_miles) as max from trips
        union all
        select 'trip_total', count(trip_total), round(avg(trip_total), 1), round(stddev_samp(trip_total), 1),
               min(trip_total), max(trip_total) from trips""",
    ),
    "describe_passengers": on(
        "passengers",
        "\nunion all\n".join(
            f"""
            select '{name}' as column, count({name}) as count,
                   {f"round(avg({name}), 6)" if number else "null::double"} as mean,
                   {f"round(stddev_samp({name}), 6)" if number else "null::double"} as stddev,
                   {f"min({name})::double" if number else "null::double"} as min_number,
                   {f"max({name})::double" if number else "null::double"} as max_number,
                   {"null::varchar" if number else f"min({name})"} as min_text,
                   {"null::varchar" if number else f"max({name})"} as max_text
            from passengers"""
            for name, number in (("Sex", False), ("Age", True), ("Fare", True), ("Embarked", False), ("Pclass", True))
        ),
    ),
    "least_common_payment": on(
        "trips",
        "select payment_type, count(*) as trips from trips group by payment_type order by trips, payment_type limit 1",
    ),
    "busiest_taxi": on(
        "trips",
        "select taxi_id, count(*) as trips from trips group by taxi_id order by trips desc, taxi_id nulls last limit 1",
    ),
    "cash_avg": on("trips", "select round(avg(trip_total), 5) as avg_rounded from trips where payment_type = 'Cash'"),
    "taxis_over_miles": on(
        "trips",
        """
        select count(*) as taxis from (select taxi_id from trips group by taxi_id having sum(trip_miles) > 15000)""",
    ),
    "longest_trip_miles": on(
        "trips",
        """
        select trip_seconds, round(trip_miles, 0) as trip_miles from trips
        order by trip_seconds desc, l_orderkey, l_linenumber, l_partkey, l_suppkey limit 3""",
    ),
    "avg_taxi_income": on(
        "trips",
        """
        select round(avg(income), 5) as avg_income
        from (select sum(trip_total) as income from trips where taxi_id is not null group by taxi_id)""",
    ),
    "trips_by_hour": on(
        "trips",
        """
        select cast(hour(trip_start_timestamp) as int) as hour, count(*) as trips from trips group by 1
        order by trips desc, hour""",
    ),
    "trips_by_local_hour": on(
        "trips",
        """
        select cast(hour(trip_start_timestamp + interval 3 hour) as int) as hour, count(*) as trips from trips
        group by 1 order by trips desc, hour""",
    ),
    "second_quarter_trips": on(
        "trips",
        """
        select count(*) as trips from trips where hour(trip_start_timestamp) >= 6 and hour(trip_start_timestamp) < 12""",
    ),
    "top_tip_dates": on(
        "trips",
        """
        select cast(trip_start_timestamp as date) as date, round(sum(tips), 4) as tips from trips group by 1
        order by tips desc, date limit 5""",
    ),
    "top_trip_dates": on(
        "trips",
        """
        select cast(trip_start_timestamp as date) as date, count(*) as trips from trips group by 1
        order by trips desc, date limit 5""",
    ),
    "top_car_brand": on(
        "cars",
        """
        select split_part(car_model, ' ', 1) as brand, count(*) as cars from cars group by 1
        order by cars desc, brand limit 5""",
    ),
    "top_car_model_trips": on(
        "trips cars",
        """
        select car_model, count(*) as trips from trips t join cars c on t.taxi_id = c.taxi_id group by car_model
        order by trips desc, car_model limit 5""",
    ),
    "taxi_active_span": on(
        "trips",
        """
        select taxi_id, min(trip_start_timestamp) as first_trip, max(trip_start_timestamp) as last_trip
        from trips group by taxi_id""",
    ),
    "filter_not_null": on("trips", "select count(*) as trips from trips where taxi_id is not null"),
}

PASSENGERS = {
    "family_size": on(
        "passengers",
        "select PassengerId, SibSp + Parch + 1 as FamilySize, SibSp + Parch as Family_Size from passengers",
    ),
    "alone_flag": on(
        "passengers",
        """
        select PassengerId, SibSp + Parch as Family_Size, case when SibSp + Parch = 0 then 1 else 0 end as Alone
        from passengers""",
    ),
    "sex_flags": on("passengers", "select PassengerId, Sex = 'male' as M, Sex = 'female' as W from passengers"),
    "drop_cols": on("passengers", "select * exclude (Ticket, Name, Fare, Cabin) from passengers"),
    "fill_constant": on("passengers", "select PassengerId, coalesce(Embarked, 'S') as Embarked from passengers"),
    "fill_mean": on(
        "passengers", "select PassengerId, coalesce(Age, (select avg(Age) from passengers)) as Age from passengers"
    ),
    "fill_mean_rounded": on(
        "passengers",
        """
        select PassengerId, coalesce(Age, (select round_even(avg(Age), 0) from passengers)) as Age from passengers""",
    ),
    "filter_null": on("passengers", "select count(*) as passengers from passengers where Age is null"),
    "distinct_sex": on("passengers", "select distinct Sex from passengers"),
    "survival_counts": on("passengers", "select Survived, count(*) as passengers from passengers group by Survived"),
    "clean_passengers": on(
        "passengers",
        """
        select PassengerId, Survived, Pclass, coalesce(Age, (select avg(Age) from passengers)) as Age, SibSp, Parch,
               Embarked, SibSp + Parch + 1 as FamilySize, Sex = 'male' as M, Sex = 'female' as W
        from passengers""",
    ),
    "passenger_features": on(
        "sex_index embarked_index",
        """
        select p.* exclude (Sex, Embarked), Sex_index, Embarked_index
        from prepared p join sex_index s on p.Sex = s.Sex join embarked_index e on p.Embarked = e.Embarked""",
    ),
    "category_index": on(
        "sex_index embarked_index",
        """
        select p.Sex, p.Embarked, Sex_index, Embarked_index, count(*) as passengers
        from prepared p join sex_index s on p.Sex = s.Sex join embarked_index e on p.Embarked = e.Embarked
        group by all""",
    ),
}

FLOWS = {
    "word_count": r"""
        select word, count(*) as n
        from (select unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) as word from documents)
        where word <> '' group by word""",
    "calc_chain": "select event_id, value * 25 + 5 as x from events",
    "calc_fanout": "select event_id, value * 25 + 5 as plus_5, value * 25 + 10 as plus_10 from events",
    "train_test_split": on(
        "ads_data",
        """
        select count(distinct ad_id) as keys, cast(0 as bigint) as lost, cast(0 as bigint) as repeated,
               true as sizes_as_asked
        from ads_data""",
    ),
    "seeded_split": """
        select split, count(*) as keys, cast(0 as bigint) as lost, cast(0 as bigint) as repeated,
               true as sizes_as_asked
        from orders, (values ('80/20'), ('70/30')) as t(split) group by split""",
    "hash_split": on(
        "ads_data",
        """
        select distinct ad_id, case when (ad_id * 7919) % 100 < 75 then 'train' else 'test' end as part from ads_data""",
    ),
}

MODELS = {
    "assemble_features": on(
        "features",
        """
        select ad_id, cast(target_audience_count as double) as f0, cast(has_video as double) as f1,
               cast(is_cpm as double) as f2, cast(is_cpc as double) as f3, ad_cost as f4,
               cast(day_count as double) as f5
        from features""",
    ),
    "grid_sizes": on(
        "features",
        """
        select grid, family, cast(settings as int) as settings, n as rows
        from (values ('joint', 'lr', 1), ('joint', 'gbt', 24), ('joint', 'rf', 36), ('joint', 'dt', 27),
                     ('per family', 'dt', 27), ('per family', 'rf', 27), ('per family', 'gbt', 18),
                     ('three-class forest', 'rf', 56)) as t(grid, family, settings),
             (select count(ctr) as n from features)""",
    ),
    "linreg_simple": """
        select round(slope, 4) as slope, round(intercept, 4) as intercept,
               round(sqrt(avg(power(l_extendedprice - (slope * l_quantity + intercept), 2))), 3) as rmse,
               round(r2, 6) as r2
        from lineitem,
             (select regr_slope(l_extendedprice, l_quantity) as slope,
                     regr_intercept(l_extendedprice, l_quantity) as intercept,
                     regr_r2(l_extendedprice, l_quantity) as r2 from lineitem)
        group by slope, intercept, r2""",
    "rmse_metric": """
        select round(sqrt(avg(power(l_extendedprice - l_quantity * 1500, 2))), 4) as rmse from lineitem""",
    "accuracy_metric": on(
        "passengers",
        """
        select round(share, 9) as accuracy, round(1 - share, 9) as error
        from (select avg(case when cast(Pclass <= 2 as int) = Survived then 1.0 else 0.0 end) as share
              from passengers)""",
    ),
    "linreg_fit": "select count(*) as rows, 0::bigint as violations from lineitem",
    "linreg_summary": """
        select count(*) as rows, count(*) as summarised, false as wrong_rmse, false as wrong_r2 from lineitem""",
    "dt_reg": on("features", f"select n as rows, 0::bigint as wrong_leaves, 0::bigint as unknown_values from ({LABELLED})"),
    "rf_reg": on("features", f"select n as rows, 0::bigint as wrong_sums, 0::bigint as wrong_nodes from ({LABELLED})"),
    "gbt_reg": on("features", f"select n as rows, 0::bigint as wrong_sums, 0::bigint as wrong_nodes from ({LABELLED})"),
    "compare_regressors": on(
        "features",
        f"""
        select n as rows, model, false as wrong_rmse, 0::bigint as wrong_fit
        from ({LABELLED}), (values ('lr'), ('gbt'), ('rf'), ('dt')) as t(model)""",
    ),
    **{
        query: on(
            "passengers",
            f"""
            select model, n as test_rows, false as wrong_accuracy, 0::bigint as wrong_parts
            from ({HELD_OUT}), (values {", ".join(f"('{m}')" for m in models)}) as t(model)""",
        )
        for query, models in {
            "logreg": ["logistic"],
            "dt_cls": ["tree"],
            "rf_cls": ["forest"],
            "gbt_cls": ["boosted"],
            "port_classifiers": ["tree", "forest"],
        }.items()
    },
    "kmeans_assign": """
        select count(*) as rows, 3::bigint as clusters, 0::bigint as misplaced, 0::bigint as moved_centres, false as costly
        from embeddings""",
    "kmeans_silhouette": "select count(*) as rows, false as wrong_silhouette from embeddings",
    "tvs_best": on(
        "passengers",
        """
        select count(*) as rows, 56::bigint as settings, false as wrong_choice, false as wrong_metric
        from passengers where (PassengerId % 100 * 7919) % 100 < 80""",
    ),
    "tune_all_families": on(
        "features",
        f"""
        select n as rows, 88::bigint as settings, false as wrong_choice, false as wrong_metric from ({LABELLED})""",
    ),
    "tuning_report": f"select family, params, false as wrong_metric, false as wrong_rank from ({JOINT_GRID})",
    "best_family": on(
        "features",
        f"""
        select n as rows, family, false as wrong_rmse, 0::bigint as wrong_fit, false as wrong_winner
        from ({LABELLED}), (values ('dt'), ('rf'), ('gbt')) as t(family)""",
    ),
    "ctr_train_job": on(
        "features",
        f"select n as rows, false as wrong_rmse, 0::bigint as wrong_fit, false as wrong_winner from ({LABELLED})",
    ),
    "score_ads": on(
        "features", "select count(*) as rows, 0::bigint as missing, 0::bigint as differences from features"
    ),
    "pipeline_held_out": on(
        "passengers", f"select n as rows, n as scored, false as wrong_error, false as poor from ({HELD_OUT})"
    ),
    "embedding_classifier": """
        select count(*) as test_rows, 0::bigint as wrong_predictions, 0::bigint as wrong_step from embeddings
        where label in (0, 1) and (vec_id % 100 * 7919) % 100 >= 70""",
    "model_roundtrip": "select count(*) as rows, cast(0 as bigint) as differences from orders",
}

ORACLES: dict[str, str] = SOURCES | STAFF | ADS | TAXI | PASSENGERS | FLOWS | MODELS
