"""The SQL each registered query must agree with, written for DuckDB over the raw tables."""

from __future__ import annotations

# --- the raw tables as trips -----------------------------------------------------------------

EVENTS = """
select event_id as trip_id, ts as pickup_datetime, value as trip_miles,
       try_cast(json_extract_string(props, '$.k') as integer) as trip_time,
       user_id as "PULocationID", event_type as hvfhs_license_num,
       cast(null as double) as base_passenger_fare
from events"""

ORDERS = """
select o_orderkey as trip_id, o_orderdate as pickup_datetime, o_totalprice as trip_miles,
       try_cast(left(o_orderpriority, 1) as integer) as trip_time,
       o_custkey as "PULocationID", o_orderstatus as hvfhs_license_num,
       cast(null as double) as base_passenger_fare
from orders"""

LINEITEM = """
select l_orderkey * 8 + l_linenumber as trip_id, l_shipdate as pickup_datetime, l_quantity as trip_miles,
       l_linenumber as trip_time, l_suppkey as "PULocationID",
       l_returnflag as hvfhs_license_num, l_extendedprice as base_passenger_fare
from lineitem"""

ALL_TRIPS = f"{EVENTS} union all {ORDERS} union all {LINEITEM}"

ALL_RAW = f"""
select *, 'events.parquet' as source_file from ({EVENTS})
union all select *, 'orders.parquet' from ({ORDERS})
union all select *, 'lineitem.parquet' from ({LINEITEM})"""

VALID = "trip_miles > 0 and trip_time > 0"


def _derived(trips: str, source: str | None = None) -> str:
    """Trips with the bronze columns; ``source`` names the file when the trips do not."""
    file = f"'{source}.parquet' as source_file," if source else ""
    return f"""
    select *, {file} cast(pickup_datetime as date) as pickup_date,
           strftime(pickup_datetime, '%Y-%m') as pickup_month,
           timestamp '2024-02-01 00:00:00' as ingestion_timestamp
    from ({trips})"""


def _bronze(trips: str, source: str | None = None) -> str:
    return f"select * from ({_derived(trips, source)}) where {VALID}"


CALENDAR = """
cast(hour(pickup_datetime) as integer) as pickup_hour,
cast(dayofweek(pickup_datetime) + 1 as integer) as pickup_dayofweek,
cast(month(pickup_datetime) as integer) as pickup_month_num,
cast(pickup_datetime as date) as pickup_date"""

CALENDAR_ONLY = CALENDAR.rsplit(",", 1)[0]  # the bronze layer has the date already

SPEED = "trip_miles / nullif(cast(trip_time as double) / 3600, 0)"

# --- quality ---------------------------------------------------------------------------------

QUALITY_RULES = {
    "trip_miles_positive": "trip_miles > 0",
    "trip_time_positive": "trip_time > 0",
    "trip_miles_plausible": "trip_miles <= 100",
}

FAILED_RULES = (
    "concat_ws(',', "
    + ", ".join(f"case when not coalesce({p}, false) then '{name}' end" for name, p in QUALITY_RULES.items())
    + ")"
)


def _rule_metrics(trips: str) -> str:
    return " union all ".join(
        f"""select '{name}' as rule,
            cast(count(*) filter (where not coalesce({p}, false)) as bigint) as failed_rows,
            cast(count(*) as bigint) as total_rows,
            round(cast(count(*) filter (where not coalesce({p}, false)) as double) / count(*), 9) as failure_rate
            from ({trips})"""
        for name, p in QUALITY_RULES.items()
    )


def _layer_checks(layer: str, trips: str) -> str:
    return f"""select '{layer}' as layer, rule, total_rows, failed_rows, failed_rows = 0 as passed
               from ({_rule_metrics(trips)})"""


SILVER = f"""
select * from ({ALL_RAW}) where {VALID}
qualify row_number() over (
    partition by upper(trim(hvfhs_license_num)), trip_id, pickup_datetime
    order by trip_miles, trip_time, "PULocationID", base_passenger_fare, source_file) = 1"""

FILE_METRICS = f"""
select source_file as file_name, cast(count(*) as bigint) as rows_in,
       cast(count(*) filter (where {VALID}) as bigint) as rows_kept,
       cast(count(*) - count(*) filter (where {VALID}) as bigint) as rows_dropped
from ({ALL_RAW}) group by 1"""

# --- runs ------------------------------------------------------------------------------------

RUNS = """
select event_id as run_id, event_type as processing_mode,
       cast(hour(ts) as integer) as shuffle_partitions, user_id as config_id,
       case when event_type = 'error' then 'failed' else 'ok' end as status,
       value as seconds, try_cast(json_extract_string(props, '$.k') as integer) as files_processed,
       case when event_type = 'error' then 'run ' || event_id || ' failed' end as error,
       ts as logged_at
from events"""

AUDIT = f"""
select '{{"timestamp":"' || strftime(logged_at, '%Y-%m-%dT%H:%M:%S.%gZ') || '"'
    || ',"level":"' || case when status = 'failed' then 'ERROR' else 'INFO' end || '"'
    || ',"logger":"jobs.mode_' || processing_mode || '"'
    || ',"message":"run ' || status || '"'
    || ',"module":"mode_' || processing_mode || '"'
    || ',"function":"on_' || case when status = 'failed' then 'failure' else 'success' end || '"'
    || ',"line":' || shuffle_partitions
    || ',"job":"' || processing_mode || '","layer":"bronze","run_id":' || run_id
    || case when files_processed > 0 then ',"file_name":"file-' || files_processed || '"' else '' end
    || case when error is not null then ',"exception":"' || error || '"' else '' end
    || '}}' as record
from ({RUNS})"""


def _leaderboard(trips: str) -> str:
    return f"""
    select * from (
      select pickup_month, "PULocationID", trips,
             cast(row_number() over (partition by pickup_month order by trips desc, "PULocationID") as integer) as rank
      from (select strftime(pickup_datetime, '%Y-%m') as pickup_month, "PULocationID",
                   cast(count(*) as bigint) as trips from ({trips}) group by all))
    where rank <= 3"""


def _gold(trips: str) -> str:
    """The three gold tables, one below the other."""
    return f"""
    select 'daily_company' as gold_table, cast(cast(pickup_datetime as date) as varchar) as first_key,
           hvfhs_license_num as second_key, cast(count(*) as bigint) as trips, round(sum(trip_miles), 4) as miles
    from ({trips}) group by all
    union all
    select 'hour_weekday', cast(hour(pickup_datetime) as varchar), cast(dayofweek(pickup_datetime) + 1 as varchar),
           cast(count(*) as bigint), null
    from ({trips}) group by all
    union all
    select 'location_month', pickup_month, rank || '-' || "PULocationID", trips, null from ({_leaderboard(trips)})"""


def _volume(trips: str, key: str, alias: str = "trips") -> str:
    return f"""select "{key}", cast(count(*) as bigint) as {alias} from ({trips})
               group by 1 order by {alias} desc, "{key}" """


ORACLES: dict[str, str] = {
    # sources
    "tolerant_scan": """
        select 'events.parquet' as file_name, 'ok' as status, cast(count(*) as bigint) as rows_read,
               cast(count(*) filter (where value > 0) as bigint) as rows_kept from events
        union all select 'broken.parquet', 'skipped', 0, 0""",
    "dataset_overview": """
        select 11 as column_count, cast(count(*) as bigint) as row_count, cast(1 as bigint) as file_count,
               true as has_partitions, true as has_bytes from lineitem""",
    "file_catalog": """
        select 'events.parquet' as file_name, true as has_bytes, true as has_time, count(*) as row_count from events
        union all select 'lineitem.parquet', true, true, count(*) from lineitem""",
    "incremental_files": f"select * from ({FILE_METRICS}) where file_name = 'lineitem.parquet'",
    "union_by_name": ALL_TRIPS,
    "schema_check": """
        select 'trip_time' as column_name, 'wrong_type' as issue, 'int' as expected, 'string' as actual,
               cast(count(*) filter (where o_orderpriority is not null
                    and try_cast(o_orderpriority as integer) is null) as bigint) as bad_values from orders
        union all select 'PULocationID', 'missing', 'bigint', null, null
        union all select 'base_passenger_fare', 'missing', 'double', null, null
        union all select 'o_custkey', 'extra', null, 'bigint', null""",
    # bronze
    "bronze_derived": _derived(EVENTS, "events"),
    "bronze_transform": _bronze(LINEITEM, "lineitem"),
    "bronze_roundtrip": _bronze(LINEITEM, "lineitem"),
    "bronze_full_batch": _bronze(ALL_RAW),
    "incremental_ingest": _bronze(ALL_RAW),
    "drifting_files": f"""
        select * , case when trip_id % 3 = 1 then trip_miles / 4 end as tips
        from ({_bronze("select *, 'trips ' || (trip_id % 3 + 1) || '.parquet' as source_file from (" + EVENTS + ")")})""",
    "bronze_file_loop": _bronze(ALL_RAW),
    "bronze_fallback": _bronze(ALL_RAW),
    "bronze_file_sizes": f"""
        select pickup_month, cast(count(*) as bigint) as row_count, cast(0 as bigint) as files_over_cap,
               true as enough_files from ({_bronze(LINEITEM)}) group by 1""",
    "bronze_layout": f"""
        select asked, codec, pickup_month, cast(count(*) as bigint) as trips, true as few_files
        from ({_bronze(ORDERS)}) cross join (values ('zstd', 'zstd'), ('gzip', 'gz'), ('none', 'none')) as c(asked, codec)
        group by all""",
    "count_rows": " union all ".join(
        f"""select '{name}.parquet' as source, 'ok' as status, cast(1 as bigint) as files, cast(count(*) as bigint) as rows_in,
            cast(count(*) filter (where {VALID}) as bigint) as rows_out from ({trips})"""
        for name, trips in (("events", EVENTS), ("orders", ORDERS), ("lineitem", LINEITEM))
    ),
    "month_slice": f"select * from ({_bronze(ORDERS, 'orders')}) where pickup_month = '1997-01'",
    "ingest_metrics": FILE_METRICS,
    # quality
    "dq_filter": f"select * from ({EVENTS}) where {VALID}",
    "dq_tagged": f"select *, {FAILED_RULES} as failed_rules from ({EVENTS})",
    "dq_rejected": f"""
        select * from (select *, {FAILED_RULES} as failed_rules from ({EVENTS})) where failed_rules <> ''""",
    "dq_metrics": _rule_metrics(EVENTS),
    "dq_alerts": f"select * from ({_rule_metrics(EVENTS)}) where failure_rate > cast(0.05 as double)",
    "dq_suite": " union all ".join(
        [
            _layer_checks("raw", ALL_RAW),
            _layer_checks("bronze", f"select * from ({ALL_RAW}) where {VALID}"),
            _layer_checks("silver", SILVER),
        ]
    ),
    # analysis
    "row_count": "select cast(count(*) as bigint) as row_count from lineitem",
    "missing_values": " union all ".join(
        f"select '{c}' as column_name, cast(count(*) - count(\"{c}\") as bigint) as nulls from ({ALL_TRIPS})"
        for c in (
            "trip_id",
            "pickup_datetime",
            "trip_miles",
            "trip_time",
            "PULocationID",
            "hvfhs_license_num",
            "base_passenger_fare",
        )
    ),
    "temporal_features": f"select *, {CALENDAR} from ({EVENTS})",
    "hourly_demand": f"""
        select cast(hour(pickup_datetime) as integer) as pickup_hour, cast(count(*) as bigint) as trips
        from ({EVENTS}) group by 1 order by 1""",
    "top_locations": _volume(EVENTS, "PULocationID") + " limit 20",
    "busiest_locations": _volume(LINEITEM, "PULocationID", "trip_count") + " limit 20",
    "company_volume": _volume(EVENTS, "hvfhs_license_num"),
    "distance_histogram": f"""
        select cast(case when trip_miles < 0 then 0 else least(floor(trip_miles / 10) + 1, 51) end as bigint) as bin,
               cast(count(*) as bigint) as trips
        from ({EVENTS}) where trip_miles is not null group by 1 order by 1""",
    "distance_sample": f"""
        select trip_id, trip_miles from ({EVENTS})
        where cast(('0x' || left(md5(cast(trip_id as varchar)), 8)) as bigint) / cast(4294967296 as double)
              < cast(0.01 as double)""",
    "fare_distance_corr": f"select round(corr(trip_miles, base_passenger_fare), 6) as corr from ({LINEITEM})",
    "fare_distance_grid": f"""
        select cast(floor(trip_miles / 5) as integer) as miles_cell,
               cast(floor(base_passenger_fare / 10000) as integer) as fare_cell,
               cast(count(*) as bigint) as trips, round(avg(base_passenger_fare), 4) as mean_fare
        from ({LINEITEM}) group by 1, 2""",
    "trip_speed": f"select *, {SPEED} as speed_mph from ({EVENTS})",
    "speed_anomalies": f"""
        select * from (select *, {SPEED} as speed_mph from ({EVENTS})) where trip_time > 0 and speed_mph > 200""",
    "longest_trips_per_day": f"""
        select * from (
          select *, cast(row_number() over (partition by pickup_date order by trip_miles desc, trip_id) as integer) as rank
          from (select *, cast(pickup_datetime as date) as pickup_date from ({EVENTS})))
        where rank <= 5""",
    "demand_grid": f"""
        with trips as (select *, cast(hour(pickup_datetime) as integer) as pickup_hour from ({EVENTS})),
             hours as (select cast(h as integer) as pickup_hour from range(24) t(h)),
             companies as (select distinct hvfhs_license_num from trips),
             counts as (select hvfhs_license_num, pickup_hour, count(*) as n from trips group by all)
        select hvfhs_license_num, pickup_hour, cast(coalesce(n, 0) as bigint) as trips
        from companies cross join hours left join counts using (hvfhs_license_num, pickup_hour)""",
    # silver and gold
    "silver_dedup": """
        select * from lineitem
        qualify row_number() over (
          partition by l_orderkey, l_linenumber
          order by l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                   l_returnflag, l_linestatus, l_shipdate) = 1""",
    "silver_clean": f"""
        select * replace (upper(trim(hvfhs_license_num)) as hvfhs_license_num)
        from ({ALL_TRIPS}) where {VALID}""",
    "silver_features": f"select *, {CALENDAR}, {SPEED} as speed_mph from ({EVENTS}) where {VALID}",
    "gold_daily_company": f"""
        select cast(pickup_datetime as date) as pickup_date, hvfhs_license_num,
               cast(count(*) as bigint) as trips, round(sum(trip_miles), 4) as total_miles,
               round(avg(trip_miles), 6) as mean_miles
        from ({EVENTS}) where {VALID} group by 1, 2""",
    "gold_hour_weekday": f"""
        select cast(hour(pickup_datetime) as integer) as pickup_hour,
               cast(dayofweek(pickup_datetime) + 1 as integer) as pickup_dayofweek,
               cast(count(*) as bigint) as trips
        from ({EVENTS}) where {VALID} group by 1, 2""",
    "gold_location_month": _leaderboard(LINEITEM),
    "gold_refresh": _leaderboard(f"select * from ({ALL_TRIPS}) where {VALID}"),
    "snapshot_publish": f"""
        with layer as ({_bronze(ALL_RAW)}),
        last as (
          select pickup_month,
                 case when source_file = 'orders.parquet' and pickup_month = '1997-01' then trip_miles * 2 else trip_miles end as miles
          from layer where pickup_month <> '1997-01' or source_file = 'orders.parquet')
        select 'first' as snapshot, pickup_month, cast(count(*) as bigint) as trips, round(sum(trip_miles), 2) as miles
        from layer where source_file = 'events.parquet' group by all
        union all
        select 'last', pickup_month, cast(count(*) as bigint), round(sum(miles), 2) from last group by all
        union all
        select 'month', pickup_month, cast(count(*) as bigint), round(sum(miles), 2)
        from last where pickup_month = '1997-01' group by all""",
    "silver_upsert": f"""
        with first as ({_bronze(LINEITEM)}),
        delivered as (
          select * from first where trip_id % 3 <> 0
          union all
          select * replace (trip_miles + 1000 as trip_miles, ingestion_timestamp + interval 1 day as ingestion_timestamp)
          from first where trip_id % 2 = 0)
        select * replace (upper(trim(hvfhs_license_num)) as hvfhs_license_num), {CALENDAR_ONLY}, {SPEED} as speed_mph
        from delivered
        qualify row_number() over (
          partition by hvfhs_license_num, trip_id, pickup_datetime
          order by ingestion_timestamp desc, trip_miles, trip_time, "PULocationID", base_passenger_fare) = 1""",
    "gold_delta_refresh": _gold(f"""
        select * from ({ORDERS}) where {VALID} and trip_id % 2 = 0
        union all select * from ({LINEITEM}) where {VALID}"""),
    "layers_refresh": _gold(f"""
        select * replace (upper(trim(hvfhs_license_num)) as hvfhs_license_num) from ({ALL_TRIPS}) where {VALID}
        qualify row_number() over (
          partition by upper(trim(hvfhs_license_num)), trip_id, pickup_datetime
          order by trip_miles, trip_time, "PULocationID", base_passenger_fare nulls first) = 1"""),
    # runs
    "best_run_per_group": f"""
        select config_id, first(run_id order by seconds, run_id) as best_run_id, min(seconds) as best_seconds
        from ({RUNS}) where status = 'ok' group by 1""",
    "factor_marginals": f"""
        select processing_mode, shuffle_partitions, config_id,
               cast(grouping(processing_mode, shuffle_partitions, config_id) as bigint) as factor_set,
               cast(count(*) as bigint) as runs, round(avg(seconds), 6) as mean_seconds,
               min(seconds) as min_seconds, max(seconds) as max_seconds
        from ({RUNS}) where status = 'ok'
        group by grouping sets ((processing_mode), (shuffle_partitions), (config_id))""",
    "success_rate": f"""
        select config_id, cast(count(*) as bigint) as runs,
               cast(count(*) filter (where status = 'ok') as bigint) as ok_runs,
               round(avg(case when status = 'ok' then cast(1 as double) else cast(0 as double) end), 9) as success_rate
        from ({RUNS}) group by 1""",
    "run_regressions": f"""
        select run_id, processing_mode, seconds, round(typical, 6) as typical_seconds
        from ({RUNS}) join (
          select processing_mode, quantile_cont(seconds, 0.8) as typical from ({RUNS}) group by 1
        ) using (processing_mode)
        where seconds > 2 * typical""",
    "run_metrics_csv": f"select * exclude (logged_at) from ({RUNS})",
    "audit_json": AUDIT,
    # streams
    "stream_bronze": _bronze(EVENTS, "events"),
    "stream_hourly_demand": f"""
        select * from (
          select time_bucket(interval 1 hour, pickup_datetime) as window_start,
                 time_bucket(interval 1 hour, pickup_datetime) + interval 1 hour as window_end,
                 cast(count(*) as bigint) as trips
          from ({EVENTS}) group by all)
        where window_end <= (select max(ts) - interval 1 hour from events)""",
    "stream_dedup": EVENTS,
    "stream_upsert_partitions": _bronze(EVENTS, "events"),
    "stream_compact": f"select * exclude (source_file), 1 as folders from ({_bronze(EVENTS, 'events')})",
    "stream_dedup_history": f"select * exclude (source_file) from ({_bronze(EVENTS, 'events')})",
    "stream_late_demand": f"""
        with trips as (
          select trip_id % 3 as delivery, pickup_datetime as t, time_bucket(interval 1 hour, pickup_datetime) as window_start
          from ({EVENTS}) where pickup_datetime is not null),
        marks as (select 1 as delivery, max(t) - interval 1 hour as mark from trips where delivery < 1
                  union all select 2, max(t) - interval 1 hour from trips where delivery < 2)
        select window_start, window_start + interval 1 hour as window_end, cast(count(*) as bigint) as trips,
               cast(count(*) filter (where window_start + interval 1 hour <= mark) as bigint) as late_trips
        from trips left join marks using (delivery) group by all""",
}
