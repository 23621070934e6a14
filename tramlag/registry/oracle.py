"""The registered queries in DuckDB SQL over the same tables."""

from __future__ import annotations

# ------------------------------------------------------------------ shared views

_FACT = """
ev as (
  select *, cast(json_extract_string(props, '$.k') as int) as k from events
),
fact as (
  select
    ts,
    case when ts < timestamp '2024-01-16 00:00:00' then 1 else 2 end as version_id,
    'T' || user_id as trip_id,
    'S' || (k % 50) as stop_id,
    k as stop_sequence,
    'L' || (user_id % 20) as line_id,
    'O' || (user_id % 5) as operator_id,
    cast(timezone('Europe/Warsaw', timezone('UTC', ts)) as date) - case when k % 3 = 0 then 1 else 0 end
      as service_date,
    case when event_type not in ('error', 'signup') then cast(floor(value) as int) - 60 end as delay_s,
    case event_type when 'error' then 'ANULOWANY' when 'signup' then 'POMINIETY' else 'OBSERWACJA' end
      as status
  from ev
)"""

_MEASURES = """
    cast(sum(delay_s) filter (where status = 'OBSERWACJA') as bigint) as delay_sum,
    count(*) filter (where status = 'OBSERWACJA') as obs,
    count(*) filter (where status = 'OBSERWACJA' and delay_s between -30 and 60) as on_time,
    min(delay_s) filter (where status = 'OBSERWACJA') as delay_min,
    max(delay_s) filter (where status = 'OBSERWACJA') as delay_max,
    count(*) filter (where status = 'ANULOWANY') as cancelled,
    count(*) filter (where status = 'POMINIETY') as skipped"""


def _aggregate(width: str, keys: str, source: str = "fact") -> str:
    bucket = f"timezone('UTC', time_bucket(interval '{width}', timezone('UTC', ts), 'Europe/Warsaw'))"
    return f"select {bucket} as bucket, {keys}, {_MEASURES} from {source} group by all"


_LINE_KEYS = "service_date, version_id, line_id, operator_id"
_STOP_KEYS = "service_date, version_id, stop_id, line_id"

_SCHEDULE = """
times as (
  select 'T' || l_orderkey as trip_id, 'S' || l_suppkey as stop_id, l_linenumber as stop_sequence,
    lpad(cast(cast(l_quantity as int) as varchar), 2, '0') || ':30:00' as sched_arrival,
    cast(floor(l_quantity / 24) as smallint) as day_offset
  from (
    select *, row_number() over (
      partition by l_orderkey, l_suppkey, l_linenumber
      order by l_shipdate, l_partkey, l_quantity, l_extendedprice) as rn
    from lineitem)
  where rn = 1
),
trip as (
  select 'T' || o_orderkey as trip_id, 'L' || o_custkey as line_id, o_orderstatus as direction,
    o_orderpriority as headsign,
    case when o_totalprice >= 50000 then 'O' || (o_custkey % 5) end as operator_id
  from orders
),
schedule as (
  select t.trip_id, t.stop_id, t.stop_sequence, t.sched_arrival, trip.line_id, trip.direction,
    trip.headsign, trip.operator_id, t.day_offset
  from times t join trip on t.trip_id = trip.trip_id
)"""

_FEED = (
    _SCHEDULE
    + """,
running as (
  select ts, cast(timezone('Europe/Warsaw', timezone('UTC', ts)) as date) as local_date, 'T' || l_orderkey as trip_id,
    l_linenumber, l_tax, l_returnflag, l_linestatus, l_extendedprice, l_quantity
  from (select *, timestamp '2024-01-01'
      + to_seconds(1009 * date_diff('day', date '1995-01-01', cast(l_shipdate as date))) as ts from lineitem)
  where l_quantity < 49
),
cancelled as (
  select ts, cast(timezone('Europe/Warsaw', timezone('UTC', ts)) as date) as local_date,
    'T' || o_orderkey as trip_id
  from (select *, timestamp '2024-01-01'
      + to_seconds(1009 * date_diff('day', date '1995-01-01', cast(o_orderdate as date))) as ts from orders)
  where o_orderpriority = '1-URGENT' and o_orderstatus = 'P'
),
updates as (
  select * from (
    select ts, local_date, 0 as update_pos, trip_id,
      case when l_tax < 0.08 then l_linenumber end as stop_sequence,
      l_returnflag = 'R' as skipped,
      case when l_returnflag <> 'N' or l_linestatus <> 'O'
        then cast(floor(l_extendedprice) as int) % 600 - 120 end as delay
    from running
    union all
    select ts, local_date, 1, trip_id, l_linenumber + 1, false, cast(l_quantity as int) from running
  ) where stop_sequence is not null and (skipped or delay is not null)
),
lookup as (
  select * from (
    select *, row_number() over (partition by trip_id, stop_sequence order by stop_id desc) as rn
    from schedule) where rn = 1
),
cancelled_rows as (
  select c.ts, c.trip_id, s.stop_id, s.stop_sequence, s.line_id, s.operator_id, s.direction,
    c.local_date - s.day_offset as service_date, cast(null as int) as delay_s, 'ANULOWANY' as status
  from cancelled c join schedule s on c.trip_id = s.trip_id
),
matched as (
  select u.ts, u.trip_id, l.stop_id, u.stop_sequence, l.line_id, l.operator_id, l.direction,
    u.local_date - l.day_offset as service_date,
    case when not u.skipped then u.delay end as delay_s,
    case when u.skipped then 'POMINIETY' else 'OBSERWACJA' end as status, u.update_pos
  from updates u join lookup l on u.trip_id = l.trip_id and u.stop_sequence = l.stop_sequence
)"""
)

_LINES = """
line as (
  select 'L' || p_partkey as line_id, p_brand as short_name, p_name as long_name,
    case p_size % 4 when 0 then 'tramwaj' when 1 then 'autobus' when 2 then 'trolejbus' else 'inne' end
      as mode,
    case when p_size > 10 and p_type <> 'PROMO' then p_type else 'Normalna' end as line_type
  from part
)"""

_STOPS = """
stop as (
  select 'S' || s_suppkey as stop_id, s_name as name,
    case when s_acctbal >= 0 then 50 + s_nationkey / 100.0::double end as lat,
    19 + s_suppkey / 10000.0::double as lon,
    case when s_acctbal >= 1000 then n.n_name end as commune,
    case when s_acctbal >= 1000 then 'City ' || s_nationkey end as city,
    case when s_acctbal >= 3000 then coalesce(r.r_name, 'Standardowy')
      when s_acctbal >= 1000 then 'Standardowy' end as stop_type
  from supplier
  left join nation n on n.n_nationkey = s_nationkey and n.n_nationkey < 20
  left join region r on r.r_regionkey = s_nationkey % 7
)"""

_OPERATORS = "operator as (select 'O' || c_custkey as operator_id, c_name as name from customer)"

_VERSIONS = """
version as (
  select case o_orderstatus when 'F' then 1 when 'O' then 2 else 3 end as version_id,
    'orders ' || count(*) as package_names, cast(min(o_orderdate) as date) as valid_from,
    cast(max(o_orderdate) as date) as valid_to, max(o_orderdate) as loaded_at
  from orders group by o_orderstatus
)"""

_CALENDAR = """
calendar_rows as (
  select cast(place % 12 + 1 as varchar) as service_id, f as period_from,
    f + cast(o_custkey % 6 as int) as period_to,
    case when o_totalprice >= 100000 then '1' else '0' end as week,
    case when o_orderpriority in ('1-URGENT', '2-HIGH') then '1' else '0' end as weekend,
    month(o_orderdate) as pkg_ord, o_orderkey as line_no
  from (select *, cast(date_diff('day', date '1995-01-01', cast(o_orderdate as date)) % 75 as int) as place,
      date '2023-11-20' + place as f from orders)
),
calendar as (
  select * from (
    select *, row_number() over (
      partition by service_id, period_from, period_to, week, weekend order by pkg_ord, line_no) as rn
    from calendar_rows) where rn = 1
),
days as (
  select cast(unnest(generate_series(date '2023-12-01', date '2024-02-15', interval 1 day)) as date) as date
),
active as (
  select d.date, c.service_id from days d join calendar c
    on d.date between c.period_from and c.period_to
    and case when isodow(d.date) <= 5 then c.week else c.weekend end = '1'
),
primary_service as (
  select date, service_id from (
    select distinct date, service_id, row_number() over (
      partition by date
      order by case when cast(service_id as int) >= 9 then 0 else 1 end, cast(service_id as int)) as rn
    from active) where rn = 1
),
service_rows as (
  select case when c_custkey % 12 = 11 then 'X12' else cast(c_custkey % 12 + 1 as varchar) end as service_id,
    case when c_custkey % 12 + 1 <> 11 then c_mktsegment || ' ' || (c_custkey % 12 + 1) end as name,
    c_nationkey as pkg_ord, c_custkey as line_no
  from customer
),
service as (
  select * from (
    select *, row_number() over (partition by service_id, name order by pkg_ord, line_no) as rn
    from service_rows) where rn = 1
),
service_name as (
  select service_id, name as service_name from (
    select *, row_number() over (partition by service_id order by pkg_ord desc, line_no desc) as last
    from service) where last = 1
),
dates as (
  select d.date, cast(year(d.date) as smallint) as year, cast(month(d.date) as smallint) as month,
    cast(weekofyear(d.date) as smallint) as iso_week, cast(isodow(d.date) as smallint) as iso_dow,
    ['poniedziałek', 'wtorek', 'środa', 'czwartek', 'piątek', 'sobota', 'niedziela'][isodow(d.date)]
      as day_name,
    case when n.service_id is null then 'brak rozkładu' else n.service_name end as day_type
  from days d
  left join primary_service p on p.date = d.date
  left join service_name n on n.service_id = p.service_id
)"""

_CATALOGUE = """
resource as (
  select
    case when o_orderpriority <> '4-NOT SPECIFIED' then
      case when o_orderstatus = 'P' then 'old_' else '' end || 'schedule_ZTM_'
      || strftime(o_orderdate, '%Y.%m.%d') || '_' || o_custkey || '_' || o_orderkey || '.zip'
      || case when o_orderpriority = '5-LOW' then '.bak' else '' end end as name,
    'https://example.org/' || o_orderkey as url,
    year(o_orderdate) as y, month(o_orderdate) as m, day(o_orderdate) as d, o_custkey as seq,
    date '1998-02-15' + cast(o_custkey % 40 as int) as period_start,
    date '1998-02-15' + cast(o_custkey % 40 + o_orderkey % 10 as int) as period_end,
    o_orderstatus
  from orders
),
package as (select * from resource where name is not null and o_orderstatus <> 'P')"""


def _cover(horizon: int) -> str:
    last = f"date '1998-02-28' + {max(horizon, 14)}"
    return (
        _CATALOGUE
        + f""",
offered as (
  select cast(unnest(generate_series(
      greatest(period_start, date '1998-03-01'), least(period_end, {last}), interval 1 day)) as date)
      as day, *
  from package where period_start <= {last} and period_end >= date '1998-03-01'
),
newest as (
  select * from (
    select *, row_number() over (
      partition by day order by y desc, m desc, d desc, seq desc, url desc, name desc) as rn
    from offered) where rn = 1
),
target as (select * from newest where day < date '1998-03-01' + {horizon}),
stop as (
  select case when (select count(*) from target) = {horizon} then (
    select (y, m, d, seq, url, name) from target order by y, m, d, seq, url, name limit 1) end as rank
),
chosen as (
  select distinct name, url, y, m, d, seq, period_start, period_end from newest, stop
  where stop.rank is null or (y, m, d, seq, url, name) >= stop.rank
),
selected as (
  select cast(row_number() over (
      order by period_start, y desc, m desc, d desc, seq desc, url desc, name desc) as int) as pkg_ord,
    name, period_start, period_end
  from chosen
)"""
    )


def _with(*views: str) -> str:
    return "with " + ",".join(views) + " "


_RATES = "round(sum(on_time) / sum(obs), 6) as punctuality, round(sum(delay_sum) / sum(obs), 6) as mean_delay_s"
_OBS = "cast(sum(obs) as bigint) as obs"
_CANCELLED = "cast(sum(cancelled) as bigint) as cancelled"
_SKIPPED = "cast(sum(skipped) as bigint) as skipped"
_AGG = f"agg as ({_aggregate('15 minutes', _LINE_KEYS)})"

_RUNS = """
runs as (
  select o_orderdate + to_seconds(o_orderkey) as started_at, o_orderdate as snapshot_ts,
    cast(floor(o_totalprice / 1000) as bigint) as observed,
    cast(floor(o_totalprice / 2000) as bigint) as inserted,
    cast(floor(o_totalprice) as int) % 1000 as seconds,
    case o_orderstatus when 'F' then 'OK' when 'O' then 'SKIPPED' else 'ERROR' end as status,
    case when o_orderstatus = 'P' then o_orderpriority end as error
  from orders
)"""

_REFERENCES = """
bad as (
  select 'stop_id' as fk, stop_id as key from fact
    where stop_id not in (select 'S' || s_suppkey from supplier)
  union all select 'line_id', line_id from fact where line_id not in (select 'L' || p_partkey from part)
  union all select 'operator_id', operator_id from fact
    where operator_id not in (select 'O' || c_custkey from customer)
  union all select 'service_date', cast(service_date as varchar) from fact
    where service_date not between date '2024-01-05' and date '2024-02-15'
  union all select 'version_id', cast(version_id as varchar) from fact
    where version_id not in (1, 2, 3)
)"""


def _levels(**bounds: tuple[str, str]) -> str:
    """All four levels in one result; `bounds` limit the facts that count for a level."""
    parts, sources = [], []
    for level, (width, keys) in _LEVELS.items():
        lo, hi = bounds.get(level, ("-infinity", "infinity"))
        sources.append(f"of_{level} as (select * from fact where ts >= timestamp '{lo}' and ts < timestamp '{hi}')")
        stop = "stop_id" if "stop_id" in keys else "cast(null as varchar) as stop_id"
        operator = "operator_id" if "operator_id" in keys else "cast(null as varchar) as operator_id"
        parts.append(
            f"""select '{level}' as level, bucket, service_date, version_id, line_id, {operator}, {stop}, delay_sum, obs, on_time,
              cast(delay_min as bigint) as delay_min, cast(delay_max as bigint) as delay_max, cancelled, skipped
            from ({_aggregate(width, keys, f"of_{level}")})"""
        )
    return _with(_FACT, *sources) + " union all ".join(parts)


_LEVELS = {
    "agg_line_15m": ("15 minutes", _LINE_KEYS),
    "agg_stop_15m": ("15 minutes", _STOP_KEYS),
    "agg_line_1h": ("1 hour", _LINE_KEYS),
    "agg_line_1d": ("1 day", _LINE_KEYS),
}


def _recent(key: str, value: str, since: str = "2024-01-25") -> str:
    return _with(_FACT) + f"""
      select ts, {key}, trip_id, stop_id, stop_sequence, delay_s, status from fact
      where {key} = '{value}' and ts >= timestamp '{since}'
      order by ts desc, trip_id, stop_id, stop_sequence limit 100"""


ORACLE: dict[str, str] = {
    "s1_catalogue": _with(_CATALOGUE) + "select name, url, cast(y as int) as year, cast(m as int) as month, cast(d as int) as day, seq from package",
    "s2_periods": _with(_CATALOGUE)
    + "select name, period_start, period_end from resource",
    "s3_packages": _with(_cover(14)) + "select * from selected",
    "s3_packages_short": _with(_cover(5)) + "select * from selected",
    "s3_packages_long": _with(_cover(20)) + "select * from selected",
    "s6_current_version": _with(_VERSIONS)
    + "select * from version order by loaded_at desc, version_id desc limit 1",
    "s7_schedule_scan": _with(_SCHEDULE, _VERSIONS)
    + """select trip_id, stop_id, stop_sequence, sched_arrival, line_id, direction, operator_id, day_offset
      from schedule where case direction when 'F' then 1 when 'O' then 2 else 3 end =
        (select version_id from version order by loaded_at desc, version_id desc limit 1)""",
    "m1_concat": """
      select 'S' || s_suppkey as stop_id, s_name as stop_name, cast(null as varchar) as zone from supplier
      union all select 'C' || c_custkey, c_name, c_mktsegment from customer""",
    "m2_dedup_first": """
      select 'T' || l_orderkey as trip_id, 'S' || l_suppkey as stop_id,
        cast(l_linenumber as varchar) as stop_sequence,
        lpad(cast(cast(l_quantity as int) as varchar), 2, '0') || ':30:00' as arrival_time,
        l_shipdate, l_partkey, l_quantity, l_extendedprice
      from (select *, row_number() over (
          partition by l_orderkey, l_suppkey, l_linenumber
          order by l_shipdate, l_partkey, l_quantity, l_extendedprice) as rn from lineitem)
      where rn = 1""",
    "m3_calendar": _with(_CALENDAR)
    + """select service_id, strftime(period_from, '%Y%m%d') as start_date,
        strftime(period_to, '%Y%m%d') as end_date, week as monday, week as tuesday, week as wednesday,
        week as thursday, week as friday, weekend as saturday, weekend as sunday,
        cast(pkg_ord as int) as pkg_ord, line_no from calendar""",
    "m4_first_package": _with(_CALENDAR)
    + """select service_id, strftime(period_from, '%Y%m%d') as start_date, cast(pkg_ord as int) as pkg_ord,
        line_no from calendar_rows where pkg_ord = (select min(pkg_ord) from calendar_rows)""",
    "d1_line": _with(_LINES) + "select * from line",
    "d2_stop": _with(_STOPS) + "select * from stop",
    "d3_operator": _with(_OPERATORS) + "select * from operator",
    "d4_date": _with(_CALENDAR) + "select * from dates",
    "d5_active_services": _with(_CALENDAR)
    + "select date, service_id, count(*) as periods from active group by all",
    "d6_primary_service": _with(_CALENDAR) + "select date, service_id from primary_service",
    "d7_service_names": _with(_CALENDAR) + "select service_id, service_name from service_name",
    "d9_version": _with(_cover(14))
    + """select 7 as version_id, string_agg(name, ' | ' order by pkg_ord) as package_names,
        date '1998-03-01' as valid_from, date '1998-03-14' as valid_to,
        timestamp '1998-03-01 04:30:00' as loaded_at from selected""",
    "l1_trips": _with(_SCHEDULE)
    + "select trip_id, line_id as route_id, direction as direction_id, headsign as trip_headsign, operator_id from trip",
    "l_schedule": _with(_SCHEDULE) + "select * from schedule",
    "r2_entities": _with(_FEED)
    + """select ts, local_date, trip_id, false as cancelled, 2 as updates from running
      union all select ts, local_date, trip_id, true, 1 from cancelled""",
    "r3_cancelled": _with(_FEED) + "select * exclude (delay_s) from cancelled_rows",
    "r4_stop_updates": _with(_FEED) + "select * from updates",
    "r5_match": _with(_FEED) + "select * from matched",
    "r_facts": _with(_FEED)
    + """select *, 1 as version_id from cancelled_rows
      union all select * exclude (update_pos), 1 from matched""",
    "r9_stale_skip": """
      select arrival, ts from (
        select o_orderkey as arrival, o_orderdate as ts, max(o_orderdate) over (
          order by o_orderkey rows between unbounded preceding and 1 preceding) as marker from orders)
      where marker is null or ts > marker""",
    "r13_cycle_counts": _with(_FEED)
    + """select ts, status, count(*) as observed from (
        select ts, status from cancelled_rows union all select ts, status from matched) group by all""",
    "r14_live_stream": _with(_FEED)
    + """select ts, cast(1 as int) as version_id, trip_id, stop_id, stop_sequence, line_id, operator_id, direction,
        service_date, delay_s, status
      from (
        select *, row_number() over (
          partition by ts, trip_id, stop_id, stop_sequence order by update_pos, delay_s nulls first, status) as rn
        from (select *, stop_sequence as update_pos from cancelled_rows union all select * from matched))
      where rn = 1""",
    "s8_published_views": _with(_SCHEDULE, _LINES)
    + """select cast(2 as int) as version_id, mode, day_offset, count(*) as planned, count(distinct trip_id) as trips
      from schedule left join line on line.line_id = schedule.line_id group by mode, day_offset""",
    "w5_run_audit": _with(_FEED)
    + """, heads as (
        select distinct timestamp '2024-01-01' + to_seconds(1009 * date_diff('day', date '1995-01-01', cast(day as date))) as ts
        from (select l_shipdate as day from lineitem union all select o_orderdate from orders)),
      found as (select * from cancelled_rows union all select * exclude (update_pos) from matched),
      counted as (select ts, count(*) as observed, count(distinct (trip_id, stop_id, stop_sequence)) as inserted from found group by ts)
      select ts as snapshot_ts, cast(coalesce(observed, 0) as int) as observed, cast(coalesce(inserted, 0) as int) as inserted,
        'OK' as status, cast(null as varchar) as error
      from heads left join counted using (ts)""",
    "w2_upsert": _with(_LINES)
    + """select line_id, short_name, case when p_size > 20 then long_name else 'before' end as long_name,
        mode, line_type from line join part on line_id = 'L' || p_partkey""",
    "w3_insert_ignore": _with(_FACT)
    + """select ts, trip_id, stop_id, stop_sequence, delay_s, status from (
        select *, row_number() over (
          partition by ts, trip_id, stop_id, stop_sequence order by delay_s nulls first) as rn
        from fact where ts >= timestamp '2024-01-16') where rn = 1""",
    "j1_unique": """
      select 'T' || l_orderkey as trip_id, 'S' || l_suppkey as stop_id,
        cast(l_linenumber as varchar) as stop_sequence, count(*) as rows
      from lineitem group by l_orderkey, l_suppkey, l_linenumber having count(*) > 1""",
    "j2_orphans": _with(_FACT, _REFERENCES) + "select fk, key, count(*) as rows from bad group by all",
    "j2_schedule_versions": _with(_SCHEDULE)
    + """select 'version_id' as fk, '9' as key, count(*) as rows from schedule where headsign = '5-LOW' having count(*) > 0""",
    "j2_clean_facts": _with(_FACT, _REFERENCES)
    + """select ts, trip_id, stop_id, stop_sequence, service_date from fact f
      where not exists (select 1 from bad where
        (fk, key) in (('stop_id', f.stop_id), ('line_id', f.line_id), ('operator_id', f.operator_id),
          ('service_date', cast(f.service_date as varchar)), ('version_id', cast(f.version_id as varchar))))""",
    "j3_nulls": _with(_SCHEDULE)
    + """, counted as (
        select count(*) filter (where trip_id is null) as trip_id,
          count(*) filter (where stop_id is null) as stop_id,
          count(*) filter (where stop_sequence is null) as stop_sequence,
          count(*) filter (where day_offset is null) as day_offset,
          count(*) filter (where operator_id is null) as operator_id
        from schedule)
      select column_name, nulls from (unpivot counted on columns(*) into name column_name value nulls)""",
    "t1_retention": _with(_FACT)
    + """select ts, trip_id, stop_id, stop_sequence, status from fact
      where cast(ts as date) + interval 1 day > timestamp '2024-02-10 12:00:00' - interval 30 day""",
    "t2_run_retention": _with(_RUNS)
    + """select started_at, status from runs
      where date_trunc('week', started_at) + interval 7 day > timestamp '2000-06-15 12:00:00' - interval 90 day""",
    "a1_line_15m": _with(_FACT) + _aggregate("15 minutes", _LINE_KEYS),
    "a2_line_1h": _with(_FACT) + _aggregate("1 hour", _LINE_KEYS),
    "a3_line_1d": _with(_FACT) + _aggregate("1 day", _LINE_KEYS),
    "a4_stop_15m": _with(_FACT) + _aggregate("15 minutes", _STOP_KEYS),
    "a11_refresh_window": _with(
        _FACT,
        "observed as (select * from fact where status = 'OBSERWACJA')",
        f"stored as ({_aggregate('15 minutes', _LINE_KEYS, 'observed')})",
        f"fresh as ({_aggregate('15 minutes', _LINE_KEYS)})",
    )
    + """select * from stored
        where not (bucket >= timestamp '2024-01-13 10:15:00' and bucket < timestamp '2024-01-20 09:45:00')
      union all select * from fresh
        where bucket >= timestamp '2024-01-13 10:15:00' and bucket < timestamp '2024-01-20 09:45:00'""",
    "a11_refresh_all": _levels(
        agg_line_15m=("2024-01-13 10:15:00", "2024-01-20 09:45:00"),
        agg_stop_15m=("2024-01-13 10:15:00", "2024-01-20 09:45:00"),
        agg_line_1h=("2024-01-13 10:15:00", "2024-01-20 09:00:00"),
        agg_line_1d=("2024-01-13 10:15:00", "2024-01-19 23:00:00"),
    ),
    "a11_invalidated": _levels(),
    "a12_backfill_chunks": _levels(),
    "a1_streamed_windows": _with(_FACT) + _aggregate("15 minutes", _LINE_KEYS),
    "a3_streamed_windows": _with(_FACT) + _aggregate("1 day", _LINE_KEYS),
    "k1_punctuality": _with(_FACT, _AGG)
    + f"""select cast(sum(on_time) as bigint) as on_time, {_OBS},
        round(sum(on_time) / sum(obs), 6) as punctuality from agg""",
    "k2_delay_by_line": _with(_FACT, _AGG, _LINES)
    + f"""select a.line_id, short_name, mode, line_type, {_OBS},
        cast(sum(delay_sum) as bigint) as delay_sum, {_RATES}
      from agg a left join line on a.line_id = line.line_id group by a.line_id, short_name, mode, line_type""",
    "k2_delay_by_operator": _with(_FACT, _AGG, _OPERATORS)
    + f"""select a.operator_id, o.name as operator_name, {_OBS},
        cast(sum(delay_sum) as bigint) as delay_sum, {_RATES}
      from agg a left join operator o on a.operator_id = o.operator_id group by a.operator_id, o.name""",
    "k3_cancelled_lines": _with(_FACT, _AGG, _LINES)
    + f"""select a.line_id, short_name, {_CANCELLED}
      from agg a left join line on a.line_id = line.line_id group by a.line_id, short_name
      order by cancelled desc, a.line_id limit 10""",
    "k3_cancelled_trips": _with(_FACT)
    + """select line_id, trip_id, count(distinct service_date) as days, count(*) as rows
      from fact where status = 'ANULOWANY' group by line_id, trip_id
      order by days desc, rows desc, trip_id, line_id limit 10""",
    "k3_cancelled_trips_by_line": _with(_FACT)
    + """select line_id, count(distinct (trip_id, service_date)) as cancelled_trips
      from fact where status = 'ANULOWANY' group by line_id""",
    "k4_delay_map": _with(_FACT, _STOPS)
    + """select f.stop_id, s.name, s.lat, s.lon, count(*) as obs, round(sum(delay_s) / count(*), 6) as mean_delay_s
      from fact f left join stop s on s.stop_id = f.stop_id where status = 'OBSERWACJA'
      group by f.stop_id, s.name, s.lat, s.lon""",
    "k5_by_day_type": _with(_FACT, _AGG, _CALENDAR)
    + f"""select day_type, {_OBS}, {_CANCELLED}, {_SKIPPED}, {_RATES}
      from agg left join dates on service_date = dates.date group by day_type""",
    "k5_by_weekday": _with(_FACT, _AGG, _CALENDAR)
    + f"""select month, iso_dow, day_name, {_OBS}, {_CANCELLED}, {_SKIPPED}, {_RATES}
      from agg left join dates on service_date = dates.date group by month, iso_dow, day_name""",
    "k6_by_version": _with(_FACT, _AGG, _VERSIONS)
    + f"""select a.version_id, package_names, valid_from, valid_to, {_OBS}, {_CANCELLED}, {_RATES}
      from agg a left join version v on v.version_id = a.version_id
      group by a.version_id, package_names, valid_from, valid_to""",
    "k7_health": _with(_RUNS)
    + """select status, cast(started_at as date) as day, count(*) as cycles,
        cast(sum(observed) as bigint) as observed, cast(sum(inserted) as bigint) as inserted,
        max(seconds) as max_seconds from runs group by all""",
    "k7_failures": _with(_RUNS)
    + """select started_at, snapshot_ts, error from runs where status = 'ERROR'
      order by started_at desc, snapshot_ts desc limit 20""",
    "k8_recent_by_line": _recent("line_id", "L3"),
    "k8_recent_by_operator": _recent("operator_id", "O2"),
    "k8_recent_stored": _recent("line_id", "L3", "-infinity"),
}
# the same rows, by the jobs on stored tables
_STORED = {
    "t1_retention_stored": "t1_retention",
    "t2_run_retention_stored": "t2_run_retention",
    "a11_refresh_stored": "a11_refresh_window",
    "k7_failures_stored": "k7_failures",
}
for _job, _rule in _STORED.items():
    ORACLE[_job] = ORACLE[_rule]
