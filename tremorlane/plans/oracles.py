"""The registered queries as SQL for DuckDB, over the same tables."""

from __future__ import annotations

_LATITUDE = "35.0::double + (user_id % 80) / 10.0::double"
_LONGITUDE = "25.0::double + (event_id % 200) / 10.0::double"
_DASHED = "strftime(ts, '%Y-%m-%d %H:%M:%S')"
_DOTTED = "strftime(ts, '%Y.%m.%d %H:%M:%S')"

_FLAT = f"""
flat as (
  select event_id::varchar as earthquake_id,
         event_type as provider,
         event_type || '-' || user_id::varchar as title,
         case when event_id % 89 = 0 then null else value / 50.0::double end as magnitude,
         json_extract_string(props, '$.k')::double as depth,
         case when event_id % 97 = 0 then 0.0::double else {_LATITUDE} end as latitude,
         case when event_id % 97 = 0 then 0.0::double else {_LONGITUDE} end as longitude,
         case when event_id % 3 = 0 then event_type
              else 'cell-' || (user_id % 10)::varchar end as region,
         case when event_id % 101 = 0 then ''
              when event_id % 2 = 0 then {_DASHED} else {_DOTTED} end as event_time
  from events
)"""


def _enriched_from(name: str) -> str:
    return f"""
enriched as (
  select *,
         case when isnan(magnitude) or magnitude is null then 'MAJOR'
              when magnitude < 2.0::double then 'MINOR'
              when magnitude < 3.0::double then 'LIGHT'
              when magnitude < 4.0::double then 'MODERATE'
              when magnitude < 5.0::double then 'STRONG'
              else 'MAJOR' end as severity,
         coalesce(try_strptime(event_time, '%Y-%m-%d %H:%M:%S'),
                  try_strptime(event_time, '%Y.%m.%d %H:%M:%S')) as event_ts
  from {name}
)"""


_CLEAN = """
clean as (
  select * from enriched
  where latitude is not null and longitude is not null and magnitude is not null
    and not isnan(latitude) and not isnan(longitude) and not isnan(magnitude)
    and (latitude <> 0.0::double or longitude <> 0.0::double)
)"""

_ENRICHED = f"with {_FLAT}, {_enriched_from('flat')}"
_CLEANED = f"{_ENRICHED}, {_CLEAN}"


def _raw(*polls: tuple[int, str, str]) -> str:
    parts = " union all ".join(
        f"select {poll} as poll, '{feed}' as feed, * from events where {condition}"
        for poll, feed, condition in polls
    )
    return f"""
polled as ({parts}),
raw as (
  select poll, feed, event_id, user_id,
         case when event_id % 211 = 0 then '' when event_id % 223 = 0 then null
              else event_id::varchar end as earthquake_id,
         case when event_id % 31 = 0 then null else event_type end as provider,
         event_type || '-' || feed || '-' || poll::varchar as title,
         case when event_id % 89 = 0 then null when event_id % 83 = 0 then null
              when event_id % 79 = 0 then null else value / 50.0::double end as mag,
         event_id % 89 = 0 or event_id % 83 = 0 as no_mag,
         json_extract_string(props, '$.k')::double as depth,
         case when event_id % 73 = 0 then -1 when event_id % 97 = 0 then 0
              when event_id % 61 = 0 then 1 else 2 end as n_coordinates,
         {_LATITUDE} as lat,
         {_LONGITUDE} as lon,
         case when event_id % 3 = 0 then event_type when event_id % 3 = 1 then '' end as epicentre,
         'cell-' || (user_id % 10)::varchar as city,
         case when event_id % 2 = 0 then {_DASHED} else '' end as date_time,
         case when event_id % 101 = 0 then null else {_DOTTED} end as date
  from polled
),
flattened as (
  select poll, feed,
         coalesce(earthquake_id, '') as earthquake_id,
         coalesce(provider, 'network') as provider,
         title,
         case when no_mag then 0.0::double else mag end as magnitude,
         depth,
         case when n_coordinates > 1 then lat else 0.0::double end as latitude,
         case when n_coordinates > 0 then lon else 0.0::double end as longitude,
         coalesce(nullif(epicentre, ''), city, '') as region,
         coalesce(nullif(date_time, ''), date, '') as event_time
  from raw
),
arrivals as (
  select *, row_number() over (
             partition by earthquake_id
             order by poll, case when feed = 'live' then 0 else 1 end) as arrival
  from flattened where earthquake_id <> ''
),
fresh as (select * exclude (poll, feed, arrival) from arrivals where arrival = 1)"""


_LIVE_AND_ARCHIVE = _raw(
    (0, "live", "ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-20'"),
    (0, "archive", "ts < timestamp '2024-01-20'"),
    (1, "live", "true"),
)
#: With a busy first poll the gate is shut: its archive stays out.
_LIVE_AND_ARCHIVE_SHUT = _raw(
    (0, "live", "ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-20'"),
    (1, "live", "true"),
)
_QUIET = _raw((0, "archive", "ts < timestamp '2024-01-20'"), (1, "live", "true"))


def _live(as_of: str) -> str:
    return f"""
select * from enriched
where event_ts > timestamp '{as_of}' - interval 24 hours and event_ts <= timestamp '{as_of}'"""


def _archive(as_of: str) -> str:
    return f"""
select * from enriched
where event_ts::date between timestamp '{as_of}'::date - 7 and timestamp '{as_of}'::date"""


def _backfill(day: str, as_of: str) -> str:
    return f"""
select '{day}' as day, 'live' as feed, earthquake_id, event_ts from ({_live(as_of)})
union all
select '{day}' as day, 'archive' as feed, earthquake_id, event_ts from ({_archive(as_of)})
where (select count(*) from ({_live(as_of)})) < 10"""


_HISTOGRAM = """
span as (
  select case when min(magnitude) = max(magnitude) then min(magnitude) - 0.5::double
              else min(magnitude) end as lo,
         case when min(magnitude) = max(magnitude) then max(magnitude) + 0.5::double
              else max(magnitude) end as hi
  from clean
),
edges as (
  select i::integer as bin,
         span.lo + i::double * ((span.hi - span.lo) / 20.0::double) as lo,
         case when i = 19 then span.hi
              else span.lo + (i + 1)::double * ((span.hi - span.lo) / 20.0::double) end as hi
  from range(20) as t(i), span
),
histogram as (
  select bin, lo, hi,
         (select count(*) from clean
          where magnitude >= lo and (magnitude < hi or (bin = 19 and magnitude = hi))) as n
  from edges
)"""

_DOMAIN = "(values ('MINOR'), ('LIGHT'), ('MODERATE'), ('STRONG'), ('MAJOR')) as d(severity)"
_SEVERITY_COUNTS = f"""
select d.severity, count(clean.severity) as n
from {_DOMAIN} left join clean on clean.severity = d.severity group by d.severity"""

_BOX = """
from clean where longitude between 25.0::double and 45.0::double
  and latitude between 35.0::double and 43.0::double"""

_FLAT_COLUMNS = (
    "earthquake_id, provider, title, magnitude, depth, latitude, longitude, region, event_time"
)

_CSV = f"""
{_ENRICHED}
select nullif(earthquake_id, '') as earthquake_id, nullif(provider, '') as provider,
       nullif(title, '') as title, magnitude, depth, latitude, longitude,
       nullif(region, '') as region, nullif(severity, '') as severity,
       nullif(event_time, '') as event_time
from enriched"""

ORACLES: dict[str, str] = {
    "job_rerun": f"""
with {_QUIET}, {_enriched_from('fresh')}, {_CLEAN}
select run, (select count(*) from clean) as n from (values (1), (2)) as runs(run)""",
    "nothing_left": f"""
{_ENRICHED},
removed as (select * from enriched where 0.0::double <> 0.0::double)
select report, (select count(*) from removed) as n
from (values ('clustered'), ('magnitude_hist'), ('severity_counts'), ('map_points')) as r(report)""",
    "event_report": f"""
with {_QUIET}, {_enriched_from('fresh')}, {_CLEAN}, {_HISTOGRAM}
select 'severity_counts' as report, severity as item, n from ({_SEVERITY_COUNTS})
union all select 'magnitude_hist', bin::varchar, n from histogram
union all select 'cluster_sizes', 'all clusters', count(*) from clean
union all select 'map_points', 'points shown', count(*) {_BOX}
union all select 'csv', 'rows', count(*) from clean
union all select 'enriched', 'times parsed', count(event_ts) from enriched""",
    "explode_pages": f"""
with {_LIVE_AND_ARCHIVE}
select poll, feed, earthquake_id, provider, title, mag, depth, n_coordinates, epicentre, city,
       date_time, date
from raw""",
    "flatten_events": f"with {_LIVE_AND_ARCHIVE} select {_FLAT_COLUMNS} from flattened",
    "dedup_first_seen": f"with {_LIVE_AND_ARCHIVE} select {_FLAT_COLUMNS} from fresh",
    "packed_pages": f"with {_LIVE_AND_ARCHIVE} select {_FLAT_COLUMNS} from fresh",
    "stream_dedup": f"with {_LIVE_AND_ARCHIVE} select {_FLAT_COLUMNS} from fresh",
    "state_dedup": f"with {_LIVE_AND_ARCHIVE} select earthquake_id from fresh",
    "continuous_ingest": (
        f"with {_LIVE_AND_ARCHIVE}, {_enriched_from('fresh')} select * from enriched"
    ),
    "gated_ingest": f"""
select * from (
  with {_QUIET}, {_enriched_from('fresh')} select *, 'quiet' as day from enriched)
union all
select * from (
  with {_LIVE_AND_ARCHIVE_SHUT}, {_enriched_from('fresh')} select *, 'busy' as day from enriched)""",
    "malformed_lines": f"""
{_ENRICHED}
select 'event' as kind, earthquake_id,
       case when earthquake_id::bigint % 59 <> 0 then magnitude end as magnitude,
       case when earthquake_id::bigint % 59 <> 0 then severity else 'MAJOR' end as severity,
       null::varchar as line
from enriched where earthquake_id::bigint % 53 <> 0
union all
select case when event_id % 53 = 0 then 'lost line' else 'salvaged line' end, null, null, null,
       case when event_id % 53 = 0 then '{{"earthquake_id": "' || event_id || '", "provider": '
            else '{{"earthquake_id": "' || event_id || '", "magnitude": "strong"}}' end
from events where event_id % 53 = 0 or event_id % 59 = 0""",
    "backfill_union": (
        f"{_ENRICHED} {_backfill('quiet', '2024-02-02')} union all "
        f"{_backfill('busy', '2024-01-31')}"
    ),
    "live_window": f"{_ENRICHED} {_live('2024-01-31')}",
    "newest_page": (
        f"{_ENRICHED} {_live('2024-01-31')} order by event_ts desc, earthquake_id limit 500"
    ),
    "archive_window": f"{_ENRICHED} {_archive('2024-01-31')}",
    "severity_label": f"{_ENRICHED} select earthquake_id, magnitude, severity from enriched",
    "parse_event_time": f"{_ENRICHED} select earthquake_id, event_time, event_ts from enriched",
    "enrich": f"{_ENRICHED} select * from enriched",
    "stream_ingest": f"{_ENRICHED} select * from enriched",
    "stream_monitor": (
        f"{_ENRICHED} select event_time, magnitude, depth, severity, region from enriched"
    ),
    "clean_events": f"{_CLEANED} select * from clean",
    "clean_count": f"{_CLEANED} select count(*) as n from clean",
    "map_points": f"""
{_CLEANED}
select longitude, latitude,
       greatest(magnitude, 0.0::double) * greatest(magnitude, 0.0::double) * 12 + 10
         as marker_size
{_BOX}""",
    "severity_counts": f"{_CLEANED} {_SEVERITY_COUNTS}",
    "magnitude_hist": f"{_CLEANED}, {_HISTOGRAM} select bin, lo, hi, n from histogram",
    "running_reports": f"""
{_CLEANED}, {_HISTOGRAM}
select 'rows' as report, 'all' as item, null::double as lo, count(*) as n from clean
union all select 'severity', severity, null, n from ({_SEVERITY_COUNTS})
union all select 'magnitude', bin::varchar, lo, n from histogram""",
    "standardize": f"""
{_CLEANED}
select earthquake_id,
       round(latitude / (select stddev_samp(latitude) from clean), 6) as latitude_std,
       round(longitude / (select stddev_samp(longitude) from clean), 6) as longitude_std,
       round(magnitude / (select stddev_samp(magnitude) from clean), 6) as magnitude_std
from clean""",
    "jsonl_roundtrip": f"with {_FLAT} select * from flat",
    "csv_roundtrip": _CSV,
    "csv_single_file": _CSV,
    "stream_labels": f"""
{_CLEANED}
select earthquake_id, provider, title, magnitude, depth, latitude, longitude, region, severity,
       event_time, true as same
from clean""",
    "cluster_events": f"""
{_CLEANED}
select earthquake_id, provider, title, magnitude, depth, latitude, longitude, region, severity,
       event_time, true as nearest
from clean""",
    "cluster_sizes": (
        f"{_CLEANED} select 5::bigint as n_clusters, count(*) as n_rows, 5::bigint as n_recounted "
        "from clean"
    ),
    "cluster_check": (
        f"{_CLEANED} select count(*) as n_rows, 5::bigint as n_clusters, 0::bigint as n_misplaced, "
        "true as centres_are_means, true as loss_is_low from clean"
    ),
}
