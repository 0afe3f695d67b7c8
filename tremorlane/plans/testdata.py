"""Event records derived from the `events` table of the test data.

The data-quality cases (missing values, odd spellings, empty positions) are
spread over the whole table by the event id; no row is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorlane.schemas import RAW_EVENT_COLUMNS
from tremorlane.sources.pages import explode_pages, read_pages
from tremorlane.staging import fresh_dir

DEFAULT_PROVIDER = "network"
EVENTS_PER_PAGE = 500

_LATITUDE = "35.0D + (user_id % 80) / 10.0D"
_LONGITUDE = "25.0D + (event_id % 200) / 10.0D"
_DASHED = "date_format(ts, 'yyyy-MM-dd HH:mm:ss')"
_DOTTED = "date_format(ts, 'yyyy.MM.dd HH:mm:ss')"

_FLAT = {
    "earthquake_id": "cast(event_id as string)",
    "provider": "event_type",
    "title": "concat(event_type, '-', cast(user_id as string))",
    "magnitude": "case when event_id % 89 = 0 then null else value / 50.0D end",
    "depth": "cast(get_json_object(props, '$.k') as double)",
    "latitude": f"case when event_id % 97 = 0 then 0.0D else {_LATITUDE} end",
    "longitude": f"case when event_id % 97 = 0 then 0.0D else {_LONGITUDE} end",
    "region": (
        "case when event_id % 3 = 0 then event_type "
        "else concat('cell-', cast(user_id % 10 as string)) end"
    ),
    "event_time": (
        f"case when event_id % 101 = 0 then '' when event_id % 2 = 0 then {_DASHED} "
        f"else {_DOTTED} end"
    ),
}

_RAW = {
    "earthquake_id": (
        "case when event_id % 211 = 0 then '' when event_id % 223 = 0 then null "
        "else cast(event_id as string) end"
    ),
    "provider": "case when event_id % 31 = 0 then null else event_type end",
    "title": "concat(event_type, '-', feed, '-', cast(poll as string))",
    "mag": (
        "case when event_id % 89 = 0 then null when event_id % 83 = 0 then '' "
        "when event_id % 79 = 0 then 'n/a' else cast(value / 50.0D as string) end"
    ),
    "depth": "cast(get_json_object(props, '$.k') as double)",
    "geojson": (
        "case when event_id % 73 = 0 then null else named_struct('coordinates', "
        "case when event_id % 97 = 0 then cast(array() as array<double>) "
        f"when event_id % 61 = 0 then array({_LONGITUDE}) "
        f"else array({_LONGITUDE}, {_LATITUDE}) end) end"
    ),
    "location_properties": (
        "named_struct('epiCenter', case when event_id % 3 = 0 then named_struct('name', event_type) "
        "when event_id % 3 = 1 then named_struct('name', '') else null end, "
        "'closestCity', named_struct('name', concat('cell-', cast(user_id % 10 as string))))"
    ),
    "date_time": f"case when event_id % 2 = 0 then {_DASHED} else '' end",
    "date": f"case when event_id % 101 = 0 then null else {_DOTTED} end",
}
assert list(_RAW) == list(RAW_EVENT_COLUMNS)


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def flat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_table(spark, sf_dir).selectExpr(
        *(f"{expression} as {name}" for name, expression in _FLAT.items())
    )


_UNFINISHED = "concat('{\"earthquake_id\": \"', event_id, '\", \"provider\": ')"
_WRONG_TYPE = "concat('{\"earthquake_id\": \"', event_id, '\", \"magnitude\": \"strong\"}')"


def land_broken_lines(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The flat events as JSON lines, some of them cut off and some with text for a number."""
    fields = ", ".join(f"'{name}', {expression}" for name, expression in _FLAT.items())
    events_table(spark, sf_dir).selectExpr(
        f"case when event_id % 53 = 0 then {_UNFINISHED} when event_id % 59 = 0 then {_WRONG_TYPE}"
        f" else to_json(named_struct({fields})) end as value"
    ).write.text(path)


# Polls of the feed. The first poll sees the events up to its own time, part of
# them in the live feed and all of them in the archive; the second sees all.
LIVE_AND_ARCHIVE_POLLS = (
    (0, "live", "ts >= timestamp_ntz'2024-01-10' and ts < timestamp_ntz'2024-01-20'"),
    (0, "archive", "ts < timestamp_ntz'2024-01-20'"),
    (1, "live", "true"),
)
QUIET_FIRST_POLL = (
    (0, "archive", "ts < timestamp_ntz'2024-01-20'"),
    (1, "live", "true"),
)


def land_pages(
    spark: SparkSession, sf_dir: str, polls: tuple[tuple[int, str, str], ...], path: str
) -> None:
    """Write the polls as response pages, in poll=<n>/feed=<name> folders.

    The events are read and shuffled once, by page, before each is repeated
    for every poll that saw it. Pages are filled by row position, so no page
    exceeds its size whatever the keys.
    """
    seen_by = ", ".join(
        f"case when {condition} then named_struct('poll', {poll}, 'feed', '{feed}') end"
        for poll, feed, condition in polls
    )
    (
        events_table(spark, sf_dir)
        .withColumn("page", F.expr(f"monotonically_increasing_id() div {EVENTS_PER_PAGE}"))
        .repartition("page")
        .withColumn("seen_by", F.explode(F.expr(f"array_compact(array({seen_by}))")))
        .select("*", "seen_by.poll", "seen_by.feed")
        .select(
            "poll",
            "feed",
            "page",
            F.struct(*(F.expr(text).alias(name) for name, text in _RAW.items())).alias("event"),
        )
        .groupBy("poll", "feed", "page")
        .agg(F.sort_array(F.collect_list("event")).alias("result"))
        .write.mode("append")
        .partitionBy("poll", "feed")
        .json(path)
    )


def landed_events(
    spark: SparkSession, sf_dir: str, polls: tuple[tuple[int, str, str], ...]
) -> DataFrame:
    """Raw events read back from landed pages."""
    path = fresh_dir(spark, "pages")
    land_pages(spark, sf_dir, polls, path)
    return explode_pages(read_pages(spark, path))
