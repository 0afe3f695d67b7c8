"""Record shapes, as DDL strings that every Spark reader accepts."""

from __future__ import annotations

# Field names and order of the flat event record.
FLAT_COLUMNS = {
    "earthquake_id": "STRING",
    "provider": "STRING",
    "title": "STRING",
    "magnitude": "DOUBLE",
    "depth": "DOUBLE",
    "latitude": "DOUBLE",
    "longitude": "DOUBLE",
    "region": "STRING",
    "event_time": "STRING",
}

ENRICHED_COLUMNS = FLAT_COLUMNS | {"severity": "STRING", "event_ts": "TIMESTAMP_NTZ"}

# Column order of the clustered table.
CLUSTERED_COLUMNS = {
    "earthquake_id": "STRING",
    "provider": "STRING",
    "title": "STRING",
    "magnitude": "DOUBLE",
    "depth": "DOUBLE",
    "latitude": "DOUBLE",
    "longitude": "DOUBLE",
    "region": "STRING",
    "severity": "STRING",
    "event_time": "STRING",
    "cluster": "INT",
}

SUMMARY = "severity STRING, magnitude DOUBLE, n BIGINT"

MONITOR_COLUMNS = ("event_time", "magnitude", "depth", "severity", "region")


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())


FLAT = ddl(FLAT_COLUMNS)
ENRICHED = ddl(ENRICHED_COLUMNS)
CLUSTERED = ddl(CLUSTERED_COLUMNS)

# A nested event as the feed sends it. Scalars whose JSON type varies between
# events (number or text) are read as text and converted in `flatten_events`.
RAW_EVENT_COLUMNS = {
    "earthquake_id": "STRING",
    "provider": "STRING",
    "title": "STRING",
    "mag": "STRING",
    "depth": "STRING",
    "geojson": "STRUCT<coordinates: ARRAY<STRING>>",
    "location_properties": (
        "STRUCT<epiCenter: STRUCT<name: STRING>, closestCity: STRUCT<name: STRING>>"
    ),
    "date_time": "STRING",
    "date": "STRING",
}
RAW_EVENT = ddl(RAW_EVENT_COLUMNS)
RAW_EVENT_STRUCT = (
    "STRUCT<" + ", ".join(f"{name}: {kind}" for name, kind in RAW_EVENT_COLUMNS.items()) + ">"
)

# A response page. `poll` and `feed` come from the landing directory
# (poll=0/feed=live/...); `page` orders the pages within one of these.
PAGE_JSON = f"page BIGINT, result ARRAY<{RAW_EVENT_STRUCT}>, _corrupt_record STRING"
PAGE = f"{PAGE_JSON}, poll INT, feed STRING"
