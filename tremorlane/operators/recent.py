"""Selections of recent events, relative to a given moment."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def newest(df: DataFrame, limit: int) -> DataFrame:
    """The `limit` newest events; equal times are ordered by id.

    Each task keeps its own `limit` rows, so only these are brought together.
    """
    return df.orderBy(F.col("event_ts").desc(), "earthquake_id").limit(limit)


def live_window(
    df: DataFrame, as_of: datetime, hours: int = 24, limit: int | None = None
) -> DataFrame:
    """The events of the `hours` before `as_of`; with a limit, the newest of them."""
    since = as_of - timedelta(hours=hours)
    recent = df.where((F.col("event_ts") > _moment(since)) & (F.col("event_ts") <= _moment(as_of)))
    return recent if limit is None else newest(recent, limit)


def archive_window(
    df: DataFrame, as_of: datetime, days: int = 7, limit: int | None = None
) -> DataFrame:
    """The events of the `days` calendar days before `as_of`, and its own.

    Day bounds are compared as moments, so the filter reaches the scan. With a
    limit, the newest of them.
    """
    today = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    first, after_last = today - timedelta(days=days), today + timedelta(days=1)
    ranged = df.where(
        (F.col("event_ts") >= _moment(first)) & (F.col("event_ts") < _moment(after_last))
    )
    return ranged if limit is None else newest(ranged, limit)


def _moment(value: datetime):
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
