"""Nested event to flat record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorlane.functions import coordinate, first_filled, number_or_zero


def flatten_events(
    df: DataFrame, *, default_provider: str, event: str = "event", carry: tuple[str, ...] = ()
) -> DataFrame:
    """The nine flat columns of the `event` struct, plus the columns in `carry`.

    Coordinates come as [longitude, latitude].
    """
    raw = F.col(event)
    coordinates = raw["geojson"]["coordinates"]
    place = raw["location_properties"]
    return df.select(
        *carry,
        F.coalesce(raw["earthquake_id"], F.lit("")).alias("earthquake_id"),
        F.coalesce(raw["provider"], F.lit(default_provider)).alias("provider"),
        F.coalesce(raw["title"], F.lit("")).alias("title"),
        number_or_zero(raw["mag"]).alias("magnitude"),
        number_or_zero(raw["depth"]).alias("depth"),
        coordinate(coordinates, 1).alias("latitude"),
        coordinate(coordinates, 0).alias("longitude"),
        first_filled(place["epiCenter"]["name"], place["closestCity"]["name"]).alias("region"),
        first_filled(raw["date_time"], raw["date"]).alias("event_time"),
    )
