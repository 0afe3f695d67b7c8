"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY_COLUMNS = ("latitude", "longitude", "magnitude")


def drop_incomplete(df: DataFrame, columns: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    """Rows where every one of the columns is present and not NaN.

    Written as plain null tests, which reach the Parquet scan; `na.drop` says
    the same but is evaluated only after the rows were read.
    """
    present = (F.col(name).isNotNull() & ~F.isnan(name) for name in columns)
    return df.where(reduce(lambda left, right: left & right, present))


def drop_null_island(df: DataFrame) -> DataFrame:
    """Leave out rows located at exactly (0, 0)."""
    return df.where((F.col("latitude") != 0.0) | (F.col("longitude") != 0.0))


def clean_events(df: DataFrame) -> DataFrame:
    return df.transform(drop_incomplete).transform(drop_null_island)


def require_id(df: DataFrame, key: str = "earthquake_id") -> DataFrame:
    return df.where(F.col(key).isNotNull() & (F.col(key) != ""))


def within_box(
    df: DataFrame,
    longitude: tuple[float, float] = (25.0, 45.0),
    latitude: tuple[float, float] = (35.0, 43.0),
) -> DataFrame:
    return df.where(
        F.col("longitude").between(*longitude) & F.col("latitude").between(*latitude)
    )
