from __future__ import annotations

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tremorlane.functions import (
    SEVERITY_LABELS,
    coordinate,
    first_filled,
    number_or_zero,
    parse_event_time,
    severity_label,
)


def evaluate(spark, kind, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, x {kind}")
    result = rows.select("i", expression(F.col("x")).alias("y")).collect()
    return [row.y for row in sorted(result)]


def test_bands_are_closed_on_the_left(spark):
    values = [-1.0, 0.0, 1.99, 2.0, 2.99, 3.0, 4.0, 4.99, 5.0, 9.0, math.inf, math.nan, None]
    assert evaluate(spark, "DOUBLE", values, severity_label) == [
        "MINOR", "MINOR", "MINOR", "LIGHT", "LIGHT", "MODERATE", "STRONG", "STRONG",
        "MAJOR", "MAJOR", "MAJOR", "MAJOR", "MAJOR",
    ]


def test_every_value_is_in_exactly_one_band(spark):
    edges = [-math.inf, 2.0, 3.0, 4.0, 5.0, math.inf]
    values = [i / 7 - 2 for i in range(80)]
    expected = [
        next(name for name, lo, hi in zip(SEVERITY_LABELS, edges, edges[1:]) if lo <= v < hi)
        for v in values
    ]
    assert evaluate(spark, "DOUBLE", values, severity_label) == expected


def test_missing_magnitude_can_have_its_own_label(spark):
    labels = evaluate(
        spark, "DOUBLE", [1.0, None, math.nan], lambda x: severity_label(x, null_label="UNKNOWN")
    )
    assert labels == ["MINOR", "UNKNOWN", "UNKNOWN"]


ACCEPTED = datetime(2026, 6, 2, 0, 34, 5)
TIMES = {
    "2026-06-02 00:34:05": ACCEPTED,
    "2026.06.02 00:34:05": ACCEPTED,
    "2024-02-29 23:59:59": datetime(2024, 2, 29, 23, 59, 59),
    "2026-06-02 0:34:05": None,
    "2026-06-02T00:34:05": None,
    "2026-06-02 00:34:05.1": None,
    "2026-06-02 00:34:0Z": None,
    "2026-06-02 00:34:05\n": None,
    " 2026-06-02 00:34:05": None,
    "2026.06-02 00:34:05": None,
    "2026/06/02 00:34:05": None,
    "2026-02-30 00:00:00": None,
    "2026-06-02 24:00:00": None,
    "0000-06-02 00:34:05": None,
    "2026-06-02": None,
    "": None,
    None: None,
}


@pytest.mark.parametrize("zone", ["UTC", "Europe/Istanbul", "America/New_York"])
def test_event_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        parsed = evaluate(spark, "STRING", list(TIMES), parse_event_time)
        # an hour that daylight saving skips in New York
        skipped = evaluate(spark, "STRING", ["2026-03-08 02:30:00"], parse_event_time)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert parsed == list(TIMES.values())
    assert skipped == [datetime(2026, 3, 8, 2, 30)]


def test_numbers(spark):
    cases = {
        "3.4": 3.4, " 3.4 ": 3.4, "1e2": 100.0, "-1": -1.0, "inf": math.inf, "0": 0.0,
        None: 0.0, "": 0.0,
        "abc": None, "1d": None, "2.5f": None, "0x1p3": None, "1_0": None, " ": None,
    }
    assert evaluate(spark, "STRING", list(cases), number_or_zero) == list(cases.values())


def test_coordinates(spark):
    lists = [["29.1", "40.2"], ["29.1"], [], None, [None, "40.2"], ["x", "1"]]
    assert evaluate(spark, "ARRAY<STRING>", lists, lambda x: coordinate(x, 0)) == [
        29.1, 29.1, 0.0, 0.0, None, None,
    ]
    assert evaluate(spark, "ARRAY<STRING>", lists, lambda x: coordinate(x, 1)) == [
        40.2, 0.0, 0.0, 0.0, 40.2, 1.0,
    ]


def test_first_filled(spark):
    pairs = [("a", "b"), ("", "b"), (None, "b"), ("", None), (None, None), ("", "")]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i INT, a STRING, b STRING")
    result = rows.select("i", first_filled(F.col("a"), F.col("b")).alias("y")).orderBy("i")
    assert [row.y for row in result.collect()] == ["a", "b", "b", "", "", ""]
