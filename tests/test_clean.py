from __future__ import annotations

import math
from datetime import datetime

from tremorlane.operators import (
    archive_window,
    clean_events,
    enrich,
    live_window,
    require_id,
    within_box,
)
from tremorlane.sources import read_enriched

POINT = "id STRING, latitude DOUBLE, longitude DOUBLE, magnitude DOUBLE"


def ids(df, column: str = "id") -> list:
    return sorted(row[column] for row in df.collect())


def test_clean_events(spark):
    rows = [
        ("ok", 1.0, 2.0, 3.0),
        ("no-lat", None, 2.0, 3.0),
        ("nan-lon", 1.0, math.nan, 3.0),
        ("nan-mag", 1.0, 2.0, math.nan),
        ("no-mag", 1.0, 2.0, None),
        ("island", 0.0, 0.0, 3.0),
        ("minus-zero", -0.0, 0.0, 3.0),
        ("equator", 0.0, 2.0, 3.0),
        ("meridian", 1.0, 0.0, 3.0),
        ("infinite", 1.0, 2.0, math.inf),
    ]
    df = spark.createDataFrame(rows, POINT)
    assert ids(clean_events(df)) == ["equator", "infinite", "meridian", "ok"]


def test_null_tests_reach_the_parquet_scan(spark, tmp_path):
    rows = [("ok", 1.0, 2.0, 3.0)]
    spark.createDataFrame(rows, POINT).write.parquet(str(tmp_path / "t"))
    plan = (
        clean_events(read_enriched(spark, str(tmp_path / "t"), POINT))
        .select("magnitude")
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    pushed = plan[plan.index("PushedFilters") :]
    for name in ("latitude", "longitude", "magnitude"):
        assert f"IsNotNull({name})" in pushed
    assert "id:string" not in pushed[pushed.index("ReadSchema") :]


def test_time_windows_reach_the_parquet_scan(spark, tmp_path):
    timed(spark).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    for window in (live_window, archive_window):
        plan = window(stored, datetime(2026, 6, 9, 12))._jdf.queryExecution().executedPlan()
        pushed = plan.toString()[plan.toString().index("PushedFilters") :]
        assert "GreaterThan" in pushed and "LessThan" in pushed and "event_ts" in pushed


def test_require_id(spark):
    df = spark.createDataFrame([("a",), ("",), (None,), (" ",)], "earthquake_id STRING")
    assert ids(require_id(df), "earthquake_id") == [" ", "a"]


def test_box_is_closed(spark):
    rows = [
        ("corner", 35.0, 25.0, 1.0),
        ("other-corner", 43.0, 45.0, 1.0),
        ("north", 43.01, 30.0, 1.0),
        ("west", 40.0, 24.99, 1.0),
    ]
    assert ids(within_box(spark.createDataFrame(rows, POINT))) == ["corner", "other-corner"]


def timed(spark):
    times = [
        "2026-06-09 12:00:00",
        "2026-06-09 00:00:00",
        "2026.06.08 12:00:01",
        "2026-06-08 12:00:00",
        "2026-06-02 00:00:00",
        "2026-06-01 23:59:59",
        "2026-06-09 18:00:00",
        "bad",
    ]
    rows = [(f"e{i}", time, 1.0) for i, time in enumerate(times)]
    schema = "earthquake_id STRING, event_time STRING, magnitude DOUBLE"
    return enrich(spark.createDataFrame(rows, schema))


def test_live_window(spark):
    as_of = datetime(2026, 6, 9, 12)
    assert ids(live_window(timed(spark), as_of), "earthquake_id") == ["e0", "e1", "e2"]
    newest = live_window(timed(spark), as_of, limit=2).collect()
    assert [row.earthquake_id for row in newest] == ["e0", "e1"]


def test_archive_window_takes_whole_days(spark):
    window = archive_window(timed(spark), datetime(2026, 6, 9, 12))
    assert ids(window, "earthquake_id") == ["e0", "e1", "e2", "e3", "e4", "e6"]


def test_equal_times_are_ordered_by_id(spark):
    rows = [(name, "2026-06-09 00:00:00", 1.0) for name in "dbca"]
    df = enrich(
        spark.createDataFrame(rows, "earthquake_id STRING, event_time STRING, magnitude DOUBLE")
    )
    newest = live_window(df, datetime(2026, 6, 9, 1), limit=3).collect()
    assert [row.earthquake_id for row in newest] == ["a", "b", "c"]
