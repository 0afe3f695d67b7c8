from __future__ import annotations

from datetime import datetime, timedelta

from tremorlane.operators import archive_window, live_window

AS_OF = datetime(2024, 1, 31, 12)


def test_windows_are_whole_unless_a_limit_is_asked_for(spark):
    rows = [(f"e{i}", AS_OF - timedelta(minutes=i)) for i in range(1500)]
    rows += [("late", AS_OF + timedelta(seconds=1)), ("none", None)]
    df = spark.createDataFrame(rows, "earthquake_id STRING, event_ts TIMESTAMP_NTZ").repartition(4)
    assert live_window(df, AS_OF).count() == 24 * 60
    assert archive_window(df, AS_OF).count() == 1501
    newest = live_window(df, AS_OF, limit=500)
    assert {row.earthquake_id for row in newest.collect()} == {f"e{i}" for i in range(500)}
    assert "Sort" not in live_window(df, AS_OF)._jdf.queryExecution().optimizedPlan().toString()
