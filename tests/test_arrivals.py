from __future__ import annotations

import random

from pyspark.sql import functions as F

from tremorlane.operators import backfill_union, first_seen
from tremorlane.plans.job import admitted_events, arrival_order

PLACED = "poll INT, feed STRING, page BIGINT, file STRING, line BIGINT, pos INT, id STRING"


def arrivals(spark, n: int, hot: float):
    """Random arrivals; one id holds a share `hot` of them."""
    rng = random.Random(7)
    rows = []
    for i in range(n):
        name = "hot" if rng.random() < hot else f"id{rng.randrange(n // 4)}"
        feed = rng.choice(["live", "archive"])
        rows.append((rng.randrange(3), feed, rng.randrange(5), "f", 0, i, name))
    return rows, spark.createDataFrame(rows, PLACED).repartition(8)


def test_first_seen_equals_a_walk_in_arrival_order(spark):
    rows, df = arrivals(spark, 4000, hot=0.4)
    kept = {}
    for row in sorted(rows, key=lambda r: (r[0], r[1] != "live", r[2], r[5])):
        kept.setdefault(row[6], row)
    result = first_seen(df, "id", arrival_order())
    assert sorted(tuple(row) for row in result.collect()) == sorted(kept.values())
    again = first_seen(result, "id", arrival_order())
    assert sorted(again.collect()) == sorted(result.collect())


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    _, df = arrivals(spark, 4000, hot=0.4)
    result = first_seen(df, "id", arrival_order())
    plan = result._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning(id")
    assert "WindowGroupLimit" in plan[exchange:]


def test_gate(spark):
    archive = spark.range(100, 105).select(F.col("id").cast("string").alias("id"))
    for n, total in ((0, 5), (9, 14), (10, 10), (25, 25)):
        live = spark.range(n).select(F.col("id").cast("string").alias("id"))
        assert backfill_union(live, archive).count() == total
    ten = spark.range(10).select(F.col("id").cast("string").alias("id"))
    doubled = backfill_union(ten, ten, threshold=11)  # a bag: equal rows all stay
    assert doubled.count() == 20


def test_the_gate_is_part_of_the_plan(spark, tmp_path):
    """It follows the data at the time of the run, not of the call."""
    path = str(tmp_path / "live")
    spark.range(3).write.parquet(path)
    union = backfill_union(spark.read.schema("id LONG").parquet(path), spark.range(100, 105))
    plan = union._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan
    assert union.count() == 8


def test_only_the_first_poll_opens_the_gate(spark):
    places = [(0, "archive", "a"), (1, "archive", "b"), (1, "live", "c")]
    rows = [(poll, feed, 0, "f", 0, 0, name) for poll, feed, name in places]
    quiet = spark.createDataFrame(rows, PLACED)
    assert sorted(row.id for row in admitted_events(quiet, 10).collect()) == ["a", "c"]
    busy = quiet.unionByName(
        spark.range(10).select(
            F.lit(0).alias("poll"),
            F.lit("live").alias("feed"),
            F.lit(0).cast("bigint").alias("page"),
            F.lit("f").alias("file"),
            F.lit(0).cast("bigint").alias("line"),
            F.col("id").cast("int").alias("pos"),
            F.concat(F.lit("n"), "id").alias("id"),
        )
    )
    ids = {row.id for row in admitted_events(busy, 10).collect()}
    assert ids == {"c"} | {f"n{i}" for i in range(10)}
    assert {row.id for row in admitted_events(busy, 11).collect()} == ids | {"a"}
