"""Which of the arriving events count: first-seen and gated backfill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BACKFILL_THRESHOLD = 10


def first_seen(df: DataFrame, key: str, arrival: Sequence[str | Column]) -> DataFrame:
    """The first row of every key in arrival order.

    Spark limits each task to its own first row per key before the shuffle
    (WindowGroupLimit), so a key that holds a large share of the rows reaches
    its reducer as one row per task.
    """
    position = F.row_number().over(Window.partitionBy(key).orderBy(*arrival))
    return df.withColumn("_arrival", position).where("_arrival = 1").drop("_arrival")


def backfill_union(
    live: DataFrame,
    archive: DataFrame,
    threshold: int = BACKFILL_THRESHOLD,
    first_poll: DataFrame | None = None,
) -> DataFrame:
    """Live rows, plus the archive's if there are fewer than `threshold` live ones.

    `first_poll` gives the live rows that decide, where `live` spans several
    polls. The gate is a scalar subquery of the plan itself, which stops at
    `threshold` rows: nothing runs before the result is asked for, and it is
    decided anew on the data of each run.
    """
    return live.unionByName(archive.where(gate_open(live if first_poll is None else first_poll, threshold)))


def gate_open(deciding: DataFrame, threshold: int = BACKFILL_THRESHOLD) -> Column:
    """Whether there are fewer than `threshold` rows, as a condition in another plan."""
    seen = deciding.select(F.lit(1).alias("one")).limit(threshold).agg(F.count("one"))
    return seen.scalar() < threshold
