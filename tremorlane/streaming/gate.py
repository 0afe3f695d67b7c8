"""A decision that is taken once in the life of a checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from tremorlane.staging import exists

_SCHEMA = "open BOOLEAN"


def settled_gate(
    spark: SparkSession, path: str, decide: Callable[[], bool | None]
) -> bool | None:
    """What was decided at `path`, or else what `decide` says now, which is kept there.

    None, for that it is too early to tell, is not kept. The decision counts
    from when its file is whole; a run that ended before decides anew.
    """
    if exists(spark, f"{path}/_SUCCESS"):
        return spark.read.schema(_SCHEMA).json(path).first()["open"]
    decision = decide()
    if decision is not None:
        kept = spark.createDataFrame([(decision,)], _SCHEMA)
        kept.coalesce(1).write.mode("overwrite").json(path)
    return decision
