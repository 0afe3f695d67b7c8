"""Summaries that a stream keeps up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tremorlane.operators.summary import value_counts
from tremorlane.schemas import SUMMARY
from tremorlane.sources.files import read_table
from tremorlane.staging import delete_dir, finished_folders
from tremorlane.streaming.queries import triggered

KEPT = 3  # versions that stay for readers which have begun


def start_summary(
    stream: DataFrame, path: str, checkpoint: str, every_seconds: float | None = None
) -> StreamingQuery:
    """Keep `value_counts` of all cleaned events a stream has had.

    Spark's state store holds the counts, so a batch costs what it holds and
    the size of the summary, however many events came before. Every batch
    writes the whole summary as a version of its own, which counts when it is
    finished; a batch that is repeated after a failure writes the same again.
    """

    def write(counts: DataFrame, batch_id: int) -> None:
        spark = counts.sparkSession
        counts.write.mode("overwrite").parquet(f"{path}/{_name(batch_id)}")
        for old in finished_folders(spark, path)[:-KEPT]:
            delete_dir(spark, f"{path}/{old}")

    writer = value_counts(stream).writeStream.outputMode("complete").foreachBatch(write)
    return triggered(writer, checkpoint, every_seconds).start()


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """The newest finished summary, for reports with `weight="n"`; no rows before the first."""
    versions = finished_folders(spark, path)
    return read_table(spark, f"{path}/{versions[-1] if versions else _name(0)}", SUMMARY)


def _name(batch_id: int) -> str:
    return f"version-{batch_id:012d}"
