"""Batch writers. Spark's commit protocol makes a file visible only when whole."""

from __future__ import annotations

import csv
import io
import uuid

from pyspark.sql import DataFrame, DataFrameWriter

from tremorlane.staging import join_files


def write_json_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    """One JSON object per line with all fields, nulls included."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_csv(
    df: DataFrame, path: str, mode: str = "overwrite", rows_per_file: int = 1_000_000
) -> None:
    """A folder of CSV files with headers, inner quotes doubled, blanks kept.

    Files are bounded because readers other than `read_csv` cannot split a CSV
    with line breaks in its fields.
    """
    _csv(df.write.mode(mode).option("header", True), rows_per_file).csv(path)


def _csv(writer: DataFrameWriter, rows_per_file: int) -> DataFrameWriter:
    return (
        writer.option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", rows_per_file)
    )


def write_single_csv(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """One CSV file at `path` with a header, in the order of the rows of `df`, in place of an older one.

    All tasks write parts, without headers, beside it; then the file system
    joins them, and the file gets its name when it is whole. Nothing is
    collected and no task holds more than its own rows.
    """
    parts = f"{path}.parts-{uuid.uuid4().hex}"
    _csv(df.write, rows_per_file).csv(parts)
    header = io.StringIO()
    csv.writer(header, lineterminator="\n").writerow(df.columns)
    join_files(df.sparkSession, parts, "part-*", path, header.getvalue().encode())
