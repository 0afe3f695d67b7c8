"""JSON-lines directory as a stream of flat events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorlane.schemas import FLAT, FLAT_COLUMNS

MALFORMED = "_malformed"

# About one wave of tasks on a few thousand cores; smaller inputs are taken
# in one batch.
BATCH_BYTES = 512 * 1024**3


def read_event_stream(
    spark: SparkSession,
    path: str,
    *,
    files_per_batch: int | None = None,
    bytes_per_batch: int = BATCH_BYTES,
    malformed: str = "PERMISSIVE",
    keep_malformed: bool = False,
    files: str = "*.json",
) -> DataFrame:
    """Flat events from the files that arrive under `path`.

    A micro-batch takes `files_per_batch` files if given (1 shows file by file
    what happens), else files up to `bytes_per_batch` in total. Only `files`
    are read, not the temporary ones of a writer at work. With
    `keep_malformed` a column `MALFORMED` has the text of lines that do not
    parse, or not in full, for `split_malformed`.
    """
    schema = f"{FLAT}, `{MALFORMED}` STRING" if keep_malformed else FLAT
    reader = (
        spark.readStream.schema(schema)
        .option("mode", "PERMISSIVE" if keep_malformed else malformed)
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("pathGlobFilter", files)
    )
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    else:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.json(path)


def split_malformed(stream: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events of a stream read with `keep_malformed`, and the lines that did not parse.

    A line of which no field could be read is no event. One with a field of
    the wrong type is one, with NULL there, and is listed as well. The lines
    are (file, line, salvaged): where it came from, its text, and whether it
    is an event nonetheless.
    """
    salvaged = F.coalesce(*(F.col(name).cast("string") for name in FLAT_COLUMNS)).isNotNull()
    broken = F.col(MALFORMED).isNotNull()
    events = stream.where(~broken | salvaged).drop(MALFORMED)
    lines = stream.where(broken).select(
        F.col("_metadata.file_path").alias("file"),
        F.col(MALFORMED).alias("line"),
        salvaged.alias("salvaged"),
    )
    return events, lines


def read_landed_stream(
    spark: SparkSession, path: str, *, bytes_per_batch: int = BATCH_BYTES
) -> DataFrame:
    """Flat events from the Parquet files that arrive under `path`, whatever folders it has."""
    reader = spark.readStream.schema(FLAT).option("maxBytesPerTrigger", bytes_per_batch)
    return reader.option("pathGlobFilter", "*.parquet").parquet(path).select(*FLAT_COLUMNS)
