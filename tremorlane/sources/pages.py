"""Landed response pages: JSON documents whose `result` is a list of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameReader
from pyspark.sql.streaming.readwriter import DataStreamReader

from tremorlane.schemas import PAGE, PAGE_JSON, RAW_EVENT

#: What tells which file a row is from, in the order in which files came to be.
FILE_PLACE = {
    "file_modification_time": "TIMESTAMP",
    "file_path": "STRING",
    "file_block_start": "BIGINT",
}


def _configured(reader, one_document_per_file: bool):
    return (
        reader.schema(PAGE)
        .option("multiLine", one_document_per_file)
        .option("pathGlobFilter", "*.json")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
    )


def read_pages(
    spark: SparkSession,
    path: str,
    *,
    one_document_per_file: bool = False,
    streaming: bool = False,
) -> DataFrame:
    """Pages under `path`, optionally in poll=<n>/feed=<live|archive> folders.

    By default each line of a file is one page, so large files are split
    between tasks; `one_document_per_file` reads responses that were saved as
    they came, pretty-printed or not.
    """
    reader: DataFrameReader | DataStreamReader = spark.readStream if streaming else spark.read
    return with_file_place(_configured(reader, one_document_per_file).json(path))


def with_file_place(df: DataFrame) -> DataFrame:
    """`df` with `file`: which file a row is from, in the order in which files came to be."""
    return df.withColumn("file", F.struct(*(F.col(f"_metadata.{name}") for name in FILE_PLACE)))


def explode_pages(pages: DataFrame) -> DataFrame:
    """One row per event: poll, feed, page, file, line, pos, event.

    `file` and `line` order pages that have no number; `line`, which grows
    along a part of a file, is null on a stream and can be set in its batches.

    A page that is not JSON, has no `result` or one that is not a list gives
    no rows. One element that is not an object makes Spark give up the typed
    list; such pages are parsed again element by element, so that the sound
    events on them are kept.
    """
    elements = F.from_json("_corrupt_record", "result ARRAY<STRING>")["result"]
    salvaged = F.transform(
        F.filter(elements, lambda text: text.startswith("{")),
        lambda text: F.from_json(text, RAW_EVENT),
    )
    if "line" in pages.columns:
        line = F.col("line")
    else:
        unset = F.lit(None).cast("bigint")
        line = unset if pages.isStreaming else F.monotonically_increasing_id()
    return pages.select(
        F.coalesce("poll", F.lit(0)).alias("poll"),
        F.coalesce("feed", F.lit("live")).alias("feed"),
        F.coalesce("page", F.lit(0)).alias("page"),
        "file",
        line.alias("line"),
        F.posexplode(F.coalesce("result", salvaged)).alias("pos", "event"),
    )


PACKED_BYTES = 128 << 20
_PACKED = f"""value STRING, file STRUCT<{", ".join(f"{name}: {kind}" for name, kind in FILE_PLACE.items())}>,
    line BIGINT, poll INT, feed STRING"""


def pack_pages(
    spark: SparkSession,
    path: str,
    packed: str,
    *,
    one_document_per_file: bool = False,
    bytes_per_file: int = PACKED_BYTES,
) -> None:
    """Many small files of pages as few large ones under `packed`, in poll=<n>/feed=<name> folders.

    Documents keep their text, and the place of each goes along in columns:
    the file it came in, when that came to be, and where in it the document
    stood. They are dealt out by poll, feed and place in pieces of about
    `bytes_per_file` of text, so that a file has neighbours of one folder and a
    folder with most pages is written by many tasks. `read_packed_pages`
    reads them as `read_pages` reads the originals.
    """
    documents = (
        spark.read.option("pathGlobFilter", "*.json")
        .schema("value STRING, poll INT, feed STRING")
        .text(path, wholetext=one_document_per_file)
    )
    placed = with_file_place(documents).withColumn("line", F.monotonically_increasing_id())
    size = placed.agg(F.coalesce(F.sum(F.octet_length("value")), F.lit(0))).first()[0]
    order = ["poll", "feed", "file", "line"]
    (
        placed.repartitionByRange(max(1, -(-size // bytes_per_file)), *order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .partitionBy("poll", "feed")
        .parquet(packed)
    )


def read_packed_pages(spark: SparkSession, packed: str) -> DataFrame:
    """Pages that `pack_pages` wrote, with the place that their documents had."""
    page = F.from_json("value", PAGE_JSON, {"columnNameOfCorruptRecord": "_corrupt_record"})
    return (
        spark.read.schema(_PACKED)
        .parquet(packed)
        .select(page.alias("document"), "file", "line", "poll", "feed")
        .select("document.*", "file", "line", "poll", "feed")
    )
