"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import re
from collections.abc import Callable, Collection, Iterator
from itertools import filterfalse

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorlane.staging import fresh_dir

#: Texts are handed to the Python helpers in slices of about so many bytes.
SLICE_BYTES = 4 << 20

#: Column that tells the rows of a table apart where its own columns may not.
ROW = "__tremorlane_row"


def utf8(name: str) -> Column:
    """A text column as its UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary")


def staged(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the shared folder and read back: later jobs start from there."""
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_uri(path: str) -> str:
    """A path as the URI that pyarrow's file systems are found by."""
    return path if re.match(r"[a-z][a-z0-9+.-]*:", path) else f"file://{path}"


def shuffle_parts(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, for a layout AQE must not merge."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(
    batches: Iterator[pa.RecordBatch], sized: str, most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches where the bytes of column `sized` reach `most`; a row stays whole."""
    for batch in batches:
        column, first, total = batch.column(sized), 0, 0
        lengths = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()
        for i, length in enumerate(lengths):
            total += length
            if total >= most:
                yield batch.slice(first, i + 1 - first)
                first, total = i + 1, 0
        if first < batch.num_rows:
            yield batch.slice(first)


def map_slices(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str,
    sized: str,
    most: int = SLICE_BYTES,
) -> DataFrame:
    """Apply `function` to slices of `df`, as many rows at a time as `most` bytes hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, sized, most):
            yield function(piece)

    return df.mapInArrow(run, schema)


class Remembered(dict):
    """Results by key, of which the last `limit` to twice as many are kept."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.older = limit, {}

    def absent(self, keys: Collection) -> list:
        """Those of the different `keys` that have to be worked out; the others are at hand now."""
        if len(self) + len(keys) > self.limit:
            self.older = dict(self)
            self.clear()
        missing = []
        for key in filterfalse(self.__contains__, keys):
            value = self.older.get(key)
            if value is None:
                missing.append(key)
            else:
                self[key] = value
        return missing


def filter_texts(df: DataFrame, keep: Callable[[list[bytes]], list[bool]]) -> DataFrame:
    """The rows of `df` whose whole text passes `keep`; all columns stay as they are.

    `keep` gets the UTF-8 bytes of a slice's texts, null as empty. Nothing is
    shuffled, so rows need no key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            texts = piece.column("text").cast(pa.binary()).to_pylist()
            yield piece.filter(pa.array(keep([text or b"" for text in texts]), pa.bool_()))

    return df.mapInArrow(run, df.schema)
