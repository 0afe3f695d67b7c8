"""Flat JSON-lines, enriched Parquet and CSV tables.

The schema is always given: nothing is inferred from the data, and a missing
or empty input yields an empty table of the right shape.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tremorlane.schemas import CLUSTERED, ENRICHED, FLAT
from tremorlane.sources.records import csv_records

log = logging.getLogger(__name__)


def _or_empty(
    spark: SparkSession, path: str, schema: str, load: Callable[[], DataFrame]
) -> DataFrame:
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.error("no data at %s", path)
        return spark.createDataFrame([], schema)


def read_events(spark: SparkSession, path: str, *, malformed: str = "PERMISSIVE") -> DataFrame:
    """Flat events from JSON-lines files.

    A line that is not JSON becomes a row of NULLs; `malformed="DROPMALFORMED"`
    leaves it out instead.
    """
    reader = (
        spark.read.schema(FLAT).option("mode", malformed).option("pathGlobFilter", "*.json")
    )
    return _or_empty(spark, path, FLAT, lambda: reader.json(path))


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The columns of `schema` of a Parquet table; no rows where there is no table yet."""
    return _or_empty(spark, path, schema, lambda: spark.read.schema(schema).parquet(path))


def read_enriched(spark: SparkSession, path: str, schema: str = ENRICHED) -> DataFrame:
    return read_table(spark, path, schema)


def read_csv(spark: SparkSession, path: str, schema: str = CLUSTERED) -> DataFrame:
    """A table written by `write_csv` or `write_single_csv`; line breaks inside fields are kept.

    Spark's own reader takes a file as a whole where fields may have line
    breaks. Here the records are found by blocks of the files, so the size of
    one file bounds nothing. A file whose header names other columns than
    `schema` is refused.
    """
    fields = StructType.fromDDL(schema).fields
    options = {"escape": '"', "multiLine": "true", "lineSep": "\n"}

    def parsed(record: Column, kinds: list[str]) -> Column:
        """Fields c1, c2 .. behind an empty one; the parser drops a byte order mark that begins its first record."""
        names = ", ".join(f"c{i} {kind}" for i, kind in enumerate(["STRING", *kinds]))
        return F.from_csv(F.concat(F.lit(","), record), names, options)

    def load() -> DataFrame:
        record = F.rtrim(F.col("record"), F.lit("\r"))
        told = parsed(F.ltrim(record, F.lit("\ufeff")), ["STRING"] * (len(fields) + 1))
        names = [*(F.lit(field.name.lower()) for field in fields), F.lit(None).cast("string")]
        found = (F.lower(told[f"c{i}"]) for i in range(1, len(names) + 1))
        same = F.array(*found).eqNullSafe(F.array(*names))
        refused = F.concat(F.lit("CSV header does not conform to the schema: "), record)
        checked = F.when(same, False).otherwise(F.raise_error(refused).cast("boolean"))
        return (
            csv_records(spark, path)
            .where(~F.col("header") | checked)
            .where(record != "")
            .select(parsed(record, [field.dataType.simpleString() for field in fields]).alias("row"))
            .select(*(F.col("row")[f"c{i}"].alias(field.name) for i, field in enumerate(fields, 1)))
        )

    return _or_empty(spark, path, schema, load)
