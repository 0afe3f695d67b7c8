"""First-seen de-duplication of a stream, on Spark's keyed state."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tremorlane.streaming.queries import start_parquet

_LINE = "__line"
_HELD = 1 << 16  # rows that are reduced to the first ones together


def _firsts(rows: pa.Table, key: str, order: Sequence[str]) -> pa.Table:
    """The first row of every key; a null place comes before others."""
    by = [(name, "ascending") for name in (key, *order)]
    rows = rows.take(pc.sort_indices(rows, sort_keys=by, null_placement="at_start"))
    keys = rows.column(key).combine_chunks()
    if len(keys) < 2:
        return rows
    one, other = keys[1:], keys[:-1]
    same = pc.or_(
        pc.fill_null(pc.equal(one, other), False), pc.and_(pc.is_null(one), pc.is_null(other))
    )
    return rows.filter(pa.concat_arrays([pa.array([True]), pc.invert(same)]))


def _leading(key: str, order: Sequence[str], numbered: bool):
    """Reduce a task's rows to the first of each key.

    With `numbered` the rows come as they were read: their number in the task
    orders those of one place, and only rows at hand together are reduced, so
    memory stays bounded and a key that holds a large share of the rows leaves
    a few of them. Otherwise all rows of a key are in the task, and one is left.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, line = [], 0, 0
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if numbered:
                lines = pa.array(range(line, line + len(rows)), pa.int64())
                rows = rows.set_column(rows.schema.get_field_index(_LINE), _LINE, lines)
                line += len(rows)
            held.append(rows)
            count += len(rows)
            if count >= _HELD:
                held = [_firsts(pa.concat_tables(held), key, order)]
                if numbered:
                    yield from held.pop().to_batches()
                # What is left is doubled before the next look, so each row is sorted a few times.
                count = 0 if numbered or len(held[0]) < _HELD else -len(held[0])
        if held:
            yield from _firsts(pa.concat_tables(held), key, order).to_batches()

    return run


def _flat_places(df: DataFrame, arrival: Sequence[str | Column]) -> list[Column]:
    """The columns of the arrival order, structs as their fields, under names of their own."""
    places: list[Column] = []
    for place in (F.col(a) if isinstance(a, str) else a for a in arrival):
        kind = df.select(place).schema[0].dataType
        places += [place[f] for f in kind.names] if isinstance(kind, StructType) else [place]
    return [place.alias(f"__place{i}") for i, place in enumerate(places)]


def first_seen_stream(
    stream: DataFrame, key: str, arrival: Sequence[str | Column], columns: Sequence[str]
) -> DataFrame:
    """`columns` of the first row of every key over the life of the checkpoint.

    Within a micro-batch that is the first in `arrival` order, and rows of one
    place in the order in which they stand in their file; keys of earlier
    batches are known from Spark's state store, which has one entry per key
    and nothing but the key in it. A batch thus costs what it holds, however
    many keys were seen before, and one that is repeated after a failure finds
    the state of before and gives the same rows.

    Each task first reduces the rows it reads to the first of each key, so a
    key with a large share of them comes to the shuffle as a few rows. A null
    key counts as one key. The result is a stream in append mode, for any sink.
    """
    places = _flat_places(stream, arrival)
    order = [f"__place{i}" for i in range(len(places))] + [_LINE]
    narrow = stream.select(
        F.col(key).alias("__key"), *columns, *places, F.lit(0).cast("long").alias(_LINE)
    )
    schema = narrow.schema
    reduced = narrow.mapInArrow(_leading("__key", order, True), schema)
    dealt = reduced.repartition("__key").mapInArrow(_leading("__key", order, False), schema)
    return dealt.dropDuplicates(["__key"]).select(*columns)


def start_first_seen(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    *,
    key: str,
    arrival: Sequence[str | Column],
    columns: Sequence[str],
    every_seconds: float | None = None,
) -> StreamingQuery:
    """Land `first_seen_stream` as Parquet under `path`.

    Spark's file sink writes it, whose log says which files belong to the
    table. Readers of `path`, batch and stream, follow the log: they see a
    batch when it is whole, and files of a try that failed never.
    """
    fresh = first_seen_stream(stream, key, arrival, columns)
    return start_parquet(fresh, path, checkpoint, every_seconds)


def dedup_stream(
    stream: DataFrame,
    key: str = "earthquake_id",
    *,
    watermark: tuple[str, str] | None = None,
) -> DataFrame:
    """One row per key over the life of the checkpoint, from Spark's state store.

    A key seen in an earlier micro-batch keeps its earlier row; within one
    batch any of its rows may stay: use `first_seen_stream` where it must be the
    first. The state has one entry per key. `watermark=(column, delay)` bounds
    it to repeats that come within the delay; `column` must be a TIMESTAMP.
    """
    if watermark is not None:
        return stream.withWatermark(*watermark).dropDuplicatesWithinWatermark([key])
    return stream.dropDuplicates([key])
