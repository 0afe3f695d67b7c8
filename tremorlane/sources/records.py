"""Records of CSV files by blocks: a large file is read by as many tasks as it has blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_BLOCK = ["file", "start"]
_PARTS = pa.schema(
    [
        ("file", pa.string()),
        ("start", pa.int64()),
        ("number", pa.int64()),
        ("begins", pa.bool_()),
        ("ends", pa.bool_()),
        ("record", pa.binary()),
    ]
)
_PARTS_DDL = "file string, start long, number long, begins boolean, ends boolean, record binary"


def _rows(block: tuple[str, int], numbers, begins: bool, ends: bool, records) -> pa.RecordBatch:
    size = len(numbers)
    values = ([block[0]] * size, [block[1]] * size, numbers, [begins] * size, [ends] * size, records)
    arrays = [pa.array(value, field.type) for value, field in zip(values, _PARTS, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=_PARTS)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of blocks, in order, as records, and at the edges of a block as parts of records.

    `number` is that of the first line in its block. `begins` and `ends` tell
    whether the record has its first and its last line in this block.
    """
    block, inside, begins, number, held = None, False, True, 0, []
    for batch in batches:
        starts = batch.column("start").to_numpy()
        files = batch.column("file").dictionary_encode().indices.to_numpy()
        changes = np.flatnonzero((starts[1:] != starts[:-1]) | (files[1:] != files[:-1])) + 1
        edges = [0, *changes.tolist(), batch.num_rows]
        for low, high in zip(edges, edges[1:], strict=False):
            if low == high:
                continue
            own = batch.column("file")[low].as_py(), int(starts[low])
            if own != block:
                if held:
                    yield _rows(block, [number - len(held)], begins, False, [b"\n".join(held)])
                inside = batch.column("opens")[low].as_py()
                block, begins, number, held = own, not inside, 0, []
            lines = batch.column("line").slice(low, high - low)
            odd = batch.column("odd").slice(low, high - low).to_numpy(zero_copy_only=False)
            within = np.logical_xor.accumulate(np.r_[inside, odd])  # quotes before each line, and at the end
            whole = ~within[1:] & ~within[:-1]
            if whole.any():
                numbers = number + np.flatnonzero(whole)
                yield _rows(block, numbers, True, True, lines.filter(pa.array(whole)))
            for i in np.flatnonzero(~whole).tolist():
                held.append(lines[i].as_py())
                if not within[i + 1]:
                    first = number + i + 1 - len(held)
                    yield _rows(block, [first], begins, True, [b"\n".join(held)])
                    begins, held = True, []
            inside, number = bool(within[-1]), number + high - low
    if held:
        yield _rows(block, [number - len(held)], begins, False, [b"\n".join(held)])


def _quotes(line: str) -> Column:
    return F.length(line) - F.length(F.replace(F.col(line), F.lit('"'), F.lit("")))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(record, header) for every record of the CSV files at `path`, and whether it is a file's first.

    Fields with line breaks are in quotes, and quotes inside them are doubled,
    so a line begins a record where the quotes before it are even in number.
    Lines are read by blocks, as a text; the quotes are counted by block, and
    the counts of the blocks before it tell in which state a block begins.
    Records that reach over blocks are put together from their parts. Nothing
    but these counts and parts is shuffled, and a task reads its blocks alone.
    """
    lines = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.col("value").cast("binary").alias("line"),
            (_quotes("value") % 2 == 1).alias("odd"),
        )
    )
    before = Window.partitionBy("file").orderBy("start")
    blocks = (
        lines.groupBy(*_BLOCK)
        .agg((F.count_if("odd") % 2 == 1).alias("turns"))
        .withColumn("turned", F.count_if("turns").over(before))
        .select(
            *_BLOCK,
            ((F.col("turned") - F.col("turns").cast("int")) % 2 == 1).alias("opens"),
            (F.col("turned") % 2 == 1).alias("stays"),
        )
    )

    def parts(of: DataFrame) -> DataFrame:
        states = F.broadcast(of.select(*_BLOCK, "opens"))
        return lines.join(states, _BLOCK).mapInArrow(_parts, _PARTS_DDL)

    header = F.col("begins") & (F.col("start") == 0) & (F.col("number") == 0)
    text = F.col("record").cast("string").alias("record")
    whole = parts(blocks).where("begins and ends").select(text, header.alias("header"))
    place = Window.partitionBy("file").orderBy("start", "number")
    over = (
        parts(blocks.where("opens or stays"))
        .where("not (begins and ends)")
        .withColumn("of", F.count_if("begins").over(place))
        .groupBy("file", "of")
        .agg(
            F.sort_array(F.collect_list(F.struct("start", "number", text))).alias("parts"),
            F.bool_or(header).alias("header"),
        )
        .select(F.array_join("parts.record", "\n").alias("record"), "header")
    )
    return whole.unionByName(over)
