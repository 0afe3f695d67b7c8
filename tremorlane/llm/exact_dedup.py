"""Exact copies by deterministic block naming."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorlane.llm.common import ROW, slices, staged, utf8

BLOCK_BYTES = 16 << 10
_TASK = 40  # numbers given in a task have so many bits below the task's own number
_PIECES = "doc_id long, row long, idx int, n int, uid long, sha string, block binary"


def normalised(text: bytes) -> bytes:
    """Every run of ASCII white space as one space."""
    if not text:
        return text
    words = b" ".join(text.split())
    if not words:
        return b" "
    return b" " * text[:1].isspace() + words + b" " * text[-1:].isspace()


def _cut(block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << _TASK
        for batch in slices(batches, "text"):
            known: dict[bytes, int] = {}
            rows: dict[str, list] = {name.split()[0]: [] for name in _PIECES.split(", ")}

            def add(*values, rows=rows):
                for column, value in zip(rows.values(), values, strict=True):
                    column.append(value)

            for row, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = normalised(text)
                sha = hashlib.sha256(text).hexdigest()
                n = max(1, -(-len(text) // block_bytes))
                for idx in range(n):
                    block = text[idx * block_bytes : (idx + 1) * block_bytes]
                    if block not in known:
                        known[block] = uid
                        add(None, None, None, None, uid, None, block)
                        uid += 1
                    add(doc_id, row, idx, n, known[block], None if idx else sha, None)
            schema = pa.schema(
                [
                    ("doc_id", pa.int64()),
                    ("row", pa.int64()),
                    ("idx", pa.int32()),
                    ("n", pa.int32()),
                    ("uid", pa.int64()),
                    ("sha", pa.string()),
                    ("block", pa.binary()),
                ]
            )
            yield pa.RecordBatch.from_pydict(rows, schema)

    return run


def _name_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in sorted order to names: a new name wherever the block changes."""
    name = (TaskContext.get().partitionId() << _TASK) - 1
    last = None
    for batch in batches:
        names = []
        for block in batch.column("block").to_pylist():
            if block != last:
                name, last = name + 1, block
            names.append(name)
        yield pa.RecordBatch.from_arrays(
            [batch.column("uid"), pa.array(names, pa.int64())], ["uid", "name"]
        )


def _pair_up(level: DataFrame) -> DataFrame:
    """The next level: adjacent names as pairs, each distinct pair under one new name."""
    half = F.col("idx").bitwiseAND(1)
    pairs = level.groupBy("row", "n", F.expr("idx div 2").cast("int").alias("idx")).agg(
        F.max(F.when(half == 0, F.col("name"))).alias("left"),
        F.coalesce(F.max(F.when(half == 1, F.col("name"))), F.lit(-1)).alias("right"),
    )
    pairs = staged(pairs, "pairs")
    distinct = pairs.select("left", "right").distinct()
    names = staged(
        distinct.sortWithinPartitions("left", "right").withColumn(
            "name", F.monotonically_increasing_id()
        ),
        "names",
    )
    joined = pairs.join(names, ["left", "right"])
    return staged(
        joined.select("row", "idx", F.expr("cast((n + 1) div 2 as int)").alias("n"), "name"),
        "level",
    )


def exact_copies(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of `docs`.

    Texts are equal if they are so after each run of ASCII white space has
    become one space; null counts as empty. Each text is cut into blocks of
    `block_bytes`. The blocks are sorted and numbered, equal ones alike; then
    adjacent numbers are paired and the pairs numbered, level by level, until
    a text has a single number. Numbers stand for whole contents, compared in
    full and never by a hash, so no two different texts can share one.

    A task first reduces the blocks of its slice to different ones, so a block
    that every document holds comes to its reducer once per slice; pairs are
    numbered as distinct pairs and joined back by joins that AQE can split.

    `kept` holds for one row of a group, that of the smallest doc_id; null
    counts as the largest. Of repeated rows with one doc_id a single one is
    kept. Empty texts form a group like any other. An empty table gives no
    rows. Only `doc_id` and `text` are read, whatever other columns are called.
    """
    return _decided(docs.withColumn(ROW, F.monotonically_increasing_id()), block_bytes).drop(ROW)


def _decided(docs: DataFrame, block_bytes: int) -> DataFrame:
    """`exact_copies` of rows that column `ROW` tells apart, and that column."""
    source = docs.select(
        F.col(ROW).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text")
    )
    pieces = staged(source.mapInArrow(_cut(block_bytes), _PIECES), "blocks")
    blocks = pieces.where(F.col("block").isNotNull()).select("block", "uid")
    names = blocks.repartition("block").sortWithinPartitions("block")
    names = names.mapInArrow(_name_sorted, "uid long, name long")
    refs = pieces.where(F.col("row").isNotNull())
    level = staged(refs.select("row", "idx", "n", "uid").join(names, "uid").drop("uid"), "level")

    longest = refs.agg(F.max("n")).first()[0] or 1
    identities = _named(level, 0)
    for number in range(1, (longest - 1).bit_length() + 1):
        level = _pair_up(level.where("n > 1"))
        identities = identities.unionByName(_named(level, number))
    rows = refs.where("idx = 0").select("row", "doc_id", F.col("sha").alias("text_sha256"))
    rows = rows.join(identities, "row")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    groups = rows.groupBy("level", "name").agg(
        F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"), first.alias("first")
    )
    # Keyed by a hash so that both sides are shuffled for the join and AQE can split a large group.
    key = F.xxhash64("level", "name").alias("_k")
    groups = groups.select(
        "keep_id", "group_size", F.col("first.row").alias("_kept"), "level", "name", key
    )
    return (
        rows.withColumn("_r", F.xxhash64("level", "name"))
        .alias("d")
        .join(groups.alias("g"), F.expr("_r = _k and d.level = g.level and d.name = g.name"))
        .select(
            F.col("row").alias(ROW),
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("row") == F.col("_kept")).alias("kept"),
            "text_sha256",
        )
    )


def _named(level: DataFrame, number: int) -> DataFrame:
    return level.where("n = 1").select("row", F.lit(number).alias("level"), "name")


def drop_exact_copies(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The kept rows of `docs`, all columns unchanged: one row of each group of equal texts.

    That is the row of the smallest doc_id, null last; of repeated rows one
    stays. Null counts as empty text. Rows are numbered, decisions are taken on
    numbers, and the texts are shuffled once, to leave out the dropped rows.
    """
    numbered = staged(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")
    dropped = _decided(numbered, block_bytes).where("not kept").select(ROW)
    return numbered.join(dropped, ROW, "left_anti").drop(ROW)
