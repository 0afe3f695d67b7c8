"""A Merkle manifest of a dataset, built by incremental witnesses."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremorlane.llm.common import staged
from tremorlane.staging import fresh_dir

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
HEIGHT = 12  # levels of a block: 4,096 nodes are appended in one task at a time
_DIGEST = 32


def leaf_digest(fields: Sequence[str | Column]) -> Column:
    """SHA-256 of a row: each field as its byte count, a colon and its text, or `-` if null."""
    texts = (F.col(f).cast("string") if isinstance(f, str) else f.cast("string") for f in fields)
    parts = (
        F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
        for text in texts
    )
    return F.unhex(F.sha2(F.concat(*parts), 256))


def joined(*digests: bytes) -> bytes:
    """The digest over nodes, which are written as lowercase hex."""
    return sha256("".join(digest.hex() for digest in digests).encode()).digest()


class Subtrees:
    """The open subtrees of a tree that is appended to from left to right.

    A node is a subtree of one. Two open ones of equal size become one as soon
    as both are complete: then the witness of every member grows by the root
    of the other half. A member's witness is thus partial as long as its
    subtree is open, and holds its siblings from the lowest level up.
    """

    def __init__(self):
        self.witnesses: list[bytearray] = []
        self._open: list[tuple[int, int, bytes]] = []  # level, first member, root

    def append(self, node: bytes) -> None:
        self._open.append((0, len(self.witnesses), node))
        self.witnesses.append(bytearray())
        while len(self._open) > 1 and self._open[-1][0] == self._open[-2][0]:
            self._unite()

    def _unite(self) -> None:
        level, middle, right = self._open.pop()
        _, first, left = self._open.pop()
        for witness in self.witnesses[first:middle]:
            witness += right
        for witness in self.witnesses[middle:]:
            witness += left
        self._open.append((level + 1, first, joined(left, right)))

    def close(self, height: int | None = None) -> bytes:
        """The root; a last node without a sibling goes up by a digest of its own.

        With `height` the root is lifted to that level, as that of a block
        with others before it.
        """
        while len(self._open) > 1 or (height is not None and self._open[-1][0] < height):
            if len(self._open) > 1 and self._open[-1][0] == self._open[-2][0]:
                self._unite()
            else:
                level, first, root = self._open.pop()
                self._open.append((level + 1, first, joined(root)))
        return self._open[0][2]


def folded(node: bytes, witness: bytes, place: int, size: int) -> bytes:
    """The root that a node at `place` of `size` has with a witness."""
    at = 0
    while size > 1:
        if place ^ 1 < size:
            other = witness[at : at + _DIGEST]
            at += _DIGEST
            node = joined(other, node) if place & 1 else joined(node, other)
        else:
            node = joined(node)
        place, size = place >> 1, size + 1 >> 1
    return node


def _placed(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """`nodes` with `place`, their number within their tree in the order given, and the tree's `size`.

    Nodes are sorted by ranges of (tree, order), so a tree that holds most of
    them is spread over many tasks. Only the number of nodes of each tree in
    each task is put in one order, not the nodes.
    """
    spark = nodes.sparkSession
    ordered = nodes.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    path = fresh_dir(spark, "ordered")
    numbered = ordered.withColumns(
        {"part": F.spark_partition_id(), "line": F.monotonically_increasing_id()}
    )
    numbered.write.parquet(path)
    numbered = spark.read.schema(numbered.schema).parquet(path)
    counts = numbered.groupBy("tree", "part").agg(
        F.count("*").alias("n"), F.min("line").alias("first")
    )
    by_part = Window.partitionBy("tree").orderBy("part")
    bases = counts.select(
        "tree",
        "part",
        "first",
        (F.sum("n").over(by_part) - F.col("n")).alias("base"),
        F.sum("n").over(Window.partitionBy("tree")).alias("size"),
    )
    # A tree and a task share at most what the task wrote, so no key of the join is hot.
    return numbered.join(bases, ["tree", "part"]).select(
        *nodes.columns, (F.col("line") - F.col("first") + F.col("base")).alias("place"), "size"
    )


def _appended(nodes: DataFrame, height: int) -> tuple[DataFrame, DataFrame]:
    """Placed nodes with their witness inside their block, and the blocks' roots.

    Nodes are dealt out by aligned blocks of `2 ** height` places; a task
    appends those of a block in their order. The roots come as (tree, place,
    size, node) and are themselves nodes of the level above.
    """
    blocks = nodes.withColumn("block", F.shiftright("place", height))
    dealt = blocks.repartition("tree", "block").sortWithinPartitions("tree", "place")
    schema = dealt.schema
    names = [*schema.names, "witness", "root"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current, size, trees = None, 0, Subtrees()

        def finished() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            root = trees.close(height if size > 1 << height else None)
            columns = [pa.array(map(bytes, trees.witnesses), pa.binary())]
            columns.append(pa.array([root] * rows.num_rows, pa.binary()))
            return pa.RecordBatch.from_arrays([*rows.columns, *columns], names)

        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("tree", "block", "size")))
            digests, first = batch.column("node").to_pylist(), 0
            for i, (tree, block, total) in enumerate(keys):
                if (tree, block) != current:
                    if i > first:
                        held.append(batch.slice(first, i - first))
                    if held:
                        yield finished()
                    held, trees, first = [], Subtrees(), i
                    current, size = (tree, block), total
                trees.append(digests[i])
            held.append(batch.slice(first))
        if held:
            yield finished()

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    within = staged(dealt.mapInArrow(run, f"{ddl}, witness binary, root binary"), "witnesses")
    roots = within.where(F.col("place") == F.shiftleft("block", height)).select(
        "tree",
        F.col("block").alias("place"),
        F.expr(f"((size - 1) >> {height}) + 1").alias("size"),
        F.col("root").alias("node"),
    )
    return within.drop("root"), roots


def _witnessed(nodes: DataFrame, height: int) -> tuple[DataFrame, DataFrame]:
    """Placed nodes with their whole `witness` and their tree's `subroot`, and the trees' roots.

    The roots of blocks are appended like nodes, level above level, until a
    tree has one block; then the witnesses of blocks extend those of their
    members. Every level has 2 ** height times fewer nodes than the one below.
    """
    levels, more = [], True
    while more:
        within, nodes = _appended(nodes, height)
        levels.append(within)
        # Trees that are whole go on as a block of one, until the largest is.
        more = nodes.where("size > 1").limit(1).count() > 0
    roots = nodes.select("tree", F.col("node").alias("subroot"))
    upper = nodes.select("tree", "place", F.lit(b"").alias("above"), F.col("node").alias("subroot"))
    for within in reversed(levels):
        up = upper.withColumnRenamed("place", "block")
        extended = within.join(up, ["tree", "block"]).withColumn(
            "witness", F.concat("witness", "above")
        )
        whole = extended.drop("block", "above")
        upper = whole.select("tree", "place", F.col("witness").alias("above"), "subroot")
    return whole, roots


def merkle_manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    *,
    key: str = "doc_id",
    tree: str = "lang",
    claim: Column | None = None,
    height: int = HEIGHT,
) -> DataFrame:
    """(key, leaf, claim, place, size, witness, subroot, tree_place, trees, tree_witness, root).

    One row for every row of `docs`. Its `leaf` is the digest of `fields`; the
    leaves of each value of `tree` ascend by `key` and are united two by two,
    a last one without a sibling alone, up to the `subroot`; the subroots, in
    the order of their values as bytes, null first, likewise up to the `root`.
    `witness` and `tree_witness` are the siblings of a row's nodes up to the
    subroot and from there to the root, 32 bytes each; `place` of `size` and
    `tree_place` of `trees` say on which side they are. `claim` is a digest
    that is carried along, such as the leaf of another state of the row.

    Rows leave their texts behind before anything is shuffled. Null keys come
    first; rows of one key are ordered by their leaves, so repeated rows are
    leaves of their own whose order does not matter. Null and empty fields
    have different digests. An empty table gives no rows. No other columns
    are read, whatever they are called.
    """
    leaves = docs.select(
        # The value itself, after a sign that tells an empty one from null.
        F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit("")).alias("tree"),
        F.col(key).alias("key"),
        leaf_digest(fields).alias("node"),
        (F.lit(None).cast("binary") if claim is None else claim).alias("claim"),
        F.monotonically_increasing_id().alias("tie"),  # equal rows need not go to one task
    )
    within, subroots = _witnessed(_placed(leaves, ["key", "node", "tie"]).drop("tie"), height)
    tops = subroots.select(
        F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("subroot").alias("node")
    )
    tops, _ = _witnessed(_placed(tops, ["name"]), height)
    tops = tops.select(
        F.col("name").alias("tree"),
        F.col("place").alias("tree_place"),
        F.col("size").alias("trees"),
        F.col("witness").alias("tree_witness"),
        F.col("subroot").alias("root"),
    )
    # Joined by block, not by tree, since a tree may hold most rows.
    spread = F.shiftright("place", height)
    blocks = within.groupBy("tree", spread.alias("block")).agg(F.lit(1).alias("one")).drop("one")
    tops = blocks.join(tops, "tree")
    return (
        within.withColumn("block", spread)
        .join(tops, ["tree", "block"])
        .select(
            F.col("key").alias(key),
            F.col("node").alias("leaf"),
            "claim",
            "place",
            "size",
            "witness",
            "subroot",
            "tree_place",
            "trees",
            "tree_witness",
            "root",
        )
    )


def verified(manifest: DataFrame, digest: str = "leaf") -> DataFrame:
    """`manifest` with `folded_root`, the root that column `digest` leads to with the witnesses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = (digest, "witness", "place", "size", "tree_witness", "tree_place", "trees")
        for batch in batches:
            rows = zip(*(batch.column(name).to_pylist() for name in read))
            roots = [
                folded(folded(node, low, place, size), high, tree, trees)
                for node, low, place, size, high, tree, trees in rows
            ]
            columns = [*batch.columns, pa.array(roots, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "folded_root"])

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in manifest.schema)
    return manifest.mapInArrow(run, f"{ddl}, folded_root binary")


def tampered(every: int = 7) -> Column:
    """The leaf of a document whose n_chars grew by one, where `every` divides the crc32 of its id."""
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0, F.lit(False))
    counted = F.when(chosen, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return leaf_digest([counted if name == "n_chars" else name for name in FIELDS])


def manifest_digest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), digests as hex."""
    checked = verified(merkle_manifest(docs, claim=tampered()), "claim")

    def hexed(name: str) -> Column:
        return F.lower(F.hex(name)).alias(name)

    proof = F.lower(F.hex(F.concat("witness", "tree_witness")))
    return checked.select(
        "doc_id",
        *map(hexed, ("leaf", "subroot", "root")),
        F.sha2(proof, 256).alias("proof_sha256"),
        hexed("folded_root"),
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
