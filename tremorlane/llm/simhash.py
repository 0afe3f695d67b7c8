"""SimHash near-copies, linked by meet-in-the-middle ball hashing."""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorlane.llm.common import ROW, map_slices, shuffle_parts, staged, utf8
from tremorlane.llm.components import connected_components

WORDS = 3
SEED = 42
_CHUNK = 1 << 16  # shingles counted at a time, which bounds the bit matrix


def fingerprint(text: bytes, words: int = WORDS, seed: int = SEED) -> int:
    """64-bit SimHash of a UTF-8 text, as a signed integer.

    A-Z are lower-cased; words are runs without ASCII white space. A bit is
    set if more than half of the hashes of all word shingles (repeats count)
    have it. A text of fewer words is one shingle; one without words gives 0.
    """
    found = text.lower().split()
    if not found:
        return 0
    if len(found) <= words:
        shingles, total = iter([b" ".join(found)]), 1
    else:
        total = len(found) - words + 1
        shingles = map(b" ".join, zip(*(found[i:] for i in range(words)), strict=False))
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(seed))
    ones = np.zeros(64, np.int64)
    for first in range(0, total, _CHUNK):
        block = np.fromiter(hashes, np.uint64, min(_CHUNK, total - first))
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """(row, doc_id, fp) for every row of `docs`, from its whole text.

    `row` tells rows apart: that of column `ROW` if there is one.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = [fingerprint(text, words, seed) for text in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("doc_id"), pa.array(values, pa.int64())],
            ["row", "doc_id", "fp"],
        )

    row = F.col(ROW) if ROW in docs.columns else F.monotonically_increasing_id()
    source = docs.select(row.alias("row"), F.col("doc_id").cast("long"), utf8("text").alias("text"))
    return map_slices(source, run, "row long, doc_id long, fp long", "text")


def ball_links(fps: DataFrame) -> DataFrame:
    """(a, b): links that join all distinct fingerprints 2 or fewer bits apart.

    Every fingerprint emits itself and its 64 one-bit variants; two of them
    share a variant exactly if they differ in two bits or fewer. A variant's
    members all lie within one bit of it, so a row of two fixed-size fields, a
    mask of the bits and a flag, lists them; at most 65 share one. The members
    of a variant are near each other, so a star from one of them to the others
    keeps every connection. Repeated links are dropped and each is verified.
    """
    spread = fps.repartition(shuffle_parts(fps.sparkSession), "fp").select(
        "fp", F.explode(F.expr("sequence(-1, 63)")).alias("bit")
    )
    variants = spread.selectExpr(
        "if(bit < 0, fp, fp ^ shiftleft(1L, bit)) as variant",
        "if(bit < 0, 0L, shiftleft(1L, bit)) as mask",
        "bit < 0 as itself",
    )
    shared = (
        variants.groupBy("variant")
        .agg(F.bit_or("mask").alias("mask"), F.max("itself").alias("itself"))
        .where("bit_count(mask) + cast(itself as int) > 1")
    )
    flipped = F.expr(
        "transform(filter(sequence(0, 63), b -> getbit(mask, b) = 1),"
        " b -> variant ^ shiftleft(1L, b))"
    )
    own = F.expr("if(itself, array(variant), cast(array() as array<bigint>))")
    return (
        shared.select(F.concat(own, flipped).alias("members"))
        .select(
            F.col("members")[0].alias("a"),
            F.explode(F.expr("slice(members, 2, size(members))")).alias("b"),
        )
        .distinct()
        .where("bit_count(a ^ b) <= 2")
    )


def simhash_components(docs: DataFrame, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of `docs`.

    Two texts are linked if their fingerprints differ in at most two bits;
    `component_id` is the least doc_id that links lead to. Texts without words
    (null, empty, white space) have fingerprint zero and are linked like any
    other. Repeated rows are returned as often as they come. A null doc_id is
    never the least unless its component has no other. Only `doc_id` and
    `text` are read. An empty table gives no rows.

    Copies are reduced to distinct fingerprints first, so links and components
    are of distinct fingerprints, however large a group of copies is.
    """
    of_docs = staged(fingerprints(docs, words, seed), "fingerprints")
    rooted, roots = _components(of_docs)
    # Keyed by hashes so that both joins shuffle both sides and AQE can split a hot key.
    roots = roots.select("component_id", "root", F.xxhash64("root").alias("_r"))
    named = rooted.withColumn("_k", F.xxhash64("root")).join(
        roots, (F.col("_k") == F.col("_r")) & (rooted["root"] == roots["root"])
    )
    named = named.select(F.col("fp").alias("_fp"), "component_id", F.xxhash64("fp").alias("_h"))
    return (
        of_docs.withColumn("_d", F.xxhash64("fp"))
        .join(named, (F.col("_d") == F.col("_h")) & (F.col("fp") == F.col("_fp")))
        .select(
            "doc_id",
            F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
            "component_id",
        )
    )


def _components(of_docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fp, root) of every different fingerprint, and (root, component_id, first) of every component.

    `first` is the row of the least doc_id, null last.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    distinct = staged(
        of_docs.groupBy("fp").agg(F.min("doc_id").alias("least"), first.alias("first")), "distinct"
    )
    stars = connected_components(ball_links(distinct.select("fp")))
    rooted = distinct.join(stars, distinct["fp"] == stars["u"], "left").select(
        "fp", "least", "first", F.coalesce("v", "fp").alias("root")
    )
    roots = rooted.groupBy("root").agg(
        F.min("least").alias("component_id"), F.min("first").alias("first")
    )
    return rooted.select("fp", "root"), roots.withColumn("first", F.col("first.row"))


def drop_near_copies(docs: DataFrame, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """One row of each component of `simhash_components`, all columns unchanged.

    That is the row of the smallest doc_id, null last; of repeated rows one
    stays, and so does one of all rows without words. Rows are numbered,
    components are found on fingerprints, and the texts are shuffled once, to
    take up the rows that stay.
    """
    numbered = staged(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")
    of_docs = staged(fingerprints(numbered, words, seed), "fingerprints")
    _, roots = _components(of_docs)
    return numbered.join(roots.select(F.col("first").alias(ROW)), ROW, "left_semi").drop(ROW)
