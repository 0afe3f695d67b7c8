"""Connected components by alternating stars, all steps being joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorlane.llm.common import staged


def _with_least(edges: DataFrame) -> DataFrame:
    """Every edge (u, v) with `m`, the least v of its u.

    The minima are joined on a hash of u, so both sides arrive by an exchange
    of the join's own and AQE can split a u that holds a large share of them.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("_u"), "m", F.xxhash64("u").alias("_h"))
    joined = edges.withColumn("_k", F.xxhash64("u")).join(
        least, (F.col("_k") == F.col("_h")) & (F.col("u") == F.col("_u"))
    )
    return joined.select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = _with_least(both).where("v > u")
    return linked.select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    linked = _with_least(edges)
    moved = linked.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(linked.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(u, v): every linked node but the least of its component, and that least node.

    `links` holds pairs of longs in its first two columns. Large and small
    stars alternate until nothing moves, a number of rounds that grows with
    the logarithm of the longest chain. Every round starts from a table in the
    shared folder, so a lost executor costs one round at most. Loops and
    repeated pairs are allowed; no links in, no rows out.
    """
    a, b = (F.col(name) for name in links.columns[:2])
    edges = staged(
        links.where(a != b)
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "links",
    )
    state = _state(edges)
    while True:
        edges = staged(_small_star(_large_star(edges)), "stars")
        before, state = state, _state(edges)
        if state == before:
            return edges


def _state(edges: DataFrame) -> tuple:
    mark = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mark), F.bit_xor(F.xxhash64("v", "u"))).first())
