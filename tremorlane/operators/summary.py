"""Aggregates behind the report: counts, histogram, map points."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorlane.functions import SEVERITY_LABELS
from tremorlane.operators.clean import within_box

HISTOGRAM_BINS = 20


def _rows(weight: str | None) -> Column:
    """How many rows there are, or stand behind rows that carry their number."""
    rows = F.count("*") if weight is None else F.coalesce(F.sum(weight), F.lit(0))
    return rows.cast("bigint").alias("n")


def row_count(df: DataFrame, weight: str | None = None) -> DataFrame:
    return df.agg(_rows(weight))


def value_counts(df: DataFrame, value: str = "magnitude") -> DataFrame:
    """(severity, value, n): a summary of a table or a stream, from which all counts here follow.

    It has a row for every different value and label. Summaries add up: that
    of all rows is the sum of those of its parts, so a stream keeps it in its
    state. Reports take it with `weight="n"`.
    """
    return df.groupBy("severity", value).agg(F.count("*").alias("n"))


def cluster_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("cluster").agg(F.count("*").alias("n")).orderBy("cluster")


def _counts_over(domain: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    # `counts` holds no key outside the domain, which bounds what is broadcast.
    return domain.join(F.broadcast(counts), key, "left").withColumn(
        "n", F.coalesce("n", F.lit(0).cast("bigint"))
    )


def severity_counts(
    df: DataFrame, labels: Sequence[str] = SEVERITY_LABELS, weight: str | None = None
) -> DataFrame:
    """Rows per label, in the given order, zero for labels without rows.

    A row of `df` stands for as many as its column `weight` says, if there is one.
    """
    counts = df.where(F.col("severity").isin(*labels)).groupBy("severity").agg(_rows(weight))
    names = F.array(*map(F.lit, labels))
    domain = df.sparkSession.range(0, len(labels), 1, 1).select(
        F.get(names, F.col("id").cast("int")).alias("severity"), F.col("id").alias("_order")
    )
    return _counts_over(domain, counts, "severity").orderBy("_order").select("severity", "n")


def magnitude_histogram(
    df: DataFrame,
    value: str = "magnitude",
    bins: int = HISTOGRAM_BINS,
    weight: str | None = None,
) -> DataFrame:
    """Equal-width bins from the least to the greatest value, the last one closed.

    A row of `df` stands for as many as its column `weight` says, if there is one.

    One aggregate brings the two ends of the range to the driver, a second
    pass counts. The edges are, to the last bit, those of numpy.histogram:
    lowest + i * width, and the greatest value itself at the end; equal values
    get a range of one around them. No rows in, no rows out.
    """
    carried = [] if weight is None else [F.col(weight).alias("w")]
    values = df.select(F.col(value).alias("v"), *carried)
    values = values.where(F.col("v").isNotNull() & ~F.isnan("v"))
    least, greatest = values.agg(F.min("v"), F.max("v")).first()
    if least is None:
        return df.sparkSession.createDataFrame([], "bin INT, lo DOUBLE, hi DOUBLE, n BIGINT")
    if math.isinf(least) or math.isinf(greatest):
        raise ValueError(f"histogram of infinite values in {value}")
    if least == greatest:
        least, greatest = least - 0.5, greatest + 0.5
    width = (greatest - least) / bins
    edges = [least + i * width for i in range(bins)] + [greatest]

    # A value's bin is that of the highest edge it has reached.
    position = F.when(F.col("v") >= F.lit(edges[bins - 1]), F.lit(bins - 1))
    for i in range(bins - 2, -1, -1):
        position = position.when(F.col("v") >= F.lit(edges[i]), F.lit(i))
    counts = values.groupBy(position.alias("bin")).agg(_rows(weight and "w"))
    ends = F.array(*map(F.lit, edges))
    domain = (
        df.sparkSession.range(0, bins, 1, 1)
        .select(F.col("id").cast("int").alias("bin"))
        .select("bin", F.get(ends, "bin").alias("lo"), F.get(ends, F.col("bin") + 1).alias("hi"))
    )
    return _counts_over(domain, counts, "bin").orderBy("bin")


def map_points(df: DataFrame) -> DataFrame:
    """Position, cluster (where the table has one) and marker size, inside the map."""
    shown = F.greatest(F.col("magnitude"), F.lit(0.0))
    return within_box(df).select(
        "longitude",
        "latitude",
        *(["cluster"] if "cluster" in df.columns else []),
        (shown * shown * 12 + 10).alias("marker_size"),
    )
