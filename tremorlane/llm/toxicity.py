"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorlane.llm.common import filter_texts, map_slices, staged, utf8
from tremorlane.llm.decontaminate import words_of

FOLDS = 5
#: Rows to fit on: at most so many confirmed examples and so many taken as unlabelled.
POSITIVES = 4_000
UNLABELLED = 16_000
FEATURES = 4_000
STARTS = (3, 4, 5, 6, 7, 8)  # bytes of a word's start that are features of their own
LEAST_CHI2 = 6.0  # by how much a feature's share must differ between the two, at least
LEAST_ROWS = 5  # rows of the sample that a feature must occur in
SAMPLE_SLICE = 256 << 10  # bytes of text whose features are held at a time
STEPS = 400
RATE = 0.05
DECAY = 1e-5


def text_features(text: bytes) -> set[bytes]:
    """Different words of a whole text, and the starts of longer ones with a star."""
    words = set(words_of(text))
    found = set(words)
    for size in STARTS:
        found.update([word[:size] + b"*" for word in words if len(word) > size])
    return found


@dataclass(frozen=True)
class Model:
    weights: dict[bytes, float]
    bias: float

    def score(self, text: bytes) -> float:
        """Probability of label 1, from the whole text."""
        known = text_features(text).intersection(self.weights)
        margin = self.bias + math.fsum(self.weights[feature] for feature in known)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, margin))))


def held_out(doc_id: Column) -> Column:
    """Whether a row takes no part in the fit; a row without an id takes none but is not held."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def fit_weights(
    rows: list[np.ndarray], positive: np.ndarray, prior: float, size: int
) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic classifier with the non-negative risk.

    `rows` have the features of each text, `positive` marks confirmed
    examples, the rest is unlabelled and holds positives with probability
    `prior`. The negative part of the risk is that of the unlabelled rows less
    `prior` times that of the confirmed ones. Where it falls below zero, only
    it is followed, and away from the minimum, which is what keeps the fit
    from explaining single rows. Full batches and Adam steps.
    """
    row = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    column = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    p, u = positive, ~positive
    weights, bias = np.zeros(size), math.log(prior / (1 - prior))
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        margin = np.bincount(row, weights[column], len(rows)) + bias
        sigmoid = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
        loss = np.logaddexp(0, margin)  # of taking a row as negative
        negative = loss[u].mean() - prior * loss[p].mean()
        slope = np.empty(len(rows))
        if negative >= 0:
            # d/dmargin of the loss as positive is sigmoid - 1, as negative sigmoid.
            slope[p] = prior * ((sigmoid[p] - 1) - sigmoid[p]) / p.sum()
            slope[u] = sigmoid[u] / u.sum()
        else:
            slope[p] = prior * sigmoid[p] / p.sum()
            slope[u] = -sigmoid[u] / u.sum()
        gradient = np.r_[np.bincount(column, slope[row], size) + DECAY * weights, slope.sum()]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return weights, float(bias)


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
    features: int = FEATURES,
) -> Model:
    """Fit on confirmed toxic texts and on texts whose labels are not looked at.

    Labels are used only of rows that are not `held_out`. The class prior is
    the share of toxic ones among all of these. The fit takes the rows of
    least hash: at most `positives` of those labelled toxic, and at most
    `unlabelled` of all that the table names, whatever their label. These
    bounds, and `features`, bound what is brought together; the choice of
    features is made from counts in Spark. Without a toxic label, or without
    any other, every text gets the prior as its score.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.where(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(
        F.max((F.col("toxic") == 1).cast("int")).alias("_toxic")
    )
    prior, n_toxic = known.agg(F.avg("_toxic"), F.sum("_toxic")).first()
    if not n_toxic or prior == 1:
        bounded = min(max(prior or 0.0, 1e-6), 1 - 1e-6)
        return Model({}, math.log(bounded / (1 - bounded)))

    def chosen(rows: DataFrame, seed: int, most: int, positive: bool) -> DataFrame:
        order = F.xxhash64(F.lit(seed), "_id")
        return rows.orderBy(order, "_id").limit(most).select("_id", F.lit(positive).alias("_p"))

    sample = chosen(known.where("_toxic = 1"), 1, positives, True).unionByName(
        chosen(known, 2, unlabelled, False)
    )
    # At most `positives + unlabelled` pairs of an id and a flag.
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), utf8("text").alias("text"))
    texts = texts.join(F.broadcast(sample), "_id")

    def found(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [list(text_features(text)) for text in batch.column("text").to_pylist()]
        listed = pa.array(sets, pa.list_(pa.binary()))
        return pa.RecordBatch.from_arrays([batch.column("_p"), listed], ["positive", "features"])

    sampled = staged(
        map_slices(
            texts.select("_p", "text"),
            found,
            "positive boolean, features array<binary>",
            "text",
            SAMPLE_SLICE,
        ),
        "sample",
    )
    totals = sampled.agg(F.count_if("positive"), F.count_if(~F.col("positive"))).first()
    n_p, n_u = totals
    if not n_p or not n_u:
        return Model({}, math.log(prior / (1 - prior)))
    counted = (
        sampled.select("positive", F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(F.count_if("positive").alias("in_p"), F.count_if(~F.col("positive")).alias("in_u"))
        .where(F.col("in_p") + F.col("in_u") >= LEAST_ROWS)
    )
    share = (F.col("in_p") + F.col("in_u")) / F.lit(n_p + n_u)
    apart = F.col("in_p") / F.lit(n_p) - F.col("in_u") / F.lit(n_u)
    strength = apart * apart / (share * (1 - share) + F.lit(1e-9))
    weight = n_p * n_u / (n_p + n_u)
    telling = counted.withColumn("strength", strength * weight).where(F.col("strength") >= LEAST_CHI2)
    best = telling.orderBy(F.desc("strength"), "feature").limit(features).select("feature").collect()
    names = [bytes(row["feature"]) for row in best]
    place = docs.sparkSession.sparkContext.broadcast({name: i for i, name in enumerate(names)})

    def placed(batch: pa.RecordBatch) -> pa.RecordBatch:
        # Row by row, as the features of a whole batch would take much memory.
        sets = [
            [place.value[x] for x in row.as_py() if x in place.value]
            for row in batch.column("features")
        ]
        return pa.RecordBatch.from_arrays(
            [batch.column("positive"), pa.array(sets, pa.list_(pa.int32()))], ["positive", "at"]
        )

    rows = sampled.mapInArrow(
        lambda batches: map(placed, batches), "positive boolean, at array<int>"
    ).toArrow()
    at = [np.sort(np.array(x, np.int64)) for x in rows.column("at").to_pylist()]
    positive = np.array(rows.column("positive").to_pylist(), bool)
    order = sorted(range(len(at)), key=lambda i: (positive[i], at[i].tobytes()))
    weights, bias = fit_weights([at[i] for i in order], positive[order], prior, len(names))
    return Model(dict(zip(names, weights.tolist(), strict=True)), bias)


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `docs`.

    The whole text is scored; nothing else is looked at. Null and empty texts
    get the score of a text without known words. Equal texts get equal scores.
    Repeated rows are returned as often as they come; an empty table gives no
    rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = [shared.value.score(text) for text in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"]
        )

    source = docs.select(F.col("doc_id").cast("long"), utf8("text").alias("text"))
    return map_slices(source, run, "doc_id long, score double", "text").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` that are not predicted toxic, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return filter_texts(docs, lambda texts: [shared.value.score(text) < 0.5 for text in texts])
