"""From raw documents to token ids: toxic and repeated texts and benchmark passages go first."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tremorlane.llm.byte_bpe import bpe_digests
from tremorlane.llm.common import staged
from tremorlane.llm.decontaminate import drop_contaminated
from tremorlane.llm.exact_dedup import drop_exact_copies
from tremorlane.llm.queries import BYTE_RANKS, importable, table
from tremorlane.llm.simhash import drop_near_copies
from tremorlane.llm.toxicity import drop_toxic, fit_toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic by a model fitted on them and the table of labels.

    Null and empty texts are scored like any other; without toxic labels every
    document stays.
    """
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return drop_toxic(docs, model)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, white space aside, the one of smallest doc_id, null last."""
    importable(spark)
    return drop_exact_copies(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that fingerprints at most two bits apart connect, the one of smallest doc_id.

    Null comes last; texts without words form one group.
    """
    importable(spark)
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs; all if there are no items."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, ids_sha256, decoded_sha256); an empty text has no ids."""
    importable(spark)
    ranks, pattern = public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN
    return bpe_digests(docs, ranks, pattern)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

#: SQL expresses neither the classifier nor the near copies.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole table of documents.

    What a stage returns is written to the shared folder and read again by the
    next one, so a lost executor costs no more than one stage. Every stage
    keeps all columns, takes empty tables, nulls and repeated rows, and is
    described for these at its operator.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
