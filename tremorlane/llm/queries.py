"""One registered query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tremorlane.llm.alignment import align_tokens
from tremorlane.llm.byte_bpe import bpe_digests
from tremorlane.llm.decontaminate import contamination_digest
from tremorlane.llm.exact_dedup import exact_copies
from tremorlane.llm.forced_boundary import boundary_digests
from tremorlane.llm.merkle import manifest_digest
from tremorlane.llm.simhash import simhash_components
from tremorlane.llm.substring_dedup import repeat_digest
from tremorlane.llm.token_counts import token_counts
from tremorlane.llm.token_store import stored_token_digest
from tremorlane.llm.toxicity import fit_toxicity, score_toxicity
from tremorlane.llm.url_filter import judge_urls
from tremorlane.llm.warc import archive_pages

Query = Callable[[SparkSession, str], DataFrame]

BYTE_PAIRS = "byte_bpe_50k.json"
BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"
WORD_PIECES = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where it is not installed but on a shared path."""
    environment = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        environment["PYTHONPATH"] = f"{root}:{known}".rstrip(":")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path(WORD_PIECES)
    return stored_token_digest(table(spark, sf_dir, "documents"), tokenizer)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages")).drop("payload")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN
    return bpe_digests(table(spark, sf_dir, "documents"), ranks, pattern).drop("ids")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages")).drop("strict_terms", "soft_terms")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = table(spark, sf_dir, "benchmark")
    return contamination_digest(table(spark, sf_dir, "documents"), benchmark)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digest(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_copies(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = public_tokenizers.path(BYTE_PAIRS), public_tokenizers.path(PIECES)
    return align_tokens(table(spark, sf_dir, "documents"), first, second)


def op12_forced_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return boundary_digests(docs, public_tokenizers.path(BYTE_PAIRS))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_simhash_dedup": op1_simhash_dedup,
    "op2_token_store": op2_token_store,
    "op3_warc": op3_warc,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_url_filter": op5_url_filter,
    "op6_decontamination": op6_decontamination,
    "op7_token_counts": op7_token_counts,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_forced_boundary_bpe": op12_forced_boundary_bpe,
    "op13_merkle_manifest": op13_merkle_manifest,
}
