"""From raw documents to packed training sequences: five stages, each written and reread."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from faremill.llm import minhash, mixing, packing, quality, secrets
from faremill.llm.storage import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents outside the compression bands or the base rules go."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return minhash.keep_one(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark in the text."""
    return secrets.redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken as often as the mixture says; toxic ones are left out."""
    return mixing.mix_sources(docs, table(spark, sf_dir, "labels"))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in their sequences, with the token ids."""
    plan = packing.Packing(public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(docs, plan)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("secret_scans", secret_scans),
    ("source_mixing", source_mixing),
    ("sequence_packing", sequence_packing),
]

# zstandard, MinHash and packing have no SQL form; tests/llm checks the stages instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
