"""The training-data operators as queries over whole tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.llm import language_id, language_model, manifest, minhash, mixing, neighbours, oracle, packing, pages, quality, repeats, secrets, substrings, vectors
from faremill.llm.storage import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_doubled_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.with_digest(substrings.dedup(table(spark, sf_dir, "documents")))


def op2_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(table(spark, sf_dir, "documents"))


def op3_queue_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = packing.Packing(public_tokenizers.path("word_bpe_49k.json"))
    return packing.with_digest(packing.pack(table(spark, sf_dir, "documents"), plan))


def op4_code_switch_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op5_pivot_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.join(table(spark, sf_dir, "embeddings"))


def op6_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.find(table(spark, sf_dir, "documents"))


def op7_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


def op9_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op10_secret_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find(table(spark, sf_dir, "documents"))


def op11_scaled_minimizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.with_digest(repeats.collapse(repeats.planted(table(spark, sf_dir, "documents"))))


def op12_subtree_exchange(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return manifest.with_digest(manifest.manifest(docs, manifest.tampered(docs)))


def op13_stable_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.expr("vec_id % 20 = 0"))


QUERIES: dict[str, Query] = {
    query.__name__: query for query in (op1_doubled_windows, op2_context_tree, op3_queue_packing, op4_code_switch_crf, op5_pivot_cells, op6_dart_minhash, op7_soft_mixing, op8_wrapper_induction, op9_compression_bands, op10_secret_battery, op11_scaled_minimizers, op12_subtree_exchange, op13_stable_probes)
}

# The others have no SQL form (zstandard, hashes of positions, tokenizers, learned models) or
# find what SQL would not (approximate search): see tests/llm.
ORACLE: dict[str, str] = dict(oracle.ORACLE)
