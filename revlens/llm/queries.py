"""Queries of the training-data operators: ``f(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import (ann, byte_bpe, fingerprints, language, lexical, licenses, merkle, neardup, packing,
                         simhash, suffix_dedup, token_trie, wavelet)
from revlens.llm.common import ship_package
from revlens.llm.oracle import ORACLE  # noqa: F401

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_docs(spark, sf_dir), public_tokenizers.path(WORD_BPE))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_docs(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edited(_docs(spark, sf_dir))


def op4_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_trie.count_tokens(_docs(spark, sf_dir), public_tokenizers.path(PIECES))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predictions(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op6_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.round_trip(_docs(spark, sf_dir), public_tokenizers.path(WORD_BPE))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summarize(licenses.scan(_docs(spark, sf_dir)))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.group_near_duplicates(_docs(spark, sf_dir))


def op9_cross_polytope_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(_docs(spark, sf_dir), public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)


def op11_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.group_near_duplicates(_docs(spark, sf_dir))


def op12_block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(_docs(spark, sf_dir), _table(spark, sf_dir, "benchmark"), k=10)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_document_fingerprints": op3_document_fingerprints,
    "op4_trie_token_counts": op4_trie_token_counts,
    "op5_language_id": op5_language_id,
    "op6_wavelet_shards": op6_wavelet_shards,
    "op7_license_scan": op7_license_scan,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_cross_polytope_neighbours": op9_cross_polytope_neighbours,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_simhash_pigeonring": op11_simhash_pigeonring,
    "op12_block_max_search": op12_block_max_search,
    "op13_merkle_manifest": op13_merkle_manifest,
}
