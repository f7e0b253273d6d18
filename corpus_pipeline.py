"""The corpus pipeline: language ID, near-duplicate removal, repeated-string removal, packing.

Each stage is ``f(spark, docs, sf_dir) -> DataFrame``; its rows are written as parquet and read
back as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import language, neardup, packing, suffix_dedup
from revlens.llm.common import ship_package, write_scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Words of a shingle in the near-duplicate stage.
SHINGLE = 5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language: null texts and texts without any letter. The model is
    fitted on the labelled documents that came in and are not held out; without any, only the
    letters decide. Documents that have a language keep all their columns as they were."""
    ship_package(spark)
    model = language.fit(language.fitting_rows(docs))
    if not model.languages:
        return language.with_letters(docs.select(*COLUMNS))
    found = language.identify(docs.select(*COLUMNS), model)
    return found.where(F.col("lang_pred") != language.UNDETERMINED).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates: the one with the smallest doc_id, then
    the smallest hash of its text. Rows that share an id but not their text are documents of their
    own; of rows with the same id and text one stays, rows without an id all stay."""
    ship_package(spark)
    docs = docs.select(*COLUMNS, F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("_text"))
    kept = neardup.kept_rows(docs, "_text", SHINGLE).withColumnsRenamed({"doc_id": "_id", "_text": "_kept"})
    first = docs.join(kept, (F.col("doc_id") == F.col("_id")) & (F.col("_text") == F.col("_kept")), "left_semi")
    others = [c for c in COLUMNS if c not in ("doc_id", "text")]
    first = first.groupBy("doc_id", "_text").agg(F.max("text").alias("text"), F.min(F.struct(*others)).alias("_others"))
    return first.select("doc_id", "text", "_others.*").select(*COLUMNS).unionByName(
        docs.where("doc_id IS NULL").select(*COLUMNS))


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut every string of 200 bytes that also starts anywhere else out of the texts. A cut that
    splits a character takes the rest of it too; a text with nothing left goes. n_chars is
    counted anew."""
    ship_package(spark)
    cut = suffix_dedup.without_repeats(docs.select(*COLUMNS), carried=("lang", "source"))
    return cut.where("text <> ''").select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of at most 2048 tokens: one row for each piece."""
    ship_package(spark)
    return packing.pack_documents(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can't express the stages; tests hold ``run`` against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_scratch(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
