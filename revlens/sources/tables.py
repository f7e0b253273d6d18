"""The driver tables and the review view built on them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.functions.text import flatten_breaks

DEFAULT_SF_DIR = "/root/testdata/sf0.01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (parquet). Column pruning and filters reach the scan."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def rating_text() -> F.Column:
    """Rating field of the review view (first matching rule wins).

    Fixed values of the view: doc_id divisible by 97 -> empty rating, by 89 -> the header
    word 'Rating', quality 1 -> '5', quality 0 -> '1', '2' or '3' by doc_id mod 3, no label -> '4'.
    No row is dropped: every document becomes one review line.
    """
    d = F.col("doc_id")
    return (F.when(d % 97 == 0, F.lit(""))
            .when(d % 89 == 0, F.lit("Rating"))
            .when(F.col("quality") == 1, F.lit("5"))
            .when(F.col("quality") == 0, (F.lit(1) + d % 3).cast("string"))
            .otherwise(F.lit("4")))


def review_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, line)`` with ``line = rating || TAB || document``: the extracted review file.

    ``documents`` is joined to the much narrower ``labels`` on ``doc_id``; adaptive execution
    broadcasts ``labels`` when it is small and keeps a shuffled join when it is not, so no
    size is assumed here.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return (docs.join(labels, "doc_id", "left")
            .select("doc_id",
                    F.concat(rating_text(), F.lit("\t"), flatten_breaks("text")).alias("line")))


def review_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, value)``: the review table as raw comma-separated rows, rating in field 2
    and review text in field 10 (the layout of the reference's raw file), text unquoted.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    filler = [F.lit("-")] * 5
    return (docs.join(labels, "doc_id", "left")
            .select("doc_id",
                    F.concat_ws(",", F.col("doc_id").cast("string"), "lang", rating_text(),
                                "source", F.col("n_chars").cast("string"), *filler,
                                flatten_breaks("text")).alias("value")))
