"""Counts, word frequencies, top-n, word-cloud weights, accuracy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions.text import explode_elements


def rating_histogram(reviews: DataFrame, rating: str = "rating") -> DataFrame:
    """Rows per rating in one scan (the reference ran one filtered count per rating)."""
    return reviews.groupBy(rating).agg(F.count(F.lit(1)).alias("n"))


def word_counts(docs: DataFrame, words_col: str = "words") -> DataFrame:
    """``(word, n)``: flatten word arrays, count per word (partial + final hash aggregate)."""
    return (docs.select(*explode_elements(words_col, "word"))
            .filter(F.col("word").isNotNull())
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def top_words(counts: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` most frequent words, ties by word: ``TakeOrderedAndProject``, n rows per task."""
    return counts.orderBy(F.desc("n"), F.asc("word")).limit(n)


def words_by_count(counts: DataFrame) -> DataFrame:
    """All words, most frequent first, ties by word: a range-partitioned sort."""
    return counts.orderBy(F.desc("n"), F.asc("word"))


def word_cloud_weights(counts: DataFrame, lo: float = 20.0, hi: float = 100.0) -> DataFrame:
    """``(word, n, size)``: the counts of all words scaled linearly onto ``[lo, hi]`` (``lo``
    when all are equal). The smallest and largest count are scalar subqueries."""
    lo_n, hi_n = counts.agg(F.min("n")).scalar(), counts.agg(F.max("n")).scalar()
    top = counts
    span = hi_n - lo_n
    size = F.when(span == 0, F.lit(lo)).otherwise(F.lit(lo) + F.lit(hi - lo) * (F.col("n") - lo_n) / span)
    return top.select("word", "n", size.cast("double").alias("size"))


def accuracy(predictions: DataFrame, label: str = "label",
             prediction: str = "prediction") -> DataFrame:
    """One row ``(n_test, n_correct, accuracy)`` in one pass; a missing prediction is wrong."""
    hit = (F.col(label).cast("double") == F.col(prediction).cast("double")).cast("long")
    return predictions.agg(F.count(F.lit(1)).alias("n_test"),
                           F.coalesce(F.sum(hit), F.lit(0)).cast("long").alias("n_correct"),
                           (F.coalesce(F.sum(hit), F.lit(0)) / F.nullif(F.count(F.lit(1)), F.lit(0)))
                           .cast("double").alias("accuracy"))


def correct_predictions(predictions: DataFrame, label: str = "label",
                        prediction: str = "prediction") -> DataFrame:
    """Rows whose prediction equals the label."""
    return predictions.filter(F.col(label).cast("double") == F.col(prediction).cast("double"))


def evaluate_accuracy(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    """Accuracy by Spark ML's evaluator; rows without a label or prediction are left out, as it
    does not take them."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    rows = predictions.select(F.col(label).cast("double").alias("label"),
                              F.col(prediction).cast("double").alias("prediction")).na.drop()
    return MulticlassClassificationEvaluator(
        labelCol="label", predictionCol="prediction", metricName="accuracy").evaluate(rows)
