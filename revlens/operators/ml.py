"""The Spark ML route: the same chain as a ``Pipeline`` that can be saved, loaded and
applied to any table (or stream) of reviews.

StringIndexer (any label values) -> RegexTokenizer (the word pattern) -> md5 buckets as strings
-> CountVectorizer -> IDF -> NaiveBayes or LinearSVC -> IndexToString (``predicted``: a label value
again).
The vocabulary that CountVectorizer gathers has at most as many entries as there are buckets,
and the buckets are portable, so other engines can recompute the model.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LinearSVCModel, NaiveBayes
from pyspark.ml.feature import (IDF, CountVectorizer, IndexToString, RegexTokenizer, SQLTransformer,
                                StringIndexer)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.functions.hashing import md5_num_features
from revlens.functions.text import WORD_PATTERN
from revlens.operators.svc import svc_fit
from revlens.operators.svm import DENSE_ROWS
from revlens.session import drop_table, materialize

HEX_DIGITS = 5
#: Most terms with which LinearSVC itself searches: it sends 8 bytes a term to the driver in each of its
#: about 200 evaluations.
LIBRARY_TERMS = 1 << 16


def fit_review_model(train: DataFrame, hex_digits: int = HEX_DIGITS, smoothing: float = 1.0,
                     text_col: str = "document", label_col: str = "label", classifier: str = "bayes",
                     iterations: int = 100, reg_param: float = 0.01) -> PipelineModel:
    """Fit on ``(document, label)``; the labels may be any values, two of them for ``svm``.

    ``classifier``: ``bayes`` (multinomial, ``smoothing``) or ``svm`` (linear, hinge loss, no
    intercept, ``iterations`` steps of a quasi-Newton search at most, ``reg_param``; the search of
    LinearSVC, with more than ``LIBRARY_TERMS`` terms run by ``svc.svc_fit``).
    """
    index = StringIndexer(inputCol=label_col, outputCol="label_index").fit(train)
    tokens = RegexTokenizer(inputCol=text_col, outputCol="words", pattern=WORD_PATTERN,
                            gaps=False, toLowercase=True)
    buckets = SQLTransformer(statement="SELECT *, transform(words, w -> conv(substr(md5(w), 1, "
                                       f"{hex_digits}), 16, 10)) AS buckets FROM __THIS__")
    counts = CountVectorizer(inputCol="buckets", outputCol="rawFeatures", vocabSize=md5_num_features(hex_digits))
    idf = IDF(inputCol="rawFeatures", outputCol="features")
    back = IndexToString(inputCol="prediction", outputCol="predicted", labels=index.labels)
    if classifier == "bayes":
        model = NaiveBayes(featuresCol="features", labelCol="label_index", smoothing=smoothing, modelType="multinomial")
        return Pipeline(stages=[index, tokens, buckets, counts, idf, model, back]).fit(train)
    if classifier == "svm":
        features = Pipeline(stages=[index, tokens, buckets, counts, idf]).fit(train)
        n_terms = len(features.stages[3].vocabulary)
        model = _fit_svm(features.transform(train), n_terms, len(index.labels), iterations, reg_param)
        return PipelineModel([*features.stages, model, back])
    raise ValueError(f"unknown classifier {classifier!r}")


def _fit_svm(rows: DataFrame, n_terms: int, n_labels: int, iterations: int, reg_param: float) -> LinearSVCModel:
    library = LinearSVC(featuresCol="features", labelCol="label_index", maxIter=iterations, regParam=reg_param,
                        fitIntercept=False, standardization=False)
    if n_terms <= LIBRARY_TERMS or n_labels != 2:
        return library.fit(rows)
    n_rows = rows.count()
    if n_rows > DENSE_ROWS:
        return library.fit(rows)
    keyed = rows.select(F.monotonically_increasing_id().alias("key"), (2 * F.col("label_index") - 1).alias("ys"),
                        F.unwrap_udt("features").alias("v"))
    entries = materialize(keyed.select("key", "ys", F.explode(F.arrays_zip(
        F.col("v.indices").alias("term"), F.col("v.values").alias("x"))).alias("e")).select("key", "e.term", "e.x", "ys"),
        "svc-matrix")
    weights = svc_fit(entries, n_terms, n_rows, iterations, reg_param, library.getTol())
    drop_table(entries)
    model = LinearSVCModel._create_from_java_class("org.apache.spark.ml.classification.LinearSVCModel", library.uid,
                                                   Vectors.dense(weights), 0.0)
    return library._copyValues(model)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, reviews: DataFrame) -> DataFrame:
    """Apply a fitted pipeline to any number of reviews (a one-row table scores one)."""
    return model.transform(reviews)


def dense_features(df: DataFrame, col: str = "features", out: str = "dense") -> DataFrame:
    """Vector column -> array<double> (for export); the training path stays sparse."""
    from pyspark.ml.functions import vector_to_array
    return df.withColumn(out, vector_to_array(col))


def score_one(model: PipelineModel, text: str) -> DataFrame:
    """Score one new review: a one-row table through the same fitted pipeline."""
    spark = SparkSession.getActiveSession()
    return model.transform(spark.createDataFrame([(text,)], "document string"))
