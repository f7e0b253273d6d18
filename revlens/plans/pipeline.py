"""The training chain shared by the model queries.

review lines -> labelled reviews (policy) -> balanced classes -> train/test split
  -> words (any tokenizer, stop words optional) -> term counts -> IDF -> TF-IDF -> model

A tokenizer is a function ``(documents (key, document)) -> (key, words)``. ``WORDS`` cuts
spaced text by the word pattern; ``segmented(mode, lexicon)`` makes one from the dictionary
segmenter. A fitted model with its IDF can be saved as parquet and loaded again, and scoring
reads those tables only.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.functions import text as T
from revlens.operators import features as feat
from revlens.operators import segment as seg
from revlens.operators.bayes import NaiveBayesModel, nb_fit, nb_predict
from revlens.operators.label import POLICIES, Policy, labelled_reviews
from revlens.operators.sample import balance, hash_split
from revlens.operators.svm import ITERATIONS, SVMModel, svm_fit, svm_predict
from revlens.session import drop_table, materialize
from revlens.sources.tables import review_lines

# Features of the model queries: md5 buckets (2**20, the reference's larger size), so the
# vocabulary tables have a proven size bound and any SQL engine can recompute the buckets.
MODEL_HASHING = feat.MD5_20

Tokenizer = Callable[[DataFrame], DataFrame]


def by_pattern(words: Callable = T.words) -> Tokenizer:
    """Tokens of spaced text: ``words`` is one of the word-array expressions."""
    return lambda docs: docs.select(docs.columns[0], words("document").alias("words"))


WORDS = by_pattern()


@dataclass(frozen=True)
class Segmented:
    """The tokenizer that ``segmented`` makes."""
    mode: str
    lexicon: DataFrame
    despaced: bool
    stop_words: bool
    latin_parts: bool
    settings: dict

    def _texts(self, docs: DataFrame) -> DataFrame:
        return docs.withColumn("document", T.despace("document")) if self.despaced else docs

    def __call__(self, docs: DataFrame) -> DataFrame:
        key = docs.columns[0]
        words = seg.segment_lists(self._texts(docs), self.lexicon, self.mode, key, "document", **self.settings)
        if self.stop_words:
            words = words.withColumn("words", T.remove_stop_words("words"))
        if self.latin_parts:
            words = words.withColumn("words", T.with_latin_parts("words"))
        return words

    def counts_words(self, hashing: feat.Hashing) -> bool:
        """Whether ``term_counts`` can do it: no step needs the tokens' text."""
        return hashing.kind == "md5" and not self.latin_parts

    def term_counts(self, docs: DataFrame, hashing: feat.Hashing, carry: list[str]) -> DataFrame:
        """``features.term_counts`` of the tokens, stop words dropped, without writing the tokens."""
        settings = self.settings | ({"clear_stop_words": True} if self.stop_words else {})
        return seg.segment_counts(self._texts(docs), self.lexicon, hashing, self.mode, docs.columns[0], "document",
                                  carry=carry, **settings)


def segmented(mode: str, lexicon: DataFrame, despaced: bool = False, stop_words: bool = False,
              latin_parts: bool = False, **settings) -> Segmented:
    """Tokens of unsegmented text by the dictionary segmenter. ``despaced`` removes the blanks
    first (for spaced text standing in for unsegmented), ``stop_words`` drops the stop words,
    ``latin_parts`` appends the second split of mixed Latin tokens."""
    return Segmented(mode, lexicon, despaced, stop_words, latin_parts, settings)


@dataclass
class Experiment:
    split: DataFrame      # (doc_id, label, split)
    train: DataFrame      # (doc_id, label)
    test: DataFrame       # (doc_id, label)
    idf: DataFrame        # (term, df, idf)
    tfidf: DataFrame      # (doc_id, label, split, term, tf, tfidf), written if asked for
    classes: list[int]
    hashing: feat.Hashing
    fit_docs: DataFrame   # (doc_id, ...) rows the IDF was fitted on


def balanced(spark: SparkSession, sf_dir: str, policy: str | Policy) -> DataFrame:
    p = POLICIES[policy] if isinstance(policy, str) else policy
    return balance(labelled_reviews(review_lines(spark, sf_dir), p),
                   positive_label=p.positive_label)


def experiment(spark: SparkSession, sf_dir: str, policy: str | Policy = "binary_drop4",
               hashing: feat.Hashing = MODEL_HASHING, fit_on: str = "train",
               tokenizer: Tokenizer = WORDS, write_tfidf: bool = True) -> Experiment:
    """Run the chain up to TF-IDF; words, IDF and TF-IDF are written to the checkpoint folder (a
    segmenter's words only as their counts). ``fit_on="all"`` fits the IDF on train and test rows
    together, as the reference did. Without ``write_tfidf`` the TF-IDF is made from the written counts
    and IDF where it is read: cheaper for a model that reads each row once."""
    p = POLICIES[policy] if isinstance(policy, str) else policy
    labelled = labelled_reviews(review_lines(spark, sf_dir), p)
    if p.distinct:  # balancing reads the reviews more than once: their lines are compared only once
        labelled = materialize(labelled, "labelled")
    docs = materialize(hash_split(balance(labelled, positive_label=p.positive_label)), "balanced")
    if p.distinct:
        drop_table(labelled)
    # label and split ride along with the term counts, so train/test selection below is a
    # filter on the written table, not a join back by document
    counted = isinstance(tokenizer, Segmented) and tokenizer.counts_words(hashing)
    if counted:
        rows = materialize(docs.select("doc_id", "label", "split"), "split")
        counts = tokenizer.term_counts(docs.filter(F.col("doc_id").isNotNull()), hashing, ["label", "split"])
    else:
        words = tokenizer(docs.select("doc_id", "document"))
        rows = materialize(docs.select("doc_id", "label", "split").join(words, "doc_id")
                           if tokenizer is not WORDS else
                           docs.select("doc_id", "label", "split", T.words("document").alias("words")), "words")
        counts = feat.term_counts(rows, hashing=hashing, carry=["label", "split"])
    sp = rows.select("doc_id", "label", "split")
    train = sp.filter(F.col("split") == "train").select("doc_id", "label")
    test = sp.filter(F.col("split") == "test").select("doc_id", "label")
    tc = materialize(counts, "term-counts")
    if counted:
        drop_table(docs)  # the texts
    fit_docs = train if fit_on == "train" else sp.select("doc_id")
    fit_tc = tc.filter(F.col("split") == "train") if fit_on == "train" else tc
    idf_t = materialize(feat.idf(fit_tc, fit_docs), "idf")
    x = feat.tfidf(tc, idf_t, hashing, fit_docs=fit_docs)
    if write_tfidf:
        x = materialize(x, "tfidf")
    classes = sorted({p.positive_label, *((0,) if p.binary else p.negatives)})
    return Experiment(sp, train, test, idf_t, x, classes, hashing, fit_docs)


def _rows_of(e: Experiment, split: str, with_label: bool) -> DataFrame:
    cols = ["doc_id", "label", "term", "tfidf"] if with_label else ["doc_id", "term", "tfidf"]
    return e.tfidf.filter(F.col("split") == split).select(*cols)


def fit_naive_bayes(e: Experiment, smoothing: float = 1.0) -> NaiveBayesModel:
    return nb_fit(_rows_of(e, "train", True), e.train, e.classes, smoothing=smoothing,
                  hashing=e.hashing)


def predict_test(e: Experiment, model: NaiveBayesModel) -> DataFrame:
    return nb_predict(model, _rows_of(e, "test", False), e.test)


def fit_svm(e: Experiment, iterations: int = ITERATIONS) -> SVMModel:
    return svm_fit(_rows_of(e, "train", True), e.train, iterations=iterations,
                   hashing=e.hashing)


def svm_predict_test(e: Experiment, model: SVMModel) -> DataFrame:
    return svm_predict(model, _rows_of(e, "test", False), e.test).select("doc_id", "label",
                                                                         "prediction")


# -- saved models ---------------------------------------------------------------------------

@dataclass
class Scorer:
    """A fitted model with the IDF it needs: all that scoring reads."""
    model: NaiveBayesModel | SVMModel
    idf: DataFrame
    n_docs: int           # documents the IDF was fitted on

    def save(self, path: str) -> None:
        """Write the tables and a one-row table of parameters under ``path``."""
        m = self.model
        spark = self.idf.sparkSession
        about = {"n_docs": self.n_docs, "hashing": [m.hashing.kind, m.hashing.num_features]}
        if isinstance(m, NaiveBayesModel):
            about |= {"kind": "bayes", "classes": m.classes, "smoothing": m.smoothing}
            m.priors.write.mode("overwrite").parquet(f"{path}/priors")
        else:
            about |= {"kind": "svm", "iterations": m.iterations, "threshold": m.threshold}
        m.weights.write.mode("overwrite").parquet(f"{path}/weights")
        self.idf.write.mode("overwrite").parquet(f"{path}/idf")
        spark.createDataFrame([(json.dumps(about),)], "about string").write.mode("overwrite").parquet(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Scorer:
        about = json.loads(spark.read.parquet(f"{path}/about").first()[0])
        hashing = feat.Hashing(*about["hashing"])
        weights = spark.read.parquet(f"{path}/weights")
        if about["kind"] == "bayes":
            model = NaiveBayesModel(about["classes"], spark.read.parquet(f"{path}/priors"), weights,
                                    about["smoothing"], hashing)
        else:
            model = SVMModel(weights, about["iterations"], hashing, about["threshold"])
        return cls(model, spark.read.parquet(f"{path}/idf"), about["n_docs"])


def scorer(e: Experiment, model: NaiveBayesModel | SVMModel) -> Scorer:
    return Scorer(model, e.idf, e.fit_docs.count())


def score_texts(s: Scorer, texts: DataFrame, key: str, text_col: str = "text",
                tokenizer: Tokenizer = WORDS) -> DataFrame:
    """Score new texts: words -> buckets -> TF-IDF with the fitted IDF -> prediction. ``texts``
    may have any size; its other columns are passed through to the result."""
    words = tokenizer(texts.select(key, F.col(text_col).alias("document")))
    tc = feat.term_counts(words, key=key, hashing=s.model.hashing)
    x = feat.tfidf(tc, s.idf, s.model.hashing, key=key, n_docs=s.n_docs)
    docs = texts.drop(text_col)
    if isinstance(s.model, NaiveBayesModel):
        return nb_predict(s.model, x, docs, key=key)
    return svm_predict(s.model, x, docs, key=key).select(*docs.columns, "prediction")


def with_distinct_lines(policy: str) -> Policy:
    """A policy on distinct lines, in the Python reading."""
    return replace(POLICIES[policy], distinct=True, reading="python")
