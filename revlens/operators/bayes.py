"""Multinomial Naive Bayes, fitted and applied as relational plans.

Model (smoothing lambda, V features, K classes, N training documents):

    pi_c        = ln((n_c + lambda) / (N + K * lambda))
    theta_{c,j} = ln((s_{c,j} + lambda) / (S_c + V * lambda))

with ``s_{c,j}`` the sum of feature j over documents of class c and ``S_c = sum_j s_{c,j}``.
These are the formulas Spark ML's ``NaiveBayes`` (multinomial) uses. A document x scores

    score_c = pi_c + X * (ln(lambda) - ln(S_c + V*lambda)) + sum_{j seen in c} x_j * ln(1 + s_{c,j}/lambda)

where X = sum_j x_j. A term never seen with class c adds exactly ln(lambda / (S_c + V lambda))
per unit, so only seen (class, term) pairs need a row: no class x vocabulary grid.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.operators.features import EXACT, Hashing, join_by_term


@dataclass
class NaiveBayesModel:
    classes: list[int]          # class labels, ascending (known from the label policy)
    priors: DataFrame           # (label, n_docs, pi, log_norm): K rows
    weights: DataFrame          # (label, term, s, theta): seen (class, term) pairs
    smoothing: float
    hashing: Hashing

    def wide_weights(self) -> DataFrame:
        """(term, docs, w_<c>...) with ``w = ln(1 + s / lambda)``; one row per term."""
        lam = self.smoothing
        aggs = [F.max(F.when(F.col("label") == c, F.log1p(F.col("s") / lam))).alias(f"w_{i}")
                for i, c in enumerate(self.classes)]
        return (self.weights.groupBy("term")
                .agg(F.sum("docs").alias("docs"), *aggs))

    def prior_values(self) -> list[tuple[F.Column, F.Column]]:
        """(pi, log_norm) of each class position as scalar subqueries (null for a class
        without training rows, which then never wins)."""
        out = []
        for c in self.classes:
            row = self.priors.filter(F.col("label") == c)
            out.append((row.agg(F.max("pi")).scalar(), row.agg(F.max("log_norm")).scalar()))
        return out


def nb_fit(features: DataFrame, labels: DataFrame, classes: list[int], smoothing: float = 1.0,
           hashing: Hashing = EXACT, key: str = "doc_id", value: str = "tfidf") -> NaiveBayesModel:
    """Fit on long-form features ``(key, term, value)`` and ``labels (key, label)``
    (features that already hold a ``label`` column are used as they are).

    One shuffled join on the document key (none when the features carry the label), one
    hash aggregate on (label, term) with map-side
    partial sums, and K-row aggregates for the priors. V is the bucket count for hashed
    features (Spark ML counts every bucket) and the observed vocabulary for exact terms.
    """
    lam = float(smoothing)
    if lam <= 0:
        raise ValueError("smoothing must be positive: an unseen term would have no probability")
    k = len(classes)
    # features may already carry the label (no join back by document then)
    labelled = (features if "label" in features.columns
                else features.join(labels.select(key, "label"), key))
    sums = (labelled
            .groupBy("label", "term")
            .agg(F.sum(value).alias("s"), F.count(F.lit(1)).alias("docs")))
    if hashing.bound is not None:
        vocab = F.lit(hashing.bound).cast("long")
    else:
        vocab = sums.select("term").distinct().agg(F.count(F.lit(1))).scalar()
    per_class = sums.groupBy("label").agg(F.sum("s").alias("_S"))
    counts = labels.groupBy("label").agg(F.count(F.lit(1)).alias("n_docs"))
    total = counts.agg(F.sum("n_docs")).scalar()
    priors = (counts.join(per_class, "label", "left")
              .select("label", "n_docs",
                      F.log((F.col("n_docs") + lam) / (total + k * lam)).alias("pi"),
                      F.log(F.coalesce(F.col("_S"), F.lit(0.0)) + vocab * lam)
                      .alias("log_norm")))
    weights = (sums.join(F.broadcast(priors.select("label", "log_norm")), "label")
               .select("label", "term", "s", "docs",
                       (F.log(F.col("s") + lam) - F.col("log_norm")).alias("theta")))
    return NaiveBayesModel(sorted(classes), priors, weights, lam, hashing)


def nb_scores(model: NaiveBayesModel, features: DataFrame, docs: DataFrame,
              key: str = "doc_id", value: str = "tfidf") -> DataFrame:
    """Per-document class scores ``score_<i>`` (i = class position) and ``prediction``.

    Features meet the per-term weights in one join (broadcast for hashed features; hot
    terms salted for exact ones), then one hash aggregate per document computes X and
    the K weighted sums together. ``docs`` supplies every document to score, including
    those without a single known term (their score is the prior plus the X = 0 term).
    """
    k = len(model.classes)
    wide = model.wide_weights()
    joined = join_by_term(features, wide, model.hashing, weight="docs", how="left")
    sums = joined.groupBy(key).agg(
        F.sum(value).alias("_X"),
        *[F.sum(F.col(value) * F.coalesce(F.col(f"w_{i}"), F.lit(0.0))).alias(f"_sw_{i}")
          for i in range(k)])
    log_lam = math.log(model.smoothing)
    base = docs.join(sums, key, "left")
    x = F.coalesce(F.col("_X"), F.lit(0.0))
    scores = [(pi + x * (F.lit(log_lam) - ln) + F.coalesce(F.col(f"_sw_{i}"), F.lit(0.0)))
              .alias(f"score_{i}") for i, (pi, ln) in enumerate(model.prior_values())]
    scored = base.select(*docs.columns, *scores)
    best = F.greatest(*[F.col(f"score_{i}") for i in range(k)]) if k > 1 else F.col("score_0")
    pred = F.lit(None).cast("int")
    for i in reversed(range(k)):  # first class (smallest label) wins a tie
        pred = F.when(F.col(f"score_{i}") == best, F.lit(model.classes[i])).otherwise(pred)
    return scored.withColumn("prediction", pred)


def nb_predict(model: NaiveBayesModel, features: DataFrame, docs: DataFrame,
               key: str = "doc_id", value: str = "tfidf") -> DataFrame:
    """``docs`` columns plus ``prediction``."""
    return nb_scores(model, features, docs, key, value).select(*docs.columns, "prediction")
