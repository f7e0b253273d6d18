"""Label policies: which ratings form the classes, and what the class column holds.

| policy         | negatives | positives | class            | distinct lines | reading |
| multi          | 1, 2, 3   | 5         | the rating       | no             | jvm     |
| binary_drop4   | 1, 2, 3   | 5         | 1 if rating > 4  | no             | jvm     |
| binary_4neg    | 1 .. 4    | 5         | 1 if rating > 4  | yes            | python  |
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.operators.clean import distinct_lines, parse_lines


@dataclass(frozen=True)
class Policy:
    name: str
    negatives: tuple[int, ...]
    positives: tuple[int, ...]
    binary: bool
    distinct: bool
    reading: str

    @property
    def ratings(self) -> tuple[int, ...]:
        return self.negatives + self.positives

    @property
    def positive_label(self) -> int:
        return 1 if self.binary else self.positives[0]


# The three policies found in the reference.
POLICIES = {
    "multi": Policy("multi", (1, 2, 3), (5,), binary=False, distinct=False, reading="jvm"),
    "binary_drop4": Policy("binary_drop4", (1, 2, 3), (5,), binary=True, distinct=False,
                           reading="jvm"),
    "binary_4neg": Policy("binary_4neg", (1, 2, 3, 4), (5,), binary=True, distinct=True,
                          reading="python"),
}


def binary_label(rating: str = "rating") -> F.Column:
    """1 for a rating above 4, else 0."""
    return F.when(F.col(rating) > 4, F.lit(1)).otherwise(F.lit(0))


def label(reviews: DataFrame, policy: str | Policy, key: str = "doc_id") -> DataFrame:
    """Parsed reviews -> ``(key, label, document)`` under a policy (one filter, one project)."""
    p = POLICIES[policy] if isinstance(policy, str) else policy
    lab = binary_label() if p.binary else F.col("rating")
    return (reviews.filter(F.col("rating").isin(*p.ratings))
            .select(key, lab.cast("int").alias("label"), "document"))


def labelled_reviews(lines: DataFrame, policy: str | Policy, key: str = "doc_id",
                     distinct: bool | None = None, strict: bool = False) -> DataFrame:
    """Review lines -> labelled reviews: [distinct lines] -> parse -> label."""
    p = POLICIES[policy] if isinstance(policy, str) else policy
    if p.distinct if distinct is None else distinct:
        lines = distinct_lines(lines, key)
    return label(parse_lines(lines, reading=p.reading, strict=strict), p, key)


def negatives_union(reviews: DataFrame, ratings: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Negatives as a bag union of one filter per rating (the reference's form)."""
    parts = [reviews.filter(F.col("rating") == r) for r in ratings]
    return reduce(lambda a, b: a.unionByName(b), parts)


def negatives_isin(reviews: DataFrame, ratings: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Negatives in one pass; must equal ``negatives_union``."""
    return reviews.filter(F.col("rating").isin(*ratings))
