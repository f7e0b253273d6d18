"""Term counts, document frequency, IDF and TF-IDF in long form ``(doc, term, value)``.

Long form keeps every step relational: counts are one hash aggregate, document frequency a
second one, TF-IDF a join. Terms are exact strings or hashed buckets:

* ``hashing=None``      exact terms; vocabulary grows with the data, so joins keyed by term
                        salt the heaviest terms over many reducers (``joins.salted_join``);
* ``hashing="murmur"``  ``pmod(hash(word), n)``: the reference's buckets, n = 2**18;
* ``hashing="md5"``     first hex digits of md5(word): portable to other SQL engines.

A hashed vocabulary has at most ``num_features`` rows, a proven bound, so it is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.functions.hashing import REFERENCE_NUM_FEATURES, md5_bucket, md5_num_features, murmur_bucket
from revlens.operators.joins import broadcast_if_bounded, salted_join
from revlens.session import ship_package

#: Words whose terms are counted at a time (one longer document is a step of its own), and rows
#: handed on at a time.
STEP_WORDS = 1_000_000
OUT_ROWS = 200_000


@dataclass(frozen=True)
class Hashing:
    """How words become feature ids; ``num_features`` is None for exact terms."""
    kind: str | None = None
    num_features: int | None = None

    def term(self, word: Column) -> Column:
        if self.kind is None:
            return word
        if self.kind == "murmur":
            return murmur_bucket(word, self.num_features or REFERENCE_NUM_FEATURES)
        if self.kind == "md5":
            return md5_bucket(word, self.hex_digits)
        raise ValueError(f"unknown hashing {self.kind!r}")

    @property
    def hex_digits(self) -> int:
        n = self.num_features or md5_num_features(4)
        digits = 0
        while 16 ** digits < n:
            digits += 1
        if 16 ** digits != n:
            raise ValueError("md5 hashing needs a power of 16 buckets")
        return digits

    @property
    def bound(self) -> int | None:
        if self.kind is None:
            return None
        if self.kind == "md5":
            return self.num_features or md5_num_features(4)
        return self.num_features or REFERENCE_NUM_FEATURES


EXACT = Hashing()
MURMUR = Hashing("murmur", REFERENCE_NUM_FEATURES)
MD5_16 = Hashing("md5", md5_num_features(4))
MD5_20 = Hashing("md5", md5_num_features(5))


def md5_buckets(words: pa.Array, hashing: Hashing) -> np.ndarray:
    """The md5 bucket of each word."""
    digits = hashing.hex_digits
    return np.fromiter((int(md5(w.as_buffer()).hexdigest()[:digits], 16) for w in words), np.int32, len(words))


def _counted(hashing: Hashing, names: list[str]):
    """Batches of (key, carried columns.., words or bucket numbers) to rows (key, carried.., term, tf)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            step = (np.cumsum(sizes) - sizes) // STEP_WORDS
            for k in np.unique(step).tolist():
                at, end = np.searchsorted(step, [k, k + 1]).tolist()
                words = lists.slice(at, end - at)
                row, words = words.value_parent_indices().to_numpy().astype(np.int64), words.flatten()
                if words.null_count:
                    known = pc.is_valid(words)
                    row, words = row[known.to_numpy(zero_copy_only=False)], words.filter(known)
                # a word is hashed once a step, however often it occurs
                coded = words.dictionary_encode()
                terms, term = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
                if hashing.kind == "md5" and len(terms):
                    kinds, back = np.unique(md5_buckets(terms, hashing), return_inverse=True)
                    terms, term = pa.array(kinds), back[term]
                pairs, tf = np.unique(row * max(len(terms), 1) + term, return_counts=True)
                row, term = np.divmod(pairs, max(len(terms), 1))
                for cut in range(0, len(pairs), OUT_ROWS):
                    part = slice(cut, cut + OUT_ROWS)
                    rows = pa.array(at + row[part])
                    yield pa.RecordBatch.from_arrays(
                        [*(c.take(rows) for c in batch.columns[:-1]), terms.take(pa.array(term[part])),
                         pa.array(tf[part].astype(np.int64))], names=names)

    return run


def term_counts(docs: DataFrame, key: str = "doc_id", words_col: str = "words",
                hashing: Hashing = EXACT, carry: list[str] | None = None) -> DataFrame:
    """``(key, [carry...], term, tf)``: how often each term occurs in each document.

    A document is one row, so its terms are counted where the row is: words of a step's documents
    become numbers, md5 is taken of each different word of a step, and equal pairs of document and
    term are counted by one sort of numbers. Nothing is shuffled. ``carry`` names columns to keep (a
    label, a split), so later steps filter on them instead of joining back by document. Rows that
    share a key are counted each; null words do not count.
    """
    columns = [key, *(carry or [])]
    ship_package(docs.sparkSession)
    terms = F.col(words_col)
    if hashing.kind not in (None, "md5"):
        terms = F.transform(F.filter(terms, lambda w: w.isNotNull()), hashing.term)
    rows = docs.select(*columns, terms.alias("_terms"))
    kind = T.IntegerType() if hashing.kind == "md5" else rows.schema["_terms"].dataType.elementType
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("term", kind), T.StructField("tf", T.LongType())])
    return rows.mapInArrow(_counted(hashing, schema.names), schema)


def idf(tc: DataFrame, docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(term, df, idf)`` with ``idf = ln((m + 1) / (df + 1))``, m = rows of ``docs``.

    ``tc`` holds each (document, term) once, so df is a plain count per term (partial
    aggregation absorbs frequent terms map-side). m is a scalar subquery (a one-row
    aggregate run once), so the plan stays lazy.
    """
    m = docs.agg(F.count(F.lit(1)).alias("_m")).scalar()
    df_t = tc.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return df_t.select("term", "df", F.log((m + 1) / (F.col("df") + 1)).alias("idf"))


def join_by_term(big: DataFrame, table: DataFrame, hashing: Hashing, weight: str | None = None,
                 how: str = "inner", key: str = "term", rows_per_term: int = 1) -> DataFrame:
    """Join ``big`` to a table keyed by term.

    Hashed terms bound the table (``num_features * rows_per_term`` rows): broadcast it.
    Exact terms have no bound: one shuffled join in which the heaviest terms by ``weight``
    (e.g. document frequency) are salted over many reducers, so a term present in a third
    of all documents does not land in one task.
    """
    bound = hashing.bound
    if bound is not None:
        return big.join(broadcast_if_bounded(table, bound * rows_per_term), key, how)
    if weight is None:
        return big.join(table, key, how)
    return salted_join(big, table, key, table.select(key, weight), weight, how)


def tfidf(tc: DataFrame, idf_table: DataFrame, hashing: Hashing = EXACT,
          key: str = "doc_id", fit_docs: DataFrame | None = None, n_docs: int | None = None) -> DataFrame:
    """``(key, term, tf, tfidf)`` with ``tfidf = tf * idf``.

    Hashed features cover every bucket, so a bucket the IDF fit never saw keeps the weight
    Spark ML gives it, ``ln(m + 1)`` (df = 0; ``fit_docs`` or ``n_docs`` supplies m). Exact terms outside
    the fitted vocabulary drop out, as they have no feature index.
    """
    if hashing.bound is not None and (fit_docs is not None or n_docs is not None):
        m = F.lit(n_docs) if n_docs is not None else fit_docs.agg(F.count(F.lit(1)).alias("_m")).scalar()
        j = join_by_term(tc, idf_table, hashing, weight="df", how="left")
        w = F.coalesce(F.col("idf"), F.log(m + F.lit(1.0)))
    else:
        j = join_by_term(tc, idf_table, hashing, weight="df")
        w = F.col("idf")
    extra = [c for c in tc.columns if c not in (key, "term", "tf")]
    return j.select(key, *extra, "term", "tf", (F.col("tf") * w).alias("tfidf"))
