"""Language identification: known words first, then ever shorter character n-grams.

Fitting counts words and their character n-grams by language with Spark aggregations over a
bounded sample of labelled documents (``SAMPLE_DOCS`` a language, picked by a hash of the id, so
the same rows at every run; all of their text) and keeps the commonest entries a language
(``MAX_WORDS``, ``MAX_NGRAMS`` of each length; rarer words are scored by their n-grams): the model's size is bounded by these parameters and the number of languages.
Scoring reads every word of every text. A word that the model knows adds its log frequency in
each language; one that it does not know adds the mean log frequency of its longest n-grams
that are known, from ``MAX_N`` characters down to one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import drop_scratch, let, slices, worker_state, write_scratch

#: Documents a language in the fitting sample (about; a hash picks them).
SAMPLE_DOCS = 2000
#: Commonest words, and n-grams of each length, kept a language.
MAX_WORDS = 20_000
MAX_NGRAMS = 5_000
MAX_N = 4
#: Added to every count.
SMOOTHING = 0.5
#: Words whose scores one Python worker keeps.
CACHE_ENTRIES = 200_000
#: Longer words are read n-gram by n-gram without being kept.
CACHE_CHARS = 64
#: Longer runs of letters are no entries of the word table; their n-grams count like all others.
FIT_CHARS = 64

UNDETERMINED = "und"
_WORD = re.compile(r"[^\W\d_]+")


def _words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def has_letter(words: list[str]) -> bool:
    return any(c.isalpha() for w in words for c in w)


def with_letters(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows whose text has a letter, by the rule that a fitted model calls others ``und``."""
    text_at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array([has_letter(_words(t)) for t in batch.column(text_at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


@dataclass
class LanguageModel:
    """Log frequencies by language: ``words`` and ``grams[n]`` give the row of ``table`` of a key."""

    languages: list[str]
    prior: np.ndarray
    words: dict[str, int]
    grams: dict[int, dict[str, int]]
    table: np.ndarray
    _index: dict[str, int] = field(default_factory=dict, repr=False)
    _rows: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_index": {}, "_rows": None}

    def word_scores(self, word: str) -> np.ndarray | None:
        """Log scores of one word; None if not even a character of it is known."""
        known = self.words.get(word)
        if known is not None:
            return self.table[known]
        padded = f"^{word}$"
        for n in range(MAX_N, 0, -1):
            text = padded if n > 1 else word
            get = self.grams.get(n, {}).get
            rows = [r for i in range(len(text) - n + 1) if (r := get(text[i:i + n])) is not None]
            if rows:
                return self.table[rows].mean(axis=0)
        return None

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, posterior); ``und`` with 0.0 for null, letterless texts or an empty model."""
        words = _words(text)
        if not has_letter(words) or not self.languages:
            return UNDETERMINED, 0.0
        counts = Counter(words)
        total = self.prior.copy()
        at = [self._index.get(w, -1) for w in counts]
        if -1 in at:
            for k, w in enumerate(counts):
                if at[k] < 0:
                    row = self.word_scores(w)
                    if len(self._index) < CACHE_ENTRIES and len(w) <= CACHE_CHARS:
                        at[k] = self._index[w] = len(self._index)
                        if self._rows is None:
                            self._rows = np.zeros((CACHE_ENTRIES, len(total)))
                        self._rows[at[k]] = 0.0 if row is None else row
                    elif row is not None:
                        total = total + counts[w] * row
        n = np.fromiter(counts.values(), np.float64, len(counts))
        at = np.array(at)
        if self._rows is not None:
            total = total + n[at >= 0] @ self._rows[at[at >= 0]]
        best = int(np.argmax(total))
        return self.languages[best], float(1 / np.exp(total - total[best]).sum())


def fitting_rows(docs: DataFrame) -> DataFrame:
    """The rows that may be learned from: a language, and crc32 of the id not 1 modulo 3."""
    return docs.where(F.col("lang").isNotNull() & ~held_out())


def held_out():
    """True for rows kept out of fitting; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def fit(rows: DataFrame, sample_docs: int = SAMPLE_DOCS, max_words: int = MAX_WORDS,
        max_ngrams: int = MAX_NGRAMS) -> LanguageModel:
    """Fit on labelled rows (doc_id, text, lang). Null languages and texts are passed over;
    no rows give an empty model, which calls every text ``und``."""
    rows = rows.where(F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    share = F.least(F.lit(1.0), F.lit(float(sample_docs)) / F.col("n"))
    picked = rows.join(F.broadcast(sizes.select("lang", share.alias("share"))), "lang").where(
        F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < F.col("share") * (1 << 30))
    words = picked.select("lang", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("key")).where(
        "key <> ''").groupBy("lang", "key").agg(F.count("*").alias("n"))
    words = write_scratch(words, "words")
    edged = F.concat(F.array(F.lit("^")), F.filter(F.split("key", ""), lambda c: c != ""), F.array(F.lit("$")))
    grams = words.select("lang", "n", F.explode(let(edged, _ngrams)).alias("key"))
    grams = grams.groupBy("lang", "key").agg(F.sum("n").alias("n")).withColumn("size", F.length("key"))
    table = words.where(F.length("key") <= FIT_CHARS).withColumn("size", F.lit(0)).select("lang", "size", "key", "n").unionByName(
        grams.select("lang", "size", "key", "n"))
    ranked = table.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "size").orderBy(F.desc("n"), "key"))).where(
        F.col("rank") <= F.when(F.col("size") == 0, max_words).otherwise(max_ngrams)).drop("rank").toArrow()
    drop_scratch(words)
    docs = {r["lang"]: r["n"] for r in sizes.collect()}
    return _model(docs, ranked)


def _ngrams(chars: Column) -> Column:
    """The n-grams of 1..``MAX_N`` characters of a word (an array of its characters between two
    border marks), every one as often as it stands there; a border alone is none."""
    def of(k: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(chars) - (k - 1), F.lit(1)))
        whole = F.transform(starts, lambda i: F.array_join(F.slice(chars, i, k), ""))
        return F.when(F.size(chars) >= k, whole).otherwise(F.array().cast("array<string>"))

    return F.concat(F.slice(chars, F.lit(2), F.size(chars) - 2), *(of(k) for k in range(2, MAX_N + 1)))


def _model(docs: dict[str, int], counts: pa.Table) -> LanguageModel:
    """Smoothed log frequencies from the counted entries (lang, size, key, n); size 0: words."""
    languages = sorted(docs)
    at = {lang: i for i, lang in enumerate(languages)}
    places: dict[int, dict[str, int]] = {}
    keys = counts.select(["size", "key"]).to_pydict()
    rows = []
    for size, key in zip(keys["size"], keys["key"]):
        known = places.setdefault(size, {})
        rows.append(known.setdefault(key, len(known)))
    sizes, rows = np.array(keys["size"], np.int64), np.array(rows, np.int64)
    lang = np.array([at[x] for x in counts.column("lang").to_pylist()], np.int64)
    tables, start, total = [], {}, 0
    for size, known in places.items():
        mine = sizes == size
        table = np.full((len(known), len(languages)), SMOOTHING)
        np.add.at(table, (rows[mine], lang[mine]), counts.column("n").to_numpy()[mine])
        tables.append(np.log(table / table.sum(axis=0)))
        start[size] = total
        total += len(known)
    placed = {size: {k: v + start[size] for k, v in known.items()} for size, known in places.items()}
    seen = np.array([docs[x] for x in languages], float)
    prior = np.log(seen / seen.sum()) if languages else np.zeros(0)
    return LanguageModel(languages, prior, placed.pop(0, {}), placed,
                         np.concatenate(tables) if tables else np.zeros((0, len(languages))))


PREDICTED = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1) by ``model``; all rows and columns stay.

    Null text and text without a letter: ``und``, 0.0. Ties go to the first language by name.
    Columns called lang_pred or score are replaced.
    """
    kept = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*kept.schema.fields, *PREDICTED.fields])
    text_at = kept.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = worker_state(("language", id(shared.value)), lambda: shared.value).predict
        for batch in slices(batches):
            found = [predict(t) for t in batch.column(text_at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])

    return kept.mapInArrow(run, schema)


def predictions(docs: DataFrame) -> DataFrame:
    """Fit on the rows that are not held out and predict all: doc_id, held_out, lang_pred, score."""
    model = fit(fitting_rows(docs))
    return identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model).select(
        "doc_id", "held_out", "lang_pred", "score")


