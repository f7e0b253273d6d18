"""Dictionary segmentation of unsegmented text, given a lexicon table.

Two steps: which lexicon words stand where, then which of them are the tokens.

* Words: a lexicon of at most ``BROADCAST_WORDS`` rows is compiled once into a flat trie (sorted
  integer arrays), broadcast, and walked from all places of a batch of texts at the same time, one
  character deeper at each step; no row is shuffled. For a larger lexicon every place becomes a row
  with its window of ``max_len`` characters, windows meet the lexicon's prefixes, hits are widened
  to candidate words, and those meet the lexicon in a salted join; a text's words are then gathered.
* Tokens, the same for both: ``full`` takes every word (and, with ``uncovered``, the characters that
  none covers); ``max_match`` the longest word at each place from the left; ``mmseg`` the first word of the best three-word chunk; ``best_path`` the
  path of largest weight through all words; ``search`` adds to the ``max_match`` tokens every
  shorter lexicon word inside them. All take time in proportion to a text's length.

The lexicon is cleaned (no blanks, no repeats, ``min_len``..``max_len`` characters), written once
and counted; both ways give the same rows. ``lexicon_by_count`` makes a lexicon from a corpus,
``char_counts`` the character frequencies of MMSEG's fourth rule.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.functions.text import STOP_WORDS, cn_numerals_in_text, code_points, despace
from revlens.operators.features import Hashing, md5_buckets
from revlens.operators.joins import salted_join
from revlens.operators.metrics import word_counts
from revlens.session import materialize, ship_package, spread

# Segmenter settings of the reference -- longest word 7 characters, stop words
# kept, unknown characters kept as words, and these marks kept: @ # % . & +
MAX_LEN = 7
CLEAR_STOP_WORDS = False
KEEP_UNKNOWN = True
KEEP_MARKS = "@#%.&+"
MIN_LEN = 2
#: Most lexicon rows that are broadcast (a word and a few numbers each).
BROADCAST_WORDS = 500_000
#: Characters of the texts that one step of a task holds (one longer text is a step of its own),
#: and token rows handed on at a time.
STEP_CHARS = 1_000_000
OUT_ROWS = 200_000
#: Characters of a step whose tokens are only counted: in full mode a character has several.
COUNT_CHARS = 250_000
#: Most cells of a trie's table of steps (4 bytes each), and code points that are looked up in a table.
TABLE_STEPS = 1 << 23
LOW_CHARS = 1 << 16
#: Logarithms of counts are compared as whole numbers of this part of one, so that sums are exact.
LOG_SCALE = 1_000_000


@dataclass(frozen=True)
class Settings:
    """Segmenter settings, taken by every mode.

    ``keep_unknown``: a character that starts no dictionary word is a token of its own; without it
    only characters in ``keep_marks`` are. In ``full`` mode that holds for the characters that no
    dictionary word covers, if ``uncovered`` asks for them. ``clear_stop_words`` drops the tokens in ``STOP_WORDS``. ``numerals`` writes
    Chinese numerals in the text as Arabic ones first (``cn_numerals_in_text``); positions are then
    those of the text so written.
    """

    max_len: int = MAX_LEN
    min_len: int = MIN_LEN
    keep_unknown: bool = KEEP_UNKNOWN
    clear_stop_words: bool = CLEAR_STOP_WORDS
    keep_marks: str = KEEP_MARKS
    numerals: bool = False
    uncovered: bool = False


def lexicon_by_count(docs: DataFrame, min_count: int, words_col: str = "words",
                     min_len: int = MIN_LEN, max_len: int = MAX_LEN) -> DataFrame:
    """``(word, n)``: all words of min_len..max_len characters that occur at least ``min_count`` times."""
    return word_counts(docs, words_col).filter(
        F.length("word").between(min_len, max_len) & (F.col("n") >= min_count))


def char_counts(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """``(char, n)``: how often each character stands in the texts (at most one row for each code
    point there is, so the table may always be broadcast)."""
    return texts.select(F.explode(code_points(text_col)).alias("char")).groupBy("char").agg(F.count("*").alias("n"))


def unsegmented(texts: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(key, text)`` lower-cased with blanks removed: a stand-in for unsegmented writing."""
    return texts.select(key, despace(text_col).alias("text"))


class Lexicon:
    """A cleaned lexicon, written once: ``words (word, n)`` and whether it may be broadcast."""

    def __init__(self, lexicon: DataFrame, settings: Settings):
        weight = F.col("n").cast("long") if "n" in lexicon.columns else F.lit(0).cast("long")
        words = (lexicon.select("word", weight.alias("n"))
                 .filter((F.trim("word") != "") & F.length("word").between(settings.min_len, settings.max_len))
                 .groupBy("word").agg(F.max("n").alias("n")))
        self.words = materialize(words, "lexicon")
        self.small = self.words.count() <= BROADCAST_WORDS

    def join(self, candidates: DataFrame) -> DataFrame:
        """The candidate rows whose ``word`` is in the lexicon, with its count ``n``."""
        return salted_join(candidates, self.words, "word", self.words, "n")

    def prefixes(self, size: int) -> DataFrame:
        """``(prefix, sizes)``: word lengths behind each prefix of ``size`` characters."""
        return self.words.groupBy(F.substring("word", 1, size).alias("prefix")).agg(
            F.collect_set(F.length("word")).alias("sizes"))


def _hits(texts: DataFrame, lexicon: Lexicon, s: Settings, key: str, text_col: str) -> DataFrame:
    """``(key, pos, word, n)``: every lexicon word at every position (0-based code points)."""
    # one match per code point, line breaks included; the look-ahead takes the window after it
    windows = F.regexp_extract_all(F.col(text_col), F.lit(f"(?s)(?=(.{{1,{s.max_len}}}))."), 1)
    rows = texts.select(key, F.posexplode_outer(windows).alias("pos", "_window")).filter(F.col("_window").isNotNull())
    rows = rows.withColumn("prefix", F.substring("_window", 1, s.min_len)).join(
        lexicon.prefixes(s.min_len), "prefix")
    rows = rows.withColumn("_k", F.explode("sizes")).filter(F.col("_k") <= F.length("_window"))
    return lexicon.join(rows.select(key, "pos", F.expr("substring(_window, 1, _k)").alias("word")))


# -- the trie -------------------------------------------------------------------------------

class Trie:
    """The lexicon as sorted arrays. A state is a prefix; ``keys`` holds state * letters + letter of
    every step from one state to another, ``to`` where it leads, ``word`` a state's word or -1."""

    def __init__(self, words: list[str], weights: np.ndarray):
        chars = [np.frombuffer(w.encode("utf-32-le"), np.uint32) for w in words]
        sizes = np.array([len(c) for c in chars], np.int64)
        self.longest = int(sizes.max(initial=0))
        self.letters, flat = np.unique(np.concatenate([*chars, np.zeros(0, np.uint32)]), return_inverse=True)
        table = np.full((len(words), self.longest), -1, np.int64)
        table[np.arange(self.longest)[None, :] < sizes[:, None]] = flat
        order = np.lexsort(table.T[::-1]) if self.longest else np.zeros(0, np.int64)
        table, sizes = table[order], sizes[order]
        self.words = pa.array([words[i] for i in order], pa.string())
        self.weights = weights[order]
        state, known = np.zeros(len(words), np.int64), 1
        new = np.zeros(len(words), bool)
        new[:1] = True
        keys, to, ends = [], [], []
        for k in range(self.longest):
            new[1:] |= table[1:, k] != table[:-1, k]
            alive = sizes > k
            first = new & alive
            keys.append(state[first] * len(self.letters) + table[first, k])
            number = known - 1 + np.cumsum(first)
            to.append(number[first])
            state = np.where(alive, number, state)
            known += int(first.sum())
            done = np.flatnonzero(sizes == k + 1)
            ends.append((state[done], done))
        self.word = np.full(known, -1, np.int64)
        for at, which in ends:
            self.word[at] = which
        self.keys = np.concatenate([*keys, np.zeros(0, np.int64)])
        by_key = np.argsort(self.keys)
        self.keys, self.to = self.keys[by_key], np.concatenate([*to, np.zeros(0, np.int64)])[by_key]
        self.word = self.word.astype(np.int32)
        #: The steps as a table (state, letter), with a column of its own for no letter, if it is small.
        self.table = None
        if known * (len(self.letters) + 1) <= TABLE_STEPS:
            self.table = np.full((known, len(self.letters) + 1), -1, np.int32)
            if len(self.letters):
                self.table[np.divmod(self.keys, len(self.letters))] = self.to
        #: The letters' numbers by code point, below the first one of no use.
        self.low = np.full(min(int(self.letters[-1]) + 1, LOW_CHARS) if len(self.letters) else 0, -1, np.int32)
        low = self.letters[self.letters < len(self.low)]
        self.low[low] = np.arange(len(low))

    def _letters(self, chars: np.ndarray) -> np.ndarray:
        """The number of each character among the letters, or -1."""
        out = np.full(len(chars), -1, np.int32)
        low = np.flatnonzero(chars < len(self.low))
        out[low] = self.low[chars[low]]
        if len(self.letters) and self.letters[-1] >= len(self.low):
            high = np.flatnonzero(chars >= len(self.low))
            i = np.minimum(np.searchsorted(self.letters, chars[high]), len(self.letters) - 1)
            out[high] = np.where(self.letters[i] == chars[high], i, -1)
        return out

    def find(self, chars: np.ndarray, ends: np.ndarray, by_place: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, size, word) of every lexicon word in ``chars``, by place, then size; or, if not
        ``by_place``, by size. ``ends`` gives for each place where its text ends."""
        none = np.zeros(0, np.int64)
        if not len(self.keys) or not len(chars):
            return none, none, none
        letter = self._letters(chars)
        # a place without a letter leads nowhere, as does any place behind the end of its text
        left = (ends - np.arange(len(chars))).astype(np.int32)
        at, state, found = np.flatnonzero(letter >= 0).astype(np.int32), None, []
        for k in range(self.longest):
            if k:
                inside = np.flatnonzero(left[at] > k)
                at, state = at[inside], state[inside]
            state = self._follow(state, letter[at + k])
            good = np.flatnonzero(state >= 0)
            at, state = at[good], state[good]
            word = self.word[state]
            hit = np.flatnonzero(word >= 0)
            found.append((at[hit], np.full(len(hit), k + 1, np.int32), word[hit]))
        place, size, word = (np.concatenate(c) for c in zip(*found))
        if not by_place:
            return place, size, word
        order = np.argsort(place, kind="stable")
        return tuple(c[order].astype(np.int64) for c in (place, size, word))

    def _follow(self, state: np.ndarray | None, letter: np.ndarray) -> np.ndarray:
        """The states behind the steps by ``letter`` (-1: none) from ``state`` (None: the root), or -1."""
        if self.table is not None:
            row = letter if state is None else state * np.int32(self.table.shape[1]) + letter
            return self.table.ravel()[row]  # letter -1 is the column before: the last one of a row, always -1
        key = letter.astype(np.int64) if state is None else state * np.int64(len(self.letters)) + letter
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[i] == key) & (letter >= 0), self.to[i], -1).astype(np.int32)


# -- from words to tokens -------------------------------------------------------------------

@dataclass
class _Texts:
    """A step's texts, one after the other, and the lexicon words in them."""

    chars: np.ndarray       # code points
    begins: np.ndarray      # first place of each text, and the end of the last one
    place: np.ndarray       # of every lexicon word: place, size, number; by place, then size
    size: np.ndarray
    word: np.ndarray
    words: pa.Array
    weights: np.ndarray     # of each word: its count

    @property
    def ends(self) -> np.ndarray:
        return np.repeat(self.begins[1:], np.diff(self.begins))

    def sizes(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size, places, word numbers) of the words of each size."""
        for k in np.unique(self.size).tolist():
            pick = self.size == k
            yield k, self.place[pick], self.word[pick]


def _longest(t: _Texts) -> np.ndarray:
    """The size of the longest word at each place, 1 where there is none."""
    out = np.ones(len(t.chars), np.int64)
    for k, place, _ in t.sizes():
        out[place] = k
    return out


def _chunks(t: _Texts, free: np.ndarray) -> np.ndarray:
    """The size of the first word of the best chunk of three words from each place. Given the first
    two words the third is the longest there, and given the first the other two are the best pair,
    so two rounds over the word sizes find it. ``free``: weight of each place's character."""
    n, ends = len(t.chars), t.ends
    least = np.iinfo(np.int64).min
    last = np.zeros(n + 1, np.int64)
    last[:n] = _longest(t)
    # rules 1 to 3 as one number: larger total, fewer words, smaller sum of squares; rule 4 beside it
    score, tie = np.where(last > 0, (4 * last - 1 << 20) - last * last, 0), np.where(last == 1, np.append(free, 0), 0)
    # only words of one character may start where no lexicon word does
    options = [(1, np.arange(n)), *((k, place) for k, place, _ in t.sizes() if k > 1)]
    for _ in range(2):
        best, best_tie, first = np.full(n + 1, least), np.zeros(n + 1, np.int64), np.ones(n + 1, np.int64)
        for k, place in options:
            after = place + k
            over = after >= ends[place]  # the text is over: no further word
            total = (4 * k - 1 << 20) - k * k + np.where(over, 0, score[np.minimum(after, n)])
            beside = np.where(over, 0, tie[np.minimum(after, n)]) + (free[place] if k == 1 else 0)
            better = (total > best[place]) | (total == best[place]) & (beside >= best_tie[place])
            at = place[better]
            best[at], best_tie[at], first[at] = total[better], beside[better], k
        best[n] = 0
        score, tie = best, best_tie
    # a place where no word of two or more characters starts is not weighed
    return np.where(last[:n] > 1, first[:n], 1)


def _path(t: _Texts, total: int) -> np.ndarray:
    """The size of the first word of the heaviest path from each place to its text's end: words
    weigh the logarithm of their share of ``total``, other characters that of a count of 1; of
    equal paths the one with the longer first word."""
    one = -_log(max(total, 1))
    n = len(t.chars)
    heads = np.searchsorted(t.place, np.arange(n + 1)).tolist()
    sizes, known = t.size.tolist(), (np.array([_log(max(int(x), 1)) for x in t.weights], np.int64)[t.word] + one).tolist()
    first = [1] * n
    # every text has one place more than characters: behind its end, worth nothing
    value = [0] * (n + len(t.begins))
    begins = t.begins.tolist()
    i = len(sizes) - 1
    for text in range(len(begins) - 2, -1, -1):
        for p in range(begins[text + 1] - 1, begins[text] - 1, -1):
            at = p + text
            best, size = one + value[at + 1], 1
            low = heads[p]
            while i >= low:  # longest word first; a word of one character weighs no less than none
                k = sizes[i]
                here = known[i] + value[at + k]
                if here > best or here == best and k > size:
                    best, size = here, k
                i -= 1
            value[at], first[p] = best, size
    return np.array(first, np.int64)


def _log(count: int) -> int:
    return math.floor(LOG_SCALE * math.log(count))


def _walk(size: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The places where tokens start, from the first size at each place."""
    out, sizes = [], size.tolist()
    for at, end in zip(begins[:-1].tolist(), begins[1:].tolist()):
        while at < end:
            out.append(at)
            at += sizes[at]
    return np.array(out, np.int64)


def _with_uncovered(t: _Texts, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, size, word number or -1) of all words and of the characters kept that no word covers, by place."""
    n = len(t.chars)
    words_over = np.cumsum(np.bincount(t.place, minlength=n + 1) - np.bincount(t.place + t.size, minlength=n + 1))
    free = np.flatnonzero(words_over[:n] == 0)
    if not s.keep_unknown:
        free = free[np.isin(t.chars[free], [ord(c) for c in s.keep_marks])]
    place = np.concatenate([t.place, free])
    order = np.argsort(place, kind="stable")
    size = np.concatenate([t.size, np.ones(len(free), np.int64)])[order]
    return place[order], size, np.concatenate([t.word, np.full(len(free), -1)])[order]


def _tokens(t: _Texts, mode: str, s: Settings, free: dict[str, int], total: int) -> tuple[np.ndarray, ...]:
    """(text, idx, off, place, size, word number or -1) of every token. In ``full`` mode idx is the
    place in the text."""
    owner = np.repeat(np.arange(len(t.begins) - 1), np.diff(t.begins))
    if mode == "full":
        place, size, word = _with_uncovered(t, s) if s.uncovered else (t.place, t.size, t.word)
        who = owner[place]
        return who, place - t.begins[who], np.zeros(len(who), np.int64), place, size, word
    if mode == "mmseg":
        letters, back = np.unique(t.chars, return_inverse=True)
        size = _chunks(t, np.array([free.get(chr(c), 0) for c in letters.tolist()], np.int64)[back])
    else:
        size = _path(t, total) if mode == "best_path" else _longest(t)
    start = _walk(size, t.begins)
    size = size[start]
    wide = int(t.size.max(initial=0)) + 1
    keys = t.place * wide + t.size
    i = np.minimum(np.searchsorted(keys, start * wide + size), max(len(keys) - 1, 0))
    word = np.where(keys[i] == start * wide + size, t.word[i], -1) if len(keys) else np.full(len(start), -1)
    if not s.keep_unknown:
        kept = (word >= 0) | np.isin(t.chars[start], [ord(c) for c in s.keep_marks])
        start, size, word = start[kept], size[kept], word[kept]
    who = owner[start]
    first = np.searchsorted(who, np.arange(len(t.begins) - 1))
    idx = np.arange(len(who)) - first[who]
    if mode != "search":
        return who, idx, np.zeros(len(who), np.int64), start, size, word
    # the shorter words inside the tokens
    i = np.searchsorted(start, t.place, side="right") - 1
    inner = (i >= 0) & (t.place + t.size <= start[i] + size[i]) & (t.size < size[i]) if len(start) else np.zeros(0, bool)
    i, place = i[inner], t.place[inner]
    parts = [(who, who[i]), (idx, idx[i]), (np.zeros(len(who), np.int64), place - start[i]), (start, place),
             (size, t.size[inner]), (word, t.word[inner])]
    return tuple(np.concatenate(x) for x in parts)


def _spelled(t: _Texts, place: np.ndarray, word: np.ndarray) -> pa.Array:
    """The tokens' text: lexicon words by number, others as the character at their place."""
    other = word < 0
    letters, back = np.unique(t.chars[place[other]], return_inverse=True)
    single = pa.array([chr(c) for c in letters.tolist()], pa.string()).take(pa.array(back))
    where = np.empty(len(word), np.int64)
    where[~other] = np.arange(int((~other).sum()))
    where[other] = np.arange(int((~other).sum()), len(word))
    return pa.concat_arrays([t.words.take(pa.array(word[~other])), single]).take(pa.array(where))


def _steps(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows (key, text, ..) of about ``size`` characters, with the texts' code points
    and where each text begins. Null texts are empty."""
    for batch in batches:
        sizes = np.fromiter((len(x) if x else 0 for x in batch.column(1).to_pylist()), np.int64, batch.num_rows)
        step = np.cumsum(sizes) // size
        for k in np.unique(step).tolist():
            at, end = np.searchsorted(step, [k, k + 1]).tolist()
            rows = batch.slice(at, end - at)
            whole = "".join(x for x in rows.column(1).to_pylist() if x)
            yield rows, np.frombuffer(whole.encode("utf-32-le"), np.uint32), np.concatenate([[0], np.cumsum(sizes[at:end])])


def _buckets(words: pa.Array, hashing: Hashing, s: Settings) -> np.ndarray:
    """The bucket of each word, -1 for stop words if they are dropped."""
    out = md5_buckets(words, hashing)
    if s.clear_stop_words:
        out[pc.is_in(words, value_set=pa.array(STOP_WORDS)).to_numpy(zero_copy_only=False)] = -1
    return out


def _segmenter(mode: str, s: Settings, trie, total: int, free: dict[str, int], lists: bool, names: list[str],
               hashing: Hashing | None = None, buckets=None):
    """Batches of (key, text) or, without a trie, (key, text, words found) to token rows, to one row
    a text with the list of its tokens, or, with ``hashing``, to rows (key, further columns.., term, tf);
    ``buckets``: those of the trie's words."""
    def counts(rows: pa.RecordBatch, t: _Texts, who: np.ndarray, place: np.ndarray, word: np.ndarray) -> Iterator[pa.RecordBatch]:
        known = buckets.value if buckets is not None else _buckets(t.words, hashing, s)
        other = np.flatnonzero(word < 0)
        term = known[word] if len(known) else np.full(len(word), -1, np.int32)
        if len(other):
            letters, back = np.unique(t.chars[place[other]], return_inverse=True)
            term[other] = _buckets(pa.array([chr(c) for c in letters.tolist()], pa.string()), hashing, s)[back]
        kept = term >= 0
        if not kept.all():
            who, term = who[kept], term[kept]
        pairs, tf = np.unique(who.astype(np.int64) * hashing.bound + term, return_counts=True)
        row, term = np.divmod(pairs, hashing.bound)
        handed = [rows.column(0), *rows.columns[len(rows.columns) - (len(names) - 3):]]
        for at in range(0, len(pairs), OUT_ROWS):
            part = slice(at, at + OUT_ROWS)
            of = pa.array(row[part])
            yield pa.RecordBatch.from_arrays([*(c.take(of) for c in handed), pa.array(term[part].astype(np.int32)),
                                              pa.array(tf[part].astype(np.int64))], names=names)

    def given(rows: pa.RecordBatch, begins: np.ndarray) -> tuple:
        found = rows.column(2)
        edges = found.offsets.to_numpy()
        who = np.repeat(np.arange(rows.num_rows), np.diff(edges))
        hits = found.values.slice(int(edges[0]), int(edges[-1] - edges[0]))
        place, size, n = (hits.field(c).to_numpy().astype(np.int64) for c in ("pos", "size", "n"))
        coded = hits.field("word").dictionary_encode()
        word = coded.indices.to_numpy().astype(np.int64)
        order = np.lexsort((size, place + begins[who]))
        counts = np.zeros(len(coded.dictionary), np.int64)
        counts[word] = n
        return (place + begins[who])[order], size[order], word[order], coded.dictionary, counts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = trie.value if trie is not None else None
        for rows, chars, begins in _steps(batches, STEP_CHARS if hashing is None else COUNT_CHARS):
            if known is None:
                t = _Texts(chars, begins, *given(rows, begins))
            else:
                ends = np.repeat(begins[1:], np.diff(begins))
                # only the order of the full mode's tokens is of no use to their counts
                found = known.find(chars, ends, by_place=hashing is None or mode != "full")
                t = _Texts(chars, begins, *found, known.words, known.weights)
            who, idx, off, place, _, word = _tokens(t, mode, s, free, total)
            if hashing is not None:
                yield from counts(rows, t, who, place, word)
                continue
            if lists:
                order = np.argsort(who, kind="stable")
                edges = np.searchsorted(who[order], np.arange(rows.num_rows + 1))
                text = _spelled(t, place[order], word[order])
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), text)], names=names)
                continue
            for at in range(0, len(who), OUT_ROWS):
                part = slice(at, at + OUT_ROWS)
                out = {"idx": idx, "pos": idx, "off": off}
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(pa.array(who[part])), *(pa.array(out[c][part], pa.int32()) for c in names[1:-1]),
                     _spelled(t, place[part], word[part])], names=names)

    return run


def _given_words(texts: DataFrame, lexicon: Lexicon, s: Settings, key: str, text_col: str,
                 carry: tuple[str, ...]) -> DataFrame:
    """``(key, text, found, carry..)``: each text with the lexicon words in it, found by joins. Texts are
    numbered first, so that texts of one key stay apart."""
    rows = materialize(texts.select(F.monotonically_increasing_id().alias("_row"), key, text_col, *carry), "texts")
    hits = _hits(rows, lexicon, s, "_row", text_col)
    found = hits.groupBy("_row").agg(F.collect_list(F.struct("pos", F.length("word").alias("size"), "n", "word")).alias("found"))
    none = F.array().cast("array<struct<pos:int,size:int,n:bigint,word:string>>")
    return rows.join(found, "_row", "left").select(key, text_col, F.coalesce("found", none).alias("found"), *carry)


MODES = {"full": ["pos"], "max_match": ["idx"], "mmseg": ["idx"], "best_path": ["idx"], "search": ["idx", "off"]}


def _segmented(texts: DataFrame, lexicon: DataFrame, mode: str, key: str, text_col: str, lists: bool,
               chars: DataFrame | None, s: Settings, hashing: Hashing | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    words, spark = Lexicon(lexicon, s), texts.sparkSession
    ship_package(spark)
    if s.numerals:
        texts = texts.withColumn(text_col, cn_numerals_in_text(text_col))
    free = {r["char"]: _log(r["n"]) for r in chars.collect()} if chars is not None else {}
    total = (words.words.agg(F.sum("n")).first()[0] or 0) if mode == "best_path" else 0
    trie = buckets = None
    if words.small:
        rows = words.words.toArrow()
        known = Trie(rows.column("word").to_pylist(), rows.column("n").to_numpy())
        trie = spark.sparkContext.broadcast(known)
        if hashing is not None:
            buckets = spark.sparkContext.broadcast(_buckets(known.words, hashing, s))
        texts = spread(texts.select(key, text_col, *carry))
    else:
        texts = _given_words(texts, words, s, key, text_col, carry)
    if hashing is not None:
        columns = [*(texts.schema[c] for c in carry), T.StructField("term", T.IntegerType()), T.StructField("tf", T.LongType())]
    elif lists:
        columns = [T.StructField("words", T.ArrayType(T.StringType()))]
    else:
        columns = [*(T.StructField(c, T.IntegerType()) for c in MODES[mode]), T.StructField("word", T.StringType())]
    schema = T.StructType([texts.schema[key], *columns])
    return texts.mapInArrow(_segmenter(mode, s, trie, total, free, lists, schema.names, hashing, buckets), schema)


def _without_stop_words(tokens: DataFrame, s: Settings) -> DataFrame:
    return tokens.filter(~F.col("word").isin(STOP_WORDS)) if s.clear_stop_words else tokens


def segment(texts: DataFrame, lexicon: DataFrame, mode: str = "max_match", key: str = "doc_id",
            text_col: str = "text", chars: DataFrame | None = None, **settings) -> DataFrame:
    """Segment ``texts`` by ``mode`` (full, max_match, mmseg, best_path, search) under ``Settings``.

    ``full``: (key, pos, word), every lexicon word at every position; with ``uncovered`` also every
    character that no lexicon word covers. ``max_match``, ``mmseg``, ``best_path``: (key, idx, word). ``search``: (key, idx, off, word), each token (off 0) and every
    shorter lexicon word inside it (off: where it starts in the token).

    ``mmseg`` is MMSEG (C.-H. Tsai, 1996): chunks of three words (lexicon words or single
    characters) by total length, then fewer words (a larger mean), then the smaller sum of squared
    lengths (at equal total and number, the smaller variance), then, if ``chars`` (char, n) is
    given, the larger sum of the log counts of its one-character words; ties keep the longest first
    word. ``best_path`` takes the path whose words have the largest product of shares of the
    lexicon's counts ``n``, characters outside the lexicon counting once.

    Positions count code points, so line breaks and characters beyond the first plane count
    one. Null and empty texts have no tokens; blank and repeated lexicon rows count once or not
    at all, an empty lexicon leaves single characters (nothing in ``full`` without ``uncovered``). Every row is a text of
    its own; ``key`` is handed on.
    """
    s = Settings(**settings)
    return _without_stop_words(_segmented(texts, lexicon, mode, key, text_col, False, chars, s), s)


def segment_lists(texts: DataFrame, lexicon: DataFrame, mode: str = "max_match", key: str = "doc_id",
                  text_col: str = "text", chars: DataFrame | None = None, **settings) -> DataFrame:
    """``(key, words)``: the tokens of ``segment`` as one list a text, which needs no shuffle. Texts
    without tokens have an empty list."""
    s = Settings(**settings)
    out = _segmented(texts, lexicon, mode, key, text_col, True, chars, s)
    if s.clear_stop_words:
        out = out.withColumn("words", F.filter("words", lambda w: ~w.isin(STOP_WORDS)))
    return out


def segment_counts(texts: DataFrame, lexicon: DataFrame, hashing: Hashing, mode: str = "max_match", key: str = "doc_id",
                   text_col: str = "text", chars: DataFrame | None = None, carry: list[str] | None = None,
                   **settings) -> DataFrame:
    """``(key, [carry...], term, tf)``: ``features.term_counts`` of the tokens of ``segment_lists``, for md5
    buckets. A text's tokens are counted where it is segmented, as numbers: a lexicon word is hashed
    once, not once a token, and no token leaves its task as text. Texts without tokens have no rows."""
    if hashing.kind != "md5":
        raise ValueError(f"tokens are counted in md5 buckets only, not {hashing.kind!r}")
    return _segmented(texts, lexicon, mode, key, text_col, False, chars, Settings(**settings), hashing, tuple(carry or ()))


def words_per_document(tokens: DataFrame, key: str = "doc_id", order: str = "idx") -> DataFrame:
    """Tokens back to one word array per document, in token order (``order``: a column)."""
    return (tokens.groupBy(key)
            .agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), F.col("word")))).alias("_a"))
            .select(key, F.col("_a.word").alias("words")))
