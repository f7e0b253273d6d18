"""Ranked lexical search by Block-Max MaxScore over shards of an inverted index.

Building. One pass counts documents and terms (``Statistics``); a second one lays every
partition's documents out in shards of at most ``SHARD_POSTINGS`` postings (a longer document
makes a larger shard). Documents of a shard stand in doc_id order; a term's postings (document,
occurrences) are cut in blocks of ``BLOCK``, kept as gaps and counts of the smallest width that
holds the list, beside each block's first document and largest impact. Shards are rows of a
parquet table: the dictionary in one column, the lists in others, so that document frequencies
are read without the lists.

Searching. Queries go to the shards in blocks of bounded size. In a shard a query's lists are
ordered by bound (weight times largest impact). The first lists are essential: they are scored
whole until a document that lies in none of them cannot reach the k-th best score any more. The
rest only add to documents found already: a document whose score, the maximum of the block that
would hold it and the bounds of the lists after it stay below the k-th best is rejected, and
blocks that no document is left in are never unpacked. A task's shards hand their k-th best score
on; the heaps of all shards merge to the result.

The score is exact: weights and impacts are integers, bounds are sums of integers.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import drop_scratch, slices, write_scratch

#: Postings after which a shard is closed, and postings in a block of a list.
SHARD_POSTINGS = 2_000_000
BLOCK = 128
#: A block of queries holds about this many rows and bytes of text.
QUERY_ROWS = 4_000
QUERY_BYTES = 16_000_000
#: Shards whose heaps one task merges first.
MERGED_SHARDS = 64

#: Byte -> byte: A-Z in lower case, letters, digits and what lies beyond ASCII as they are, all
#: else blank.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
                    for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order, as UTF-8: runs of ASCII letters, ASCII digits and all
    characters beyond ASCII, with A-Z in lower case. None has none."""
    return (text or "").encode().translate(_WORD_BYTES).split()


@dataclass(frozen=True)
class Statistics:
    """Documents with at least one term, and terms of all documents."""

    docs: int
    terms: int

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.docs + 2) / (2 * df + 1)))

    def lengths(self, n: np.ndarray) -> np.ndarray:
        """A document's length against the mean, in hundredths, of its number of terms."""
        if self.docs * int(n.max(initial=0)) * 90 < 1 << 63:
            return 100 - 90 + (90 * n * self.docs) // max(self.terms, 1)
        return np.array([100 - 90 + (90 * int(x) * self.docs) // self.terms for x in n], np.int64)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def statistics(docs: DataFrame) -> Statistics:
    """Counted over all of ``docs`` (text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = total = 0
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                n = len(terms_of(text))
                seen += n > 0
                total += n
        yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([total], pa.int64())], names=["docs", "terms"])

    row = docs.select("text").mapInArrow(run, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    return Statistics(row[0] or 0, row[1] or 0)


# -- shards -------------------------------------------------------------------------------

SHARDS = T.StructType([
    T.StructField("words", T.BinaryType()),       # the shard's terms, sorted, one a line
    T.StructField("sizes", T.BinaryType()),       # postings of each term
    T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("lengths", T.BinaryType()),     # of each document (Statistics.lengths)
    T.StructField("firsts", T.BinaryType()),      # first document of each block
    T.StructField("tops", T.BinaryType()),        # largest impact of each block
    T.StructField("gaps", T.BinaryType()), T.StructField("counts", T.BinaryType()),
    T.StructField("widths", T.BinaryType()),      # of each term: bytes of a gap | bytes of a count << 4
])
_WIDTHS = ((1, np.dtype("u1")), (2, np.dtype("<u2")), (4, np.dtype("<u4")))


def _width(largest: np.ndarray) -> np.ndarray:
    return np.where(largest < 1 << 8, 1, np.where(largest < 1 << 16, 2, 4)).astype(np.uint8)


def _packed(values: np.ndarray, widths: np.ndarray) -> bytes:
    """``values`` one after the other, each in its own number of bytes, little-endian."""
    keep = np.arange(4)[None, :] < widths[:, None]
    return values.astype("<u4").view(np.uint8).reshape(-1, 4)[keep].tobytes()


def _block_starts(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First posting of every block, and the first block of every list (one more at the end)."""
    blocks = -(-sizes // BLOCK)
    first_block = np.concatenate([[0], np.cumsum(blocks)])
    first_posting = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    within = np.arange(first_block[-1]) - np.repeat(first_block[:-1], blocks)
    return np.repeat(first_posting, blocks) + within * BLOCK, first_block


class ShardBuilder:
    """Documents gathered for one shard: term numbers and counts, as plain arrays."""

    def __init__(self, stats: Statistics):
        self.stats = stats
        self.numbers: dict[bytes, int] = {}
        self.keys: list[int | None] = []
        self.sizes, self.terms, self.counts = array("q"), array("i"), array("q")

    def add(self, key: int | None, words: list[bytes]) -> None:
        counted, numbers = Counter(words), self.numbers
        for w in counted:
            if w not in numbers:
                numbers[w] = len(numbers)
        self.keys.append(key)
        self.sizes.append(len(counted))
        self.terms.extend(map(numbers.__getitem__, counted))
        self.counts.extend(counted.values())

    def row(self) -> pa.RecordBatch:
        """The shard's row (``SHARDS``)."""
        order = sorted(range(len(self.keys)), key=lambda i: (self.keys[i] is not None, self.keys[i] or 0))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        sizes, tf = np.array(self.sizes), np.array(self.counts)
        doc = np.repeat(place, sizes)
        n_terms = np.zeros(len(order), np.int64)
        n_terms[place] = np.add.reduceat(tf, np.cumsum(sizes) - sizes)
        lengths = self.stats.lengths(n_terms)
        words = sorted(self.numbers)
        rank = np.empty(len(words), np.int64)
        rank[[self.numbers[w] for w in words]] = np.arange(len(words))
        term = rank[np.array(self.terms)]
        by_term = np.lexsort((doc, term))
        term, doc, tf = term[by_term], doc[by_term], tf[by_term]
        sizes = np.bincount(term, minlength=len(words))
        starts, _ = _block_starts(sizes)
        gaps = np.diff(doc, prepend=0)
        gaps[starts] = 0
        lists = np.cumsum(sizes) - sizes
        gap_width, count_width = (_width(np.maximum.reduceat(x, lists)) for x in (gaps, tf))
        tops = np.maximum.reduceat(impact(tf, lengths[doc]), starts)
        cells = [b"\n".join(words), sizes.astype("<u4").tobytes(), [self.keys[i] for i in order],
                 lengths.astype("<i8").tobytes(), doc[starts].astype("<u4").tobytes(), tops.astype("<i8").tobytes(),
                 _packed(gaps, gap_width[term]), _packed(tf, count_width[term]), (gap_width | count_width << 4).tobytes()]
        kinds = [pa.list_(pa.int64()) if f.name == "doc_ids" else pa.binary() for f in SHARDS.fields]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(cells, kinds)], names=SHARDS.names)


def build_index(docs: DataFrame, stats: Statistics, shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """Shards of ``docs`` (doc_id, text), one row each. Null and wordless texts are left out;
    rows that share a doc_id are documents of their own. Other columns are passed over."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = ShardBuilder(stats)
        for batch in slices(batches):
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if words := terms_of(text):
                    shard.add(key, words)
                if len(shard.terms) >= shard_postings:
                    yield shard.row()
                    shard = ShardBuilder(stats)
        if shard.keys:
            yield shard.row()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SHARDS)


class Lists:
    """The posting lists of one shard. Nothing is unpacked before it is asked for."""

    def __init__(self, row: dict):
        self.lengths = np.frombuffer(row["lengths"], "<i8")
        self.sizes = np.frombuffer(row["sizes"], "<u4").astype(np.int64)
        self.starts, self.first_block = _block_starts(self.sizes)
        self.firsts = np.frombuffer(row["firsts"], "<u4").astype(np.int64)
        self.tops = np.frombuffer(row["tops"], "<i8")
        self.gaps, self.counts = row["gaps"], row["counts"]
        widths = np.frombuffer(row["widths"], np.uint8)
        self.gap_width, self.count_width = (widths & 15).astype(np.int64), (widths >> 4).astype(np.int64)
        self.gap_at = np.cumsum(self.sizes * self.gap_width) - self.sizes * self.gap_width
        self.count_at = np.cumsum(self.sizes * self.count_width) - self.sizes * self.count_width
        self.numbers = {w: i for i, w in enumerate(row["words"].split(b"\n"))} if row["words"] else {}

    def bound(self, term: int) -> int:
        return int(self.tops[self.first_block[term]:self.first_block[term + 1]].max())

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """(first document, largest impact) of the term's blocks."""
        at = slice(self.first_block[term], self.first_block[term + 1])
        return self.firsts[at], self.tops[at]

    def unpack(self, term: int, picked: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(documents, impacts) of a term, of its blocks ``picked`` (ascending) only if given."""
        n = int(self.sizes[term])
        gaps, counts = (np.frombuffer(raw, dict(_WIDTHS)[int(w[term])], n, int(at[term])) for raw, w, at in (
            (self.gaps, self.gap_width, self.gap_at), (self.counts, self.count_width, self.count_at)))
        firsts = self.blocks(term)[0]
        if picked is not None and len(picked) < len(firsts):
            take = (picked[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            take = take[take < n]
            gaps, counts, firsts = gaps[take], counts[take], firsts[picked]
        size = np.full(len(firsts), BLOCK)
        size[-1] = len(gaps) - BLOCK * (len(firsts) - 1)
        run = np.cumsum(gaps, dtype=np.int64)
        docs = run - np.repeat(run[np.arange(len(firsts)) * BLOCK], size) + np.repeat(firsts, size)
        return docs, impact(counts.astype(np.int64), self.lengths[docs])


def top_of_shard(lists: Lists, weights: dict[bytes, int], k: int, least: int = 0,
                 opened: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores), best first, of at most ``k`` documents of a shard with a score above
    0. Documents below ``least`` may be missing. ``opened`` collects (blocks unpacked, blocks)."""
    known = [(w * lists.bound(t), t, w) for word, w in weights.items() if w > 0 and (t := lists.numbers.get(word)) is not None]
    known.sort(key=lambda x: (-x[0], x[1]))
    rest = np.cumsum([0, *(x[0] for x in reversed(known))])[::-1]  # bounds from list i on, added up
    total = np.zeros(len(lists.lengths), np.int64)
    least, i = max(least, 1), 0

    def kth(scores: np.ndarray) -> int:
        return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0

    while i < len(known) and rest[i] >= least:  # essential lists
        docs, score = lists.unpack(known[i][1])
        total[docs] += known[i][2] * score
        least = max(least, kth(total[docs]))
        if opened is not None:
            n = len(lists.blocks(known[i][1])[0])
            opened.append((n, n))
        i += 1
    at = np.flatnonzero(total + rest[i] >= least)
    at = at[total[at] > 0]
    scores = total[at]
    for i in range(i, len(known)):  # the others, on the documents found
        _, term, weight = known[i]
        least = max(least, kth(scores))
        firsts, tops = lists.blocks(term)
        block = np.searchsorted(firsts, at, side="right") - 1
        top = np.where(block >= 0, weight * tops[np.maximum(block, 0)], 0)
        stay = scores + top + rest[i + 1] >= least
        at, scores, block = at[stay], scores[stay], block[stay]
        picked = np.unique(block[block >= 0])
        if opened is not None:
            opened.append((len(picked), len(firsts)))
        if len(picked):
            docs, score = lists.unpack(term, picked)
            place = np.minimum(np.searchsorted(docs, at), len(docs) - 1)
            scores = scores + np.where(docs[place] == at, weight * score[place], 0)
    order = np.lexsort((at, -scores))[:k]
    order = order[scores[order] >= least]
    return at[order], scores[order]


# -- searching ----------------------------------------------------------------------------

def _frequencies(shards: DataFrame, asked: frozenset[bytes]) -> dict[bytes, int]:
    """Documents that hold each of ``asked``, read from the dictionaries alone."""
    shared = shards.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        for batch in slices(batches, 1):
            sizes = np.frombuffer(batch.column(1)[0].as_py(), "<u4")
            for i, word in enumerate(batch.column(0)[0].as_py().split(b"\n")):
                if word in shared.value:
                    seen[word] = seen.get(word, 0) + int(sizes[i])
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                                         names=["word", "df"])

    rows = shards.select("words", "sizes").mapInArrow(run, "word binary, df long")
    return {bytes(r["word"]): r["df"] for r in rows.groupBy("word").agg(F.sum("df").alias("df")).collect()}


def _heaps(shards: DataFrame, queries: list[tuple[int, list[bytes]]], weights: dict[bytes, int], k: int) -> DataFrame:
    """(query, doc_id, score): the best of every partition's shards."""
    shared = shards.sparkSession.sparkContext.broadcast([(q, {w: weights[w] for w in words}) for q, words in queries])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, bool, int]]] = {}
        for batch in slices(batches, 1):
            row = {name: batch.column(i)[0].as_py() for i, name in enumerate(batch.schema.names)}
            lists, keys = Lists(row), row["doc_ids"]
            for q, weighed in shared.value:
                heap = best.get(q, [])
                docs, scores = top_of_shard(lists, weighed, k, -heap[-1][0] if len(heap) == k else 0)
                if len(docs):
                    heap = heap + [(-s, keys[d] is not None, keys[d] or 0) for d, s in zip(docs.tolist(), scores.tolist())]
                    best[q] = sorted(heap)[:k]
        rows = [(q, key if some else None, -s) for q, heap in best.items() for s, some, key in heap]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], names=["query", "doc_id", "score"])

    return shards.mapInArrow(run, "query long, doc_id long, score long")


def best(heaps: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of every query of (query, doc_id, score), with their rank."""
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    # first within groups of partitions, so that no task meets the heaps of all shards
    some = Window.partitionBy("query", "_of").orderBy(*order)
    rows = heaps.withColumn("_of", F.floor(F.spark_partition_id() / MERGED_SHARDS)).withColumn(
        "_rank", F.row_number().over(some)).where(F.col("_rank") <= k).drop("_of", "_rank")
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(
        F.col("rank") <= k)


def search(shards: DataFrame, queries: DataFrame, stats: Statistics, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): for every row of ``queries`` (item_id, text) the ``k``
    documents of the index with the highest score above 0, equal scores by doc_id (null first).

    A query's terms count once each. Queries without a known term have no rows; rows that share
    an item_id are queries of their own, each with its ranks. Queries are read in blocks of about
    ``QUERY_ROWS`` rows and ``QUERY_BYTES`` bytes of text, and the shards once for each block.
    """
    queries = write_scratch(queries.select("item_id", "text").select(
        F.monotonically_increasing_id().alias("query"), "item_id", "text"), "queries")
    n, size = queries.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    blocks = max(1, -(-n // QUERY_ROWS), -(-(size or 0) // QUERY_BYTES))
    out = []
    for block in range(blocks):
        mine = queries.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block) if blocks > 1 else queries
        asked = [(r["query"], list(dict.fromkeys(terms_of(r["text"])))) for r in mine.select("query", "text").toLocalIterator()]
        df = _frequencies(shards, frozenset(w for _, words in asked for w in words))
        weights = {w: stats.weight(x) for w, x in df.items()}
        asked = [(q, [w for w in words if w in weights]) for q, words in asked]
        out.append(write_scratch(best(_heaps(shards, asked, weights, k), k), "ranked"))
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found.join(queries.select("query", "item_id"), "query").select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def rank_documents(docs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """Index all of ``docs`` (doc_id, text) and search them for ``queries`` (item_id, text).

    An empty table of either has no result. Null texts have no terms.
    """
    stats = statistics(docs)
    shards = write_scratch(build_index(docs, stats), "lexical")
    found = search(shards, queries, stats, k)
    drop_scratch(shards)
    return found
