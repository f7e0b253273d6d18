"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token is a linked list of byte runs. Every neighbouring pair that the rank table knows
waits in the bucket of its merge rank; a two-level bitmap marks the buckets in use, so the next
rank is found by two find-first-set steps however long the pre-token is. An entry whose pair
has changed since it was put there is stale and skipped when it comes up. Within one rank the
leftmost pair goes first.
"""

from __future__ import annotations

import base64
import hashlib
import re
import unicodedata
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import slices, worker_state

#: Pre-tokens whose ids one Python worker keeps.
CACHE_ENTRIES = 500_000
#: Longer pre-tokens (bytes) are encoded without being kept.
CACHE_BYTES = 64


class RankQueue:
    """Positions by merge rank: ``pop`` gives the lowest rank's leftmost position."""

    __slots__ = ("top", "leaves", "buckets")

    def __init__(self):
        self.top, self.leaves, self.buckets = 0, {}, {}

    def push(self, rank: int, at: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket:
            heappush(bucket, at)
            return
        self.buckets[rank] = [at]
        leaf = rank >> 8
        self.leaves[leaf] = self.leaves.get(leaf, 0) | 1 << (rank & 255)
        self.top |= 1 << leaf

    def pop(self) -> tuple[int, int]:
        leaf = (self.top & -self.top).bit_length() - 1
        marks = self.leaves[leaf]
        low = marks & -marks
        rank = leaf << 8 | low.bit_length() - 1
        bucket = self.buckets[rank]
        at = heappop(bucket)
        if not bucket:
            self.leaves[leaf] = marks ^ low
            if marks == low:
                self.top ^= 1 << leaf
        return rank, at


class _Cache(dict):
    def __init__(self, compute):
        super().__init__()
        self.compute = compute

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) < CACHE_ENTRIES and len(key) <= CACHE_BYTES:
            self[key] = value
        return value


class ByteBPE:
    """Encoder and decoder over a rank table (token bytes -> rank) and a pre-token pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {v: k for k, v in ranks.items()}
        self.any_text = regex.compile(pattern)
        self.latin_text = re.compile(_over_latin1(pattern).encode("latin-1"))
        self.latin = _Cache(lambda piece: self._ids(piece.decode("latin-1").encode()))
        self.other = _Cache(lambda piece: self._ids(piece.encode()))

    @classmethod
    def load(cls, path: str, pattern: str) -> ByteBPE:
        """From a rank file: lines of base64 token and rank."""
        with open(path, "rb") as lines:
            return cls({base64.b64decode(t): int(r) for t, r in (x.split() for x in lines if x.strip())}, pattern)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        end = list(range(1, n + 1))      # the run that starts at i ends before end[i]
        before = list(range(-1, n))      # where the run before the one at i starts
        waiting = [-1] * n               # the rank for which the pair at i now waits
        queue = RankQueue()
        push, pop, rank_of = queue.push, queue.pop, ranks.get
        for i in range(n - 1):
            r = rank_of(piece[i:i + 2])
            if r is not None:
                waiting[i] = r
                push(r, i)
        while queue.top:
            r, i = pop()
            if waiting[i] != r:
                continue
            j = end[i]
            k = end[i] = end[j]
            waiting[i] = waiting[j] = -1
            if k < n:
                before[k] = i
                r = rank_of(piece[i:end[k]])
                if r is not None:
                    waiting[i] = r
                    push(r, i)
            if i:
                h = before[i]
                r = rank_of(piece[h:k])
                waiting[h] = -1
                if r is not None:
                    waiting[h] = r
                    push(r, h)
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:end[i]]])
            i = end[i]
        return out

    def _ids(self, piece: bytes) -> bytes:
        return np.array(self.merge(piece), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        try:
            narrow = text.encode("latin-1")
        except UnicodeEncodeError:
            return b"".join(map(self.other.__getitem__, self.any_text.findall(text)))
        return b"".join(map(self.latin.__getitem__, self.latin_text.findall(narrow)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _over_latin1(pattern: str) -> str:
    r"""The pattern with \p{L}, \p{N}, \s and \S written out over the first 256 code points,
    for the faster byte matcher; texts beyond them use the pattern as it is."""
    chars = [chr(c) for c in range(256)]
    named = {
        r"\p{L}": [c for c in chars if unicodedata.category(c)[0] == "L"],
        r"\p{N}": [c for c in chars if unicodedata.category(c)[0] == "N"],
        r"\s": [c for c in chars if regex.match(r"\s", c)],
        r"\S": [c for c in chars if regex.match(r"\S", c)],
    }
    out, inside, i = [], False, 0
    while i < len(pattern):
        name = next((k for k in named if pattern.startswith(k, i)), None)
        if name:
            body = "".join(f"\\x{ord(c):02x}" for c in named[name])
            out.append(body if inside else f"[{body}]")
            i += len(name)
            continue
        if pattern[i] == "\\":
            out.append(pattern[i:i + 2])
            i += 2
            continue
        inside = {"[": True, "]": False}.get(pattern[i], inside)
        out.append(pattern[i])
        i += 1
    return "".join(out)


def byte_bpe(path: str, pattern: str) -> ByteBPE:
    """One codec for each Python worker: its caches live on from task to task."""
    return worker_state(("bytes", path, pattern), lambda: ByteBPE.load(path, pattern))


def encode_documents(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id and ids (binary, little-endian unsigned 32-bit) of every whole text.

    Null and empty texts have no ids; repeated rows are encoded each; no special tokens. Other
    columns are not read.
    """
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe(ranks, pattern).encode
        for batch in slices(batches):
            ids = [encode(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=schema.names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``encoded`` (doc_id, ids) to doc_id and bytes: the tokens' bytes one after the other."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("bytes", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = byte_bpe(ranks, pattern).decode
        for batch in slices(batches):
            out = [decode(i or b"") for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=schema.names)

    return encoded.select("doc_id", "ids").mapInArrow(run, schema)


def round_trip(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Encode and decode in one pass, keeping digests: doc_id, n_tokens, ids_sha256,
    decoded_sha256. Rows and edge cases as in ``encode_documents``."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = byte_bpe(ranks, pattern)
        for batch in slices(batches):
            counts, ids_sha, text_sha = [], [], []
            for text in batch.column(1).to_pylist():
                ids = codec.encode(text or "")
                counts.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(text_sha, pa.string())], names=schema.names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
