"""Token ids in wavelet-matrix shards.

A shard is one binary file: the ids of a run of documents as a wavelet matrix, one bit-plane
for each bit of an id. Within a plane the ids stand as the planes above left them: those with
a 0 bit first, those with a 1 bit after, each in their old order. Counts of ones before every
block of ``BLOCK`` bits give rank and select, so a reader finds the token at a place, counts a
token in a range and lists its occurrences without unpacking the ids. Planes and counts are
compressed one by one, and a reader opens only those that it needs.

Shards travel as rows of a parquet table (one file in one binary cell), so they can be written
to and read from any store that Spark reaches.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import slices, write_scratch
from revlens.llm.word_encoder import word_encoder

#: Tokens after which a shard is closed (at the end of a document).
SHARD_TOKENS = 1 << 20
#: Bits between two stored counts of ones.
BLOCK = 4096
_HEAD = struct.Struct("<4sBxxxQQ")
_PART = struct.Struct("<QQQ")
_MAGIC = b"WMX1"


class WaveletMatrix:
    """Rank/select over a sequence of unsigned integers kept as bit-planes."""

    def __init__(self, n: int, zeros: list[int], planes: list, counts: list, lengths):
        self.n, self.zeros, self._planes, self._counts, self._lengths = n, zeros, planes, counts, lengths
        self.bits = len(zeros)

    # -- building and the file format -------------------------------------------------
    @classmethod
    def build(cls, ids: np.ndarray, lengths: np.ndarray | None = None) -> WaveletMatrix:
        """``ids`` in order; ``lengths`` are the token counts of the documents they belong to."""
        bits = max(1, int(ids.max(initial=0)).bit_length())
        now = ids.astype("<u2" if bits <= 16 else "<u4")
        zeros, planes, counts = [], [], []
        for shift in range(bits - 1, -1, -1):
            one = (now & now.dtype.type(1 << shift)).astype(bool)
            packed = np.packbits(one, bitorder="little")
            low = np.compress(~one, now)
            now = np.concatenate([low, np.compress(one, now)])
            zeros.append(len(low))
            planes.append(packed)
            counts.append(cls._ones_before(packed))
        return cls(len(ids), zeros, planes, counts, np.array([len(ids)] if lengths is None else lengths, "<u4"))

    @staticmethod
    def _ones_before(packed: np.ndarray) -> np.ndarray:
        step = BLOCK // 8
        ones = np.bitwise_count(packed).astype(np.uint32)
        sums = np.add.reduceat(ones, np.arange(0, len(ones), step)) if len(ones) else np.zeros(0, np.uint32)
        return np.concatenate([[0], np.cumsum(sums)]).astype("<u4")

    def to_bytes(self) -> bytes:
        pack = zstandard.ZstdCompressor(level=1).compress
        body, table = [], []
        for zero, plane, count in zip(self.zeros, map(self._plane, range(self.bits)), map(self._count, range(self.bits))):
            a, b = pack(plane.tobytes()), pack(count.tobytes())
            table.append(_PART.pack(zero, len(a), len(b)))
            body += [a, b]
        lengths = pack(np.asarray(self._lengths, "<u4").tobytes())
        return b"".join([_HEAD.pack(_MAGIC, self.bits, self.n, len(lengths)), *table, lengths, *body])

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        view = memoryview(data)
        magic, bits, n, size = _HEAD.unpack_from(view)
        if magic != _MAGIC:
            raise ValueError("not a wavelet shard")
        parts = [_PART.unpack_from(view, _HEAD.size + i * _PART.size) for i in range(bits)]
        at = _HEAD.size + bits * _PART.size
        lengths, at = view[at:at + size], at + size
        planes, counts = [], []
        for _, a, b in parts:
            planes.append(view[at:at + a])
            counts.append(view[at + a:at + a + b])
            at += a + b
        return cls(n, [p[0] for p in parts], planes, counts, lengths)

    @staticmethod
    def _open(held, kind: str) -> np.ndarray:
        if isinstance(held, np.ndarray):
            return held
        return np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(held)), kind)

    def _plane(self, k: int) -> np.ndarray:
        self._planes[k] = self._open(self._planes[k], np.uint8)
        return self._planes[k]

    def _count(self, k: int) -> np.ndarray:
        self._counts[k] = self._open(self._counts[k], "<u4")
        return self._counts[k]

    @property
    def lengths(self) -> np.ndarray:
        """Token counts of the shard's documents."""
        self._lengths = self._open(self._lengths, "<u4")
        return self._lengths

    # -- queries ----------------------------------------------------------------------
    def _bit(self, k: int, at: int) -> int:
        return int(self._plane(k)[at >> 3] >> (at & 7)) & 1

    def _ones(self, k: int, at: int) -> int:
        """Ones among the first ``at`` bits of plane k."""
        block = at // BLOCK
        first, last = block * BLOCK // 8, at >> 3
        plane = self._plane(k)
        n = int(self._count(k)[block]) + int(np.bitwise_count(plane[first:last]).sum())
        return n + (int(plane[last] & ((1 << (at & 7)) - 1)).bit_count() if at & 7 else 0)

    def _nth(self, k: int, one: int, nth: int) -> int:
        """Place of the nth (from 0) bit equal to ``one`` in plane k."""
        counts = self._count(k).astype(np.int64)
        if not one:
            counts = np.minimum(np.arange(len(counts)) * BLOCK, self.n) - counts
        block = int(np.searchsorted(counts, nth, side="right")) - 1
        bits = np.unpackbits(self._plane(k)[block * BLOCK // 8:(block + 1) * BLOCK // 8], bitorder="little")
        bits = bits[:min(BLOCK, self.n - block * BLOCK)]
        return block * BLOCK + int(np.flatnonzero(bits == one)[nth - int(counts[block])])

    def access(self, at: int) -> int:
        """The id at place ``at``."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        value = 0
        for k in range(self.bits):
            one = self._bit(k, at)
            ones = self._ones(k, at)
            at = self.zeros[k] + ones if one else at - ones
            value = value << 1 | one
        return value

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        if token >> self.bits:
            return 0, 0
        for k in range(self.bits):
            if token >> (self.bits - 1 - k) & 1:
                lo, hi = self.zeros[k] + self._ones(k, lo), self.zeros[k] + self._ones(k, hi)
            else:
                lo, hi = lo - self._ones(k, lo), hi - self._ones(k, hi)
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """How often ``token`` stands in lo:hi."""
        lo, hi = self._range(token, lo, self.n if hi is None else hi)
        return hi - lo

    def select(self, token: int, nth: int) -> int:
        """Place of the nth (from 0) occurrence of ``token``."""
        lo, hi = self._range(token, 0, self.n)
        if not 0 <= nth < hi - lo:
            raise IndexError(nth)
        at = lo + nth
        for k in range(self.bits - 1, -1, -1):
            one = token >> (self.bits - 1 - k) & 1
            at = self._nth(k, one, at - self.zeros[k] if one else at)
        return at

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, i) for i in range(self.count(token))]

    def ids(self) -> np.ndarray:
        """All ids in order, from the last plane up."""
        now = np.zeros(self.n, "<u2" if self.bits <= 16 else "<u4")
        for k in range(self.bits - 1, -1, -1):
            one = np.unpackbits(self._plane(k), count=self.n, bitorder="little").view(bool)
            above = np.empty_like(now)
            above[np.flatnonzero(~one)] = now[:self.zeros[k]]
            above[np.flatnonzero(one)] = now[self.zeros[k]:] | now.dtype.type(1 << (self.bits - 1 - k))
            now = above
        return now.astype("<u4")


SHARDS = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("shard", T.IntegerType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("file", T.BinaryType()),
])


def write_shards(docs: DataFrame, tokenizer: str, end_id: int, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and lay the ids out in wavelet shards.

    Documents are dealt by ranges of doc_id and sorted (null first, equal doc_ids by a hash of
    their text, which also deals them out), so (part, shard) order is ascending doc_id order. A
    repeated row is written as often as it stands there, other columns are passed over, and an
    empty table has no shards. A null text is empty and has the end id alone. A document never
    spans shards; a longer one makes a larger shard.
    """
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(tokenizer).encode
        end = end_id.to_bytes(4, "little")
        part = TaskContext.get().partitionId()
        keys: list = []
        held: list[bytes] = []
        size = shard = 0

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            file = WaveletMatrix.build(ids, np.array([len(b) // 4 for b in held])).to_bytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([len(ids)], pa.int64()),
                 pa.array([keys], pa.list_(pa.int64())), pa.array([file], pa.binary())], names=SHARDS.names)

        for batch in slices(batches):
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text or "") + end
                keys.append(key)
                held.append(ids)
                size += len(ids) // 4
                if size >= shard_tokens:
                    yield close()
                    keys, held, size, shard = [], [], 0, shard + 1
        if keys:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("_tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
    return rows.select("doc_id", "text").mapInArrow(shards, SHARDS)


DOC_ROWS = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("shard", T.IntegerType()),
    T.StructField("doc_id", T.LongType()), T.StructField("start_in_shard", T.LongType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()),
])


def read_shards(shards: DataFrame) -> DataFrame:
    """Per document of written shards: doc_id, start (ids of all documents before it),
    n_tokens, ids_crc32."""
    def docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            part, shard, keys, file = (batch.column(i)[0].as_py() for i in range(4))
            matrix = WaveletMatrix.from_bytes(file)
            view = memoryview(matrix.ids().tobytes())
            lengths = matrix.lengths.astype(np.int64)
            ends = np.cumsum(lengths)
            starts = ends - lengths
            crcs = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
            n = len(keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * n, pa.int32()), pa.array([shard] * n, pa.int32()), pa.array(keys, pa.int64()),
                 pa.array(starts), pa.array(lengths), pa.array(crcs, pa.int64())], names=DOC_ROWS.names)

    sizes = shards.select("part", "shard", "n_tokens")
    # one row for each partition that wrote shards; then the shards within each
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    within = Window.partitionBy("part").orderBy("shard")
    bases = sizes.withColumn("within", F.sum("n_tokens").over(within) - F.col("n_tokens")).join(parts, "part").select(
        "part", "shard", (F.col("before") + F.col("within")).alias("base"))
    rows = shards.select("part", "shard", "doc_ids", "file").mapInArrow(docs, DOC_ROWS)
    return rows.join(bases, ["part", "shard"]).select(
        "doc_id", (F.col("base") + F.col("start_in_shard")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write all documents to shards in the shared folder and read them back."""
    return read_shards(write_scratch(write_shards(docs, tokenizer, end_id), "shards"))
