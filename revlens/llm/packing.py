"""Best-fit packing of token pieces into fixed-length sequences.

Hierarchical residual packing: every partition packs its own pieces by best fit and emits the
bins that are nearly full; the underfull bins become the items of the next round, in fewer and
fewer nodes, until one node has seen all that is left. A node never holds more than about
``node_rows`` items, so no task grows with the corpus; if what is left does not fit one node,
rounds go on while they still join bins.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import slices, write_scratch
from revlens.llm.word_encoder import word_encoder

CAPACITY = 2048
#: A bin with at most this many free places is emitted at once.
SLACK = 8
#: Most items that one node packs at a time.
NODE_ROWS = 200_000
#: Nodes merged into one from round to round.
FAN_IN = 8

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
])


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins as lists of item numbers: items by falling size, each into the bin with the least
    room that still holds it. Ties go to the earlier item. Open bins hang on their free room;
    one integer marks the rooms in use, and its lowest set bit from the size up is the best."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    marks = 0
    bins: list[list[int]] = []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = marks >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            stack = by_room[room]
            b = stack.pop()
            if not stack:
                marks ^= 1 << room
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        left = room - size
        if left:
            if not by_room[left]:
                marks |= 1 << left
            by_room[left].append(b)
    return bins


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece of each document: (doc_id, piece, start, length, ids_crc32).

    A document is its ids and then ``end_id``; only one longer than ``capacity`` is cut, into
    pieces of that length and a last one. A null text counts as empty (one piece holding the
    end id). Repeated rows give repeated pieces; other columns are not read.
    """
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(tokenizer).encode
        end = end_id.to_bytes(4, "little")
        step = 4 * capacity
        for batch in slices(batches):
            out: list[tuple] = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text or "") + end
                view = memoryview(ids)
                for k, at in enumerate(range(0, len(ids), step)):
                    part = view[at:at + step]
                    out.append((key, k, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                 *(pa.array(c, pa.int64()) for c in cols[2:])], names=PIECES.names)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(pieces, PIECES)


def pack(items: DataFrame, capacity: int = CAPACITY, length_col: str = "length", slack: int = SLACK,
         node_rows: int = NODE_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """``items`` with sequence_id and offset: each item lies whole in one sequence of at most
    ``capacity``, and the items of a sequence fill it from 0 without gaps.

    Items need a length from 1 to ``capacity``; others (and null) raise. Equal rows are packed
    as often as they stand. An empty table gives an empty one. Columns named sequence_id or
    offset in ``items`` are replaced.
    """
    items = items.drop("sequence_id", "offset")
    names = items.columns
    payload = T.StructType([T.StructField(f.name, f.dataType) for f in items.schema] +
                           [T.StructField("offset", T.LongType())])
    carried = T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("fill", T.LongType()),
                            T.StructField("members", T.ArrayType(payload)), T.StructField("closed", T.BooleanType())])

    def packed(fills: np.ndarray, starts: np.ndarray, members: pa.Array, bins: list[list[int]],
               first: int, slack: int) -> pa.RecordBatch:
        """Bins over old bins; old bin i holds members starts[i]:starts[i + 1]."""
        order = np.fromiter((i for b in bins for i in b), np.int64)
        counts = np.diff(starts)[order]
        ends = np.cumsum(counts)
        take = np.repeat(starts[:-1][order] - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)
        edges = np.concatenate([[0], np.cumsum([len(b) for b in bins])]).astype(np.int64)
        held = np.concatenate([[0], ends])[edges]
        fill = np.add.reduceat(fills[order], edges[:-1]) if bins else np.zeros(0, np.int64)
        kept = members.take(pa.array(take))
        sizes = kept.field(length_col).to_numpy()
        at = np.cumsum(sizes) - sizes
        if bins:
            at = at - np.repeat(at[held[:-1]], np.diff(held))
        kept = pa.StructArray.from_arrays([*(kept.field(c) for c in names), pa.array(at, pa.int64())],
                                          names=[*names, "offset"])
        return pa.RecordBatch.from_arrays(
            [pa.array(first + np.arange(len(bins)), pa.int64()), pa.array(fill, pa.int64()),
             pa.ListArray.from_arrays(pa.array(held, pa.int32()), kept), pa.array(fill >= capacity - slack)],
            names=carried.names)

    def by_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            sizes = rows.column(length_col).to_numpy()
            if rows.column(length_col).null_count or len(sizes) and not (1 <= sizes.min() and sizes.max() <= capacity):
                raise ValueError(f"lengths must lie between 1 and {capacity}")
            flat = rows.to_struct_array()
            flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
            return packed(sizes, np.arange(len(sizes) + 1), flat, best_fit(sizes, capacity), first, slack)

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= node_rows:
                yield (out := flush())
                first, held = first + out.num_rows, []
        if held:
            yield flush()

    def by_node(level: int, last: bool):
        def merge(table: pa.Table) -> pa.Table:
            rows = table.combine_chunks()
            node = rows.column("node")[0].as_py()
            fills = rows.column("fill").to_numpy()
            lists = rows.column("members").chunk(0)
            starts = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
            out = packed(fills, starts, lists.flatten(), best_fit(fills, capacity), (level << 56) + (node << 32),
                         capacity if last else slack)
            return pa.Table.from_batches([out])

        return merge

    bins = write_scratch(items.mapInArrow(by_partition, carried), "bins")
    tables, level, nodes, before = [bins], 0, 1 << 30, -1
    while True:
        open_bins = bins.where(~F.col("closed")).select("sequence_id", "fill", "members")
        n, parts = open_bins.agg(F.count("*"), F.countDistinct(F.shiftright("sequence_id", 32))).first()
        needed = math.ceil(n / node_rows)
        nodes = max(needed, math.ceil(min(nodes, parts) / fan_in))
        if n <= 1 or (before >= 0 and nodes > 1 and n > 0.99 * before):
            break
        level += 1
        last = nodes == 1
        bins = write_scratch(
            open_bins.withColumn("node", F.pmod(F.xxhash64("sequence_id"), F.lit(nodes)))
            .groupBy("node").applyInArrow(by_node(level, last), carried), "bins")
        tables.append(bins)
        before = n
        if last:
            break
    done = [t.where("closed") for t in tables[:-1]] + [tables[-1]]
    rows = done[0]
    for t in done[1:]:
        rows = rows.unionByName(t)
    rows = rows.select("sequence_id", F.explode("members").alias("member"))
    return rows.select(*(F.col("member")[c].alias(c) for c in names), "sequence_id",
                       F.col("member.offset").alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Every document tokenized, cut and packed: one row for each piece with its sequence."""
    return pack(write_scratch(token_pieces(docs, tokenizer, end_id, capacity), "pieces"), capacity)
