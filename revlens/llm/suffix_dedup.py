"""Removal of long strings that stand anywhere else, by suffix arrays over boundary stretches.

A place is repeated if the ``LENGTH`` bytes from it on also start somewhere else. Sorting every
suffix of a corpus in one task is out of the question, so the corpus is cut by content first:

1. Every window of ``LENGTH`` bytes has an anchor, the leftmost smallest hash of its
   ``GRAM``-byte grams. Equal windows have equal anchors at equal places, so they meet when
   stretches (runs of windows with one anchor) are dealt by the anchor's hash. A stretch equal
   as a whole to another is repeated as a whole; one whose anchor nobody shares is unique.
   Equal stretches of one task are told apart from the rest before anything is shuffled.
2. What is left are stretches that share an anchor but differ: the borders of repeated
   passages. They are cut in cells of ``CELL`` windows. All windows of a cell hold the same
   core, so a cell is a short string: the bytes before the core, the core as one symbol, the
   bytes after it. Cells with the same core meet in one task; their strings are joined, sorted
   by the linear grouping construction (``suffix_array``), and neighbours in that order that
   agree over ``CELL`` symbols are equal windows.
3. A core with more than ``HOT_CELLS`` cells is split by a salt; the groups of equal windows of
   each salt, sorted one after the other, then meet by a digest, one row a group.

All matches are judged on the texts as they come in. Every row has a number of its own, given when
its text is written, compressed, at the start; so rows that share an id are never mixed up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import drop_scratch, slices, write_scratch
from revlens.llm.shingles import mix
from revlens.llm.suffix_array import suffix_array

LENGTH = 200
GRAM = 32
CELL = 32
#: Stretches held by a task before equal ones are put together.
HELD_ROWS = 300_000
#: Symbols sorted at a time, and cells of one core that one task sorts.
BLOCK_SYMBOLS = 400_000
HOT_CELLS = 20_000

_draw = np.random.default_rng(200)
#: Random words for the gram hash: one a byte value, and the odd base of the polynomial.
_BYTE = _draw.integers(0, 1 << 64, 256, np.uint64)
_BASE = int(_draw.integers(0, 1 << 63)) * 2 + 1


def gram_hashes(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """Hash of the ``size`` (a power of two) bytes from every place on."""
    h, step, base = _BYTE[data], 1, _BASE
    while step < size:
        h = h[:-step] * np.uint64(base) + h[step:]
        base, step = base * base % (1 << 64), 2 * step
    return mix(h)


def stretches(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, anchor place, first window, last window) of the runs of windows of
    ``length`` bytes that have one anchor."""
    if len(data) < length:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    hashes = gram_hashes(data)
    span = length - GRAM + 1
    low, place, step = hashes, np.arange(len(hashes)), 1
    while step < span:  # smallest of the next `step` hashes, doubled as far as it goes
        by = min(step, span - step)
        left = low[:-by] <= low[by:]
        low, place = np.where(left, low[:-by], low[by:]), np.where(left, place[:-by], place[by:])
        step += by
    cut = np.flatnonzero(np.diff(place)) + 1
    first = np.concatenate([[0], cut])
    last = np.concatenate([cut, [len(place)]]) - 1
    return hashes[place[first]], place[first], first, last


# A stretch's place is its row and one long: first window << 32 | (anchor - first) << 24 |
# (last - first) << 16.
_STRETCH = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("whole", T.LongType()),
                         T.StructField("row", T.LongType()), T.StructField("at", T.LongType()),
                         T.StructField("copies", T.ByteType())])
# copies: 1 seen once so far, 2 seen more often, 3 known to be repeated (only passed on)


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            anchor, whole, at, owner = (np.concatenate(c) for c in zip(*held))
            order = np.lexsort((whole, anchor))
            anchor, whole, at, owner = (c[order] for c in (anchor, whole, at, owner))
            new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1])])
            begins = np.flatnonzero(new)
            many = np.repeat(np.diff(np.append(begins, len(new))) > 1, np.diff(np.append(begins, len(new))))
            copies = np.where(many, 2, 1).astype(np.int8)
            # rows of a repeated stretch: the first also stands for it, all are passed on as known
            known = np.flatnonzero(many)
            one = np.flatnonzero(new)
            rows = np.concatenate([one, known])
            state = np.concatenate([copies[one], np.full(len(known), 3, np.int8)])
            spread = mix(at[known].view(np.uint64) + owner[known].view(np.uint64))  # any task will do
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([anchor[one], spread]).view(np.int64)),
                 pa.array(whole[rows].view(np.int64)), pa.array(owner[rows]),
                 pa.array(at[rows]), pa.array(state)], names=_STRETCH.names)

        n = 0
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in slices(batches):
            for key, packed in zip(*(batch.column(i).to_pylist() for i in range(2))):
                raw = unpack(packed)
                anchor, place, first, last = stretches(np.frombuffer(raw, np.uint8), length)
                if not len(anchor):
                    continue
                off, run_len = place - first, last - first
                whole = np.array([xxhash.xxh3_64_intdigest(raw[a:b], seed=s) for a, b, s in zip(
                    first.tolist(), (last + length).tolist(), off.tolist())], np.uint64)
                held.append((anchor, whole, first << 32 | off << 24 | run_len << 16, np.full(len(anchor), key)))
                n += len(anchor)
                if n >= HELD_ROWS:
                    yield flush()
                    held, n = [], 0
        if held:
            yield flush()

    return run


_JUDGED = T.StructType([T.StructField("row", T.LongType()), T.StructField("at", T.LongType()),
                        T.StructField("kind", T.ByteType())])
# kind: 0 repeated as a whole, 1 to be compared window by window, 2 repeated and a partner for those


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches sorted by (anchor, whole) to judged ones. Only the last group of equal
    stretches is kept from batch to batch, so an anchor shared by very many costs no memory."""
    tail: pa.Table | None = None
    beside = False  # the tail's anchor had another stretch before it

    def decide(rows: pa.Table, final: bool) -> tuple[pa.RecordBatch, pa.Table | None, bool]:
        anchor, whole = rows.column("anchor").to_numpy(), rows.column("whole").to_numpy()
        copies = rows.column("copies").to_numpy()
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1])])
        begins = np.flatnonzero(new)
        ends = np.append(begins[1:], len(new))
        seen = np.add.reduceat(np.minimum(copies, 2).astype(np.int64), begins)
        same = anchor[begins][1:] == anchor[begins][:-1]
        shared = np.concatenate([[beside], same]) | np.concatenate([same, [False]])
        before = np.concatenate([[beside], same])
        upto = len(begins) if final else len(begins) - 1
        group = np.repeat(np.arange(len(begins)), ends - begins)
        repeated, mixed = (seen > 1)[group], shared[group]
        kind = np.full(len(new), -1, np.int8)
        kind[(copies == 3) | (repeated & (copies == 1))] = 0
        kind[~repeated & mixed & (copies == 1)] = 1
        partner = begins[(seen > 1) & shared & (copies[begins] < 3)]
        held = group < upto
        rows = rows.combine_chunks()
        pick = np.flatnonzero(held & (kind >= 0))
        partner = partner[held[partner]]
        take = np.concatenate([pick, partner])
        kinds = np.concatenate([kind[pick], np.full(len(partner), 2, np.int8)])
        out = pa.RecordBatch.from_arrays(
            [*(rows.column(c).combine_chunks().take(pa.array(take)) for c in ("row", "at")), pa.array(kinds)],
            names=_JUDGED.names)
        if final:
            return out, None, False
        return out, rows.slice(int(begins[-1])), bool(before[-1])

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if tail is not None:
            rows = pa.concat_tables([tail, rows])
        if rows.num_rows:
            out, tail, beside = decide(rows, False)
            if tail.num_rows > HELD_ROWS:  # of a group of equal stretches two rows tell as much as all
                known = tail
                kinds = pa.array(np.zeros(known.num_rows, np.int8))
                tail = pa.concat_tables([tail.slice(0, 2).drop_columns("copies").append_column(
                    "copies", pa.array([2, 3], pa.int8()))]).select(_STRETCH.names)
                yield pa.RecordBatch.from_arrays(
                    [*(known.column(c).combine_chunks() for c in ("row", "at")), kinds], names=_JUDGED.names)
            yield out
    if tail is not None and tail.num_rows:
        yield decide(tail, True)[0]


_CELL = T.StructType([T.StructField("core", T.LongType()), T.StructField("left", T.BinaryType()),
                      T.StructField("right", T.BinaryType()), T.StructField("row", T.LongType()),
                      T.StructField("base", T.LongType()), T.StructField("known", T.BooleanType())])


def _cells(length: int, cell: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in slices(batches, 64):
            out: list[tuple] = []
            for key, packed, rows in zip(*(batch.column(i).to_pylist() for i in range(3))):
                raw = unpack(packed)
                for row in rows:
                    at = row["at"]
                    first, off, run_len = at >> 32, at >> 24 & 255, at >> 16 & 255
                    place = first + off
                    near, far = off - run_len, off  # windows start `near`..`far` bytes before the anchor
                    for j in range(near // cell, far // cell + 1):
                        base = place - j * cell      # a window with a left bytes starts at base - a
                        a0, a1 = max(near - j * cell, 0), min(far - j * cell, cell - 1)
                        stop = base + length - cell + 1
                        core = xxhash.xxh3_64_intdigest(raw[base:stop], seed=j & 0xFFFF)
                        out.append((core - (1 << 63), raw[base - a1:base], raw[stop:stop + cell - 1 - a0],
                                    key, base, row["kind"] == 2))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*out)) if out else [[]] * 6, (
                    pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.bool_()))],
                names=_CELL.names)

    return run


_WINDOWS = T.StructType([T.StructField("row", T.LongType()),
                         T.StructField("first", T.LongType()), T.StructField("last", T.LongType()),
                         T.StructField("digest", T.BinaryType()), T.StructField("times", T.LongType())])


def _equal_windows(cells: list[tuple], cell: int) -> list[list[tuple[int, int]]]:
    """Groups of equal windows, as (cell number, left bytes), among ``cells`` of (core, left,
    right): joined to one string, suffix-sorted, neighbours compared over ``cell`` symbols.
    Windows equal to no other are groups of one."""
    cores = {c: 257 + k for k, c in enumerate(dict.fromkeys(core for core, _, _ in cells))}
    parts, starts, owner, lefts, at = [], [], [], [], 0
    for k, (core, left, right) in enumerate(cells):
        symbols = np.empty(len(left) + len(right) + 2, np.int32)
        symbols[:len(left)] = np.frombuffer(left, np.uint8)
        symbols[:len(left)] += 1
        symbols[len(left)] = cores[core]
        symbols[len(left) + 1:-1] = np.frombuffer(right, np.uint8)
        symbols[len(left) + 1:-1] += 1
        symbols[-1] = 0
        a = np.arange(cell - 1 - len(right), len(left) + 1)
        starts.append(at + len(left) - a)
        owner.append(np.full(len(a), k))
        lefts.append(a)
        parts.append(symbols)
        at += len(symbols)
    text = np.concatenate([*parts, np.zeros(cell, np.int32)])
    order = suffix_array(text)
    window = np.full(len(text), -1)
    window[np.concatenate(starts)] = np.arange(sum(map(len, starts)))
    ranked = window[order]
    ranked = ranked[ranked >= 0]
    start, owner, lefts = np.concatenate(starts)[ranked], np.concatenate(owner)[ranked], np.concatenate(lefts)[ranked]
    rows = text[start[:, None] + np.arange(cell)]
    new = np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])
    edges = np.append(np.flatnonzero(new), len(start)).tolist()
    pairs = list(zip(owner.tolist(), lefts.tolist()))
    return [pairs[a:b] for a, b in zip(edges[:-1], edges[1:])]


def _sort_cells(length: int, cell: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cells sorted by (core, salt): windows found repeated; for cores split over tasks
        also one row a group of equal windows, to be counted by digest."""
        def solve(rows: list[tuple]) -> list[tuple]:
            out: list[tuple] = []
            by_core: dict[int, dict[tuple[bytes, bytes], list[int]]] = {}
            for i, row in enumerate(rows):
                by_core.setdefault(row[0], {}).setdefault((row[1], row[2]), []).append(i)
            kept, members = [], []
            for core, strings in by_core.items():
                hot = rows[next(iter(strings.values()))[0]][6]
                if len(strings) == 1 and not hot:
                    (who,) = strings.values()
                    if len(who) > 1:  # one string, several times: all its windows are repeated
                        out += [_span(rows[i], None, cell) for i in who]
                    continue
                for (left, right), who in strings.items():
                    kept.append((core, left, right))
                    members.append(who)
            if kept:
                good: dict[int, list[int]] = {}
                for group in _equal_windows(kept, cell):
                    times = sum(2 if rows[i][5] else 1 for k, _ in group for i in members[k])
                    hot = rows[members[group[0][0]][0]][6]
                    for k, a in group:
                        if times > 1:
                            good.setdefault(k, []).append(a)
                    if hot:
                        k, a = group[0]
                        core, left, right = kept[k]
                        digest = hashlib.blake2b(b"%d,%d," % (core, a) + left[len(left) - a:] + right[:cell - 1 - a],
                                                 digest_size=16).digest()
                        row = rows[members[k][0]]
                        out.append((row[3], row[4] - a, row[4] - a, digest, times))
                for k, lefts in good.items():
                    for first, last in _ranges(lefts):
                        out += [_span(rows[i], (first, last), cell) for i in members[k]]
            return out

        held: list[tuple] = []
        symbols = 0
        for batch in slices(batches, 4096):
            for row in zip(*(batch.column(i).to_pylist() for i in range(8))):
                if symbols >= BLOCK_SYMBOLS and (row[0], row[7]) != (held[-1][0], held[-1][7]):
                    yield _window_rows(solve(held))
                    held, symbols = [], 0
                held.append(row)
                symbols += len(row[1]) + len(row[2]) + 2
        if held:
            yield _window_rows(solve(held))

    return run


def _span(row: tuple, lefts: tuple[int, int] | None, cell: int) -> tuple:
    """The windows of a cell with ``lefts`` (smallest, largest) left bytes; None: all of them."""
    small, large = lefts or (cell - 1 - len(row[2]), len(row[1]))
    return row[3], row[4] - large, row[4] - small, None, 0


def _ranges(values: list[int]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for v in sorted(values):
        if out and v == out[-1][1] + 1:
            out[-1][1] = v
        else:
            out.append([v, v])
    return [(a, b) for a, b in out]


def _window_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(list(zip(*rows)) if rows else [[]] * 5, kinds)], names=_WINDOWS.names)


def repeated_windows(rows: DataFrame, length: int = LENGTH, cell: int = CELL) -> DataFrame:
    """(row, first, last): runs of places of ``rows`` (row, packed) from which ``length`` bytes also
    start elsewhere. Runs of a row may overlap or repeat."""
    cut = rows.select("row", "packed").mapInArrow(_cut(length), _STRETCH)
    judged = write_scratch(cut.repartition("anchor").sortWithinPartitions("anchor", "whole").mapInArrow(
        _judge, _JUDGED), "judged")
    whole = judged.where("kind = 0").select(
        "row", F.shiftright("at", 32).alias("first"),
        (F.shiftright("at", 32) + F.shiftright("at", 16).bitwiseAND(255)).alias("last"))
    borders = judged.where("kind > 0").select("row", F.struct("at", "kind").alias("place")).groupBy("row").agg(
        F.collect_list("place").alias("places"))
    cells = rows.select("row", "packed").join(borders, "row").select("row", "packed", "places").mapInArrow(
        _cells(length, cell), _CELL)
    cells = write_scratch(cells, "cells")
    hot = cells.groupBy("core").agg(F.count("*").alias("n")).where(F.col("n") > HOT_CELLS)
    salted = cells.join(hot, "core", "left").withColumn(
        "salt", F.pmod(F.xxhash64("row", "base"), F.coalesce(F.ceil(F.col("n") / HOT_CELLS), F.lit(1))))
    found = salted.select(*_CELL.names, F.col("n").isNotNull().alias("hot"), "salt").repartition(
        "core", "salt").sortWithinPartitions("core", "salt").mapInArrow(_sort_cells(length, cell), _WINDOWS)
    found = write_scratch(found, "windows")
    drop_scratch(cells)
    # equal windows of a split core that lie under different salts
    split = found.where("digest IS NOT NULL")
    common = split.groupBy("digest").agg(F.sum("times").alias("all")).where(F.col("all") > 1).select("digest")
    return whole.unionByName(found.where("digest IS NULL").drop("digest", "times")).unionByName(
        split.where("times = 1").join(common, "digest").drop("digest", "times"))


def packed_rows(docs: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """row (a number of its own), doc_id, packed (the text's UTF-8 bytes compressed; null as empty)
    and carried columns, written to the shared folder."""
    fields = [T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()),
              T.StructField("packed", T.BinaryType())]
    schema = T.StructType([*fields, *(docs.schema[c] for c in carried)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([pack((t or "").encode()) for t in batch.column(2).to_pylist()], pa.binary()),
                 *batch.columns[3:]], names=schema.names)

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                           "text", *carried)
    return write_scratch(numbered.mapInArrow(run, schema), "packed")


def remove_repeats(docs: DataFrame, length: int = LENGTH, carried: tuple[str, ...] = (),
                   decoded: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (binary: the remaining
    bytes in order) of every whole text as UTF-8, and the columns named in ``carried``.
    ``decoded``: kept is a string, and a cut inside a character takes the rest of it too.

    Every byte covered by ``length`` bytes that also start anywhere else goes, in all of their
    copies. Null and empty texts keep nothing and lose nothing. Every row is a text of its own,
    also with an id that others have or with none; a repeated row is a copy of the other. Columns
    that are not carried are passed over, an empty table has no rows.
    """
    rows = packed_rows(docs, carried)
    windows = repeated_windows(rows, length)
    spans = windows.select("row", F.struct("first", (F.col("last") + length).alias("end")).alias("span")).groupBy("row").agg(
        F.collect_list("span").alias("spans"))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
                           T.StructField("kept", T.StringType() if decoded else T.BinaryType()), *(docs.schema[c] for c in carried)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in slices(batches):
            sizes, gone, runs, kept = [], [], [], []
            lists = batch.column(2)
            edges = lists.offsets.to_numpy()
            # a slice's child array starts where the slice does
            firsts, ends = (lists.values.field(c).to_numpy() for c in ("first", "end"))
            for i, packed in enumerate(batch.column(1).to_pylist()):
                raw = unpack(packed)
                a, b = firsts[edges[i]:edges[i + 1]], ends[edges[i]:edges[i + 1]]
                if len(a) == 0 or not lists[i].is_valid:
                    sizes.append(len(raw)), gone.append(0), runs.append(0), kept.append(raw)
                    continue
                order = np.argsort(a, kind="stable")
                a, reach = a[order], np.maximum.accumulate(b[order])
                new = np.concatenate([[True], a[1:] > reach[:-1]])
                starts = a[new]
                stops = np.append(reach[:-1][new[1:]], reach[-1])
                left = np.concatenate([[0], stops])
                right = np.append(starts, len(raw))
                sizes.append(len(raw))
                gone.append(int((stops - starts).sum()))
                runs.append(len(starts))
                kept.append(b"".join(raw[x:y] for x, y in zip(left.tolist(), right.tolist())))
            left_over = pa.array([k.decode(errors="ignore") for k in kept], pa.string()) if decoded else pa.array(kept, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in (sizes, gone, runs)),
                 left_over, *batch.columns[3:]], names=schema.names)

    return rows.join(spans, "row", "left").select("doc_id", "packed", "spans", *carried).mapInArrow(run, schema)


def without_repeats(docs: DataFrame, length: int = LENGTH, carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text without its repeats, n_chars of it, and the carried columns. A cut inside a
    character takes the rest of the character too; a text may become empty."""
    rows = remove_repeats(docs, length, carried, decoded=True).select("doc_id", F.col("kept").alias("text"), *carried)
    return rows.withColumn("n_chars", F.length("text").cast("long"))
