"""Near-duplicate groups by SimHash fingerprints and pigeonring filtering.

A fingerprint has 64 bits: bit b is 1 if it is set in over half of the hashes of a text's word
shingles, repeats included. Two fingerprints link if at most ``distance`` bits differ.

The bits are cut in ``distance + 1`` segments that stand in a ring. If two fingerprints differ in
at most ``distance`` bits, there is a segment from which every chain of l consecutive segments
differs in at most l * distance / (distance + 1) bits: the first segment not at all, the first
two in one bit at most, and so on round the ring (the strong form of the pigeonring principle).
So every fingerprint is indexed by each pair of neighbouring segments with each bit of the second
one left out in turn: pairs whose chain of two is within budget share a key, once at least. What
shares a key must keep the budgets of the longer chains, and only then are all bits compared.

Equal fingerprints are one node. No bucket is expanded into all its pairs: a task emits links
that join what was not joined yet. Buckets of more than ``BLOCK_ROWS`` nodes are first linked to
their smallest node; those that still hold several components are compared block by block, and
only members of different components meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import drop_scratch, slices, write_scratch
from revlens.llm.graph import components

#: Words of a shingle, and differing bits of linked fingerprints, in op11's contract.
SHINGLE = 4
DISTANCE = 4
#: Seed of the shingle hash.
SEED = 42
#: Larger buckets are dealt out in blocks of about this many nodes.
BLOCK_ROWS = 2000
#: Buckets up to this size are compared side by side, all at once.
SMALL_ROWS = 64

#: For each value of a byte its eight bits, lowest first.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def shingle_hashes(text: str | None, size: int = SHINGLE) -> list[bytes]:
    """Digests (XXH64, big-endian) of a text's shingles in order: ``size`` words after each other,
    A-Z in lower case, joined by blanks. Fewer words are one shingle, none have none."""
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return [xxhash.xxh64_digest(b" ".join(words), SEED)] if words else []
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[:len(words) - size + 1].tolist()
    digest = xxhash.xxh64_digest
    return [digest(line[a:b], SEED) for a, b in zip(starts, ends[size - 1:].tolist())]


def fingerprints(texts: list[str | None], size: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text; 0 for texts without words."""
    found = [shingle_hashes(t, size) for t in texts]
    counts = np.array([len(f) for f in found], np.int64)
    hashes = np.frombuffer(b"".join(b"".join(f) for f in found), np.uint8).reshape(-1, 8)
    owner = np.repeat(np.arange(len(texts)) * 256, counts)
    out = np.zeros(len(texts), np.uint64)
    for k in range(8):  # of the digest's bytes the first is the highest
        seen = np.bincount(owner + hashes[:, 7 - k], minlength=256 * len(texts)).reshape(-1, 256)
        bits = (2 * (seen @ _BITS) > counts[:, None]).astype(np.uint64)
        out |= (bits << np.arange(8 * k, 8 * k + 8, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return out


def sign(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, print): every document's fingerprint as a long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            prints = fingerprints(batch.column(1).to_pylist(), size)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "print"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, print long")


class Ring:
    """Segments of a fingerprint and the keys and budgets that follow from them."""

    def __init__(self, distance: int):
        if not 2 <= distance <= 31:
            raise ValueError("a distance from 2 to 31")
        self.distance, self.size = distance, distance + 1
        self.segments = [b.tolist() for b in np.array_split(np.arange(64), self.size)]
        masks = [sum(1 << b for b in s) for s in self.segments]
        self.key_bits = [len(s) + len(self.segments[k - 1]) for k, s in enumerate(self.segments)]
        #: for each kind of key (the bit left out) the masks of its chains of 3, 4, .. segments
        self.chains = np.zeros((64, max(0, self.size - 3)), np.uint64)
        for k, segment in enumerate(self.segments):
            first = k - 1
            for length in range(3, self.size):
                mask = 0
                for j in range(length):
                    mask |= masks[(first + j) % self.size]
                self.chains[segment, length - 3] = mask

    def keys(self, name: str) -> Column:
        """All 64 keys (array of long) of the fingerprint column ``name``: kind and bits."""
        out = []
        for k, segment in enumerate(self.segments):
            low, width = self.segments[k - 1][0], self.key_bits[k]
            turned = F.col(name) if low == 0 else F.shiftrightunsigned(F.col(name), low).bitwiseOR(F.shiftleft(F.col(name), 64 - low))
            for bit in segment:
                kept = ((1 << width) - 1) ^ (1 << (bit - low) % 64)
                out.append(turned.bitwiseAND(F.lit(kept)).bitwiseOR(F.lit(_signed(bit << 58))))
        return F.array(*out)

    def alike(self, kind: np.ndarray | int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places of the pairs within distance whose chains from ``kind``'s first segment keep
        their budgets; each longer chain only sees what the ones before it left."""
        differ = a ^ b
        left = np.arange(len(differ))
        for k in range(self.chains.shape[1]):
            mask = self.chains[kind[left], k] if isinstance(kind, np.ndarray) else self.chains[kind, k]
            budget = (k + 3) * self.distance // self.size
            stay = np.bitwise_count(differ & mask) <= budget
            left, differ = left[stay], differ[stay]
        return left[np.bitwise_count(differ) <= self.distance]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def kind_of(key: np.ndarray) -> np.ndarray:
    return (key.view(np.uint64) >> np.uint64(58)).astype(np.int64)


def _forest(pairs: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of links those that join two groups which the ones before them did not."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = parent[x]
        return x

    out = []
    for a, b in pairs:
        x, y = root(a), root(b)
        if x != y:
            parent[x] = y
            out.append((a, b))
    return out


def _reach(ring: Ring, kind: int, nodes: np.ndarray) -> list[tuple[int, int]]:
    """Links that join what is linked in a bucket: from node to node, each held against those that
    no other one has reached yet."""
    rest, out = nodes, []
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            one = todo.pop()
            hit = ring.alike(kind, np.broadcast_to(one, len(rest)), rest)
            if len(hit):
                found = rest[hit]
                out += [(int(one), x) for x in found.tolist()]
                todo.extend(found)
                rest = np.delete(rest, hit)
    return out


_FOUND = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()),
                       T.StructField("key", T.LongType())])


def _join(distance: int, block_rows: int, small_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (key, print) sorted by key to links (a, b); the rows of buckets of more than
        ``block_rows`` rows go on as they are (a: print, key). At most one bucket's
        ``block_rows`` rows are kept from batch to batch."""
        ring = Ring(distance)

        def rows(a, b=None, key=None) -> pa.RecordBatch:
            none = pa.nulls(len(a), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), none if b is None else pa.array(b, pa.int64()),
                 none if key is None else pa.array(key, pa.int64())], names=_FOUND.names)

        def solve(key: np.ndarray, node: np.ndarray) -> Iterator[pa.RecordBatch]:
            begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            sizes = np.diff(np.append(begins, len(key)))
            hot = np.repeat(sizes > block_rows, sizes)
            if hot.any():
                yield rows(node[hot], key=key[hot])
            links = []
            for k in np.flatnonzero((sizes > small_rows) & (sizes <= block_rows)):
                part = slice(begins[k], begins[k] + sizes[k])
                links += _reach(ring, int(kind_of(key[part][:1])[0]), node[part].view(np.uint64))
            few = (sizes > 1) & (sizes <= small_rows)
            pick = np.repeat(few, sizes)
            left = (np.repeat(sizes, sizes) - 1 - (np.arange(len(key)) - np.repeat(begins, sizes)))[pick]
            kind, prints = kind_of(key[pick]), node[pick].view(np.uint64)
            one, two = [], []
            for step in range(1, int(sizes[few].max(initial=0))):
                at = np.flatnonzero(left >= step)
                hit = at[ring.alike(kind[at], prints[at], prints[at + step])]
                one.append(prints[hit])
                two.append(prints[hit + step])
            if one:
                pairs = np.unique(np.stack([np.concatenate(one), np.concatenate(two)], axis=1), axis=0)
                links += pairs.tolist()
            if links := _forest(iter(links)):
                ends = np.array(links, np.uint64).view(np.int64)
                yield rows(ends[:, 0], ends[:, 1])

        key, node, passing = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for batch in batches:
            key, node = np.concatenate([key, batch.column(0).to_numpy()]), np.concatenate([node, batch.column(1).to_numpy()])
            if not len(key):
                continue
            if passing is not None:
                n = int(np.searchsorted(key != passing, True)) if key[-1] != passing else len(key)
                if n:
                    yield rows(node[:n], key=key[:n])
                key, node = key[n:], node[n:]
                if not len(key):
                    continue
                passing = None
            last = int(np.searchsorted(key == key[-1], True))
            if last:
                yield from solve(key[:last], node[:last])
            key, node = key[last:], node[last:]
            if len(key) > block_rows:
                yield rows(node, key=key)
                passing, key, node = key[0], key[:0], node[:0]
        if len(key):
            yield from solve(key, node)

    return run


def _between(distance: int):
    def run(table: pa.Table) -> pa.Table:
        """Links between components of one pair of blocks of a bucket."""
        table = table.combine_chunks()
        ring = Ring(distance)
        one, two = table.column("one")[0].as_py(), table.column("two")[0].as_py()
        kind = int(kind_of(table.column("key").to_numpy()[:1])[0])
        node, comp = table.column("node").to_numpy(), table.column("component").to_numpy()
        block = table.column("block").to_numpy()
        first = np.flatnonzero(block == one)
        second = first if one == two else np.flatnonzero(block == two)
        prints = node.view(np.uint64)

        def pairs() -> Iterator[tuple[int, int]]:
            for i in first.tolist():
                hit = second[ring.alike(kind, np.broadcast_to(prints[i], len(second)), prints[second])]
                hit = hit[comp[hit] != comp[i]]
                for c in np.unique(comp[hit]).tolist():
                    yield int(comp[i]), c

        links = _forest(pairs())
        return pa.table({c: pa.array([x[i] for x in links], pa.int64()) for i, c in enumerate("ab")})

    return run


def linked_prints(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(node, component) of the fingerprints (node: long, each once) that link to another one."""
    ring = Ring(distance)
    index = prints.select(F.explode(ring.keys("node")).alias("key"), F.col("node").alias("print"))
    found = write_scratch(index.repartition("key").sortWithinPartitions("key").mapInArrow(
        _join(distance, BLOCK_ROWS, SMALL_ROWS), _FOUND), "found")
    links = found.where("b IS NOT NULL").select("a", "b")
    large = found.where("b IS NULL").select("key", F.col("a").alias("node"))
    if large.isEmpty():
        out = components(links)
        drop_scratch(found)
        return out
    heads = large.groupBy("key").agg(F.min("node").alias("head"))
    stars = large.join(heads, "key").where(
        (F.col("node") != F.col("head")) & (F.bit_count(F.col("node").bitwiseXOR(F.col("head"))) <= distance)).select(
        F.col("node").alias("a"), F.col("head").alias("b"))
    first = components(links.unionByName(stars))
    placed = write_scratch(large.join(first, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component")), "placed")
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                      F.count("*").alias("n")).where("low <> high").select(
        "key", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"))
    rows = placed.join(mixed, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "node", "component", "block")
    more = components(rows.groupBy("key", "one", "two").applyInArrow(_between(distance), "a long, b long"))
    # a node's last component: its own, moved by the links between components
    nodes = first.select("node", "component").unionByName(
        more.join(first, "node", "left_anti").select("node", F.col("node").alias("component")))
    out = write_scratch(nodes.join(more.withColumnsRenamed({"node": "_at", "component": "_to"}), F.col("component") == F.col("_at"),
                                   "left").select("node", F.coalesce("_to", "component").alias("component")), "joined")
    for table in (found, first, placed, more):
        drop_scratch(table)
    return out


def group_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id): fingerprint as 16 lower-case hexadecimal digits,
    component_id the smallest doc_id that links reach.

    Null, empty and wordless texts have the fingerprint 0, which links like any other. Rows that
    share a doc_id are rows of their own; a component of null ids only has a null component_id.
    Other columns are passed over, an empty table has no rows.
    """
    signed = write_scratch(sign(docs, shingle), "prints")
    nodes = write_scratch(signed.groupBy(F.col("print").alias("node")).agg(F.min("doc_id").alias("first")), "nodes")
    linked = linked_prints(nodes.select("node"), distance)
    joined = linked.join(nodes, "node")
    least = joined.groupBy("component").agg(F.min("first").alias("least"))
    moved = joined.join(least, "component").select("node", "least")
    ids = nodes.join(moved, "node", "left").select(
        F.col("node").alias("print"), F.coalesce("least", "first").alias("component_id"))
    return signed.join(ids, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
