"""Near-duplicate groups by a multi-index Hamming join over b-bit minwise signatures.

A document is the set of its word shingles; its signature is ``SLOTS`` minwise hashes of 16 bits.
Slots are cut into ``CHUNKS`` chunks. By the pigeonhole principle two signatures that differ in
at most ``2 * CHUNKS - 1`` slots have a chunk with at most one differing slot, so every chunk is
indexed once for each slot left out: pairs within that distance always share a key. What shares
a key is confirmed on the full shingle sets.

Equal sets are one node. No bucket is expanded into all its pairs: first each member is held
against the bucket's smallest member; what is linked so becomes one component; then only
members of different components meet, in blocks of bounded size inside one task, which emits
links that join components and nothing else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import drop_scratch, slices, write_scratch
from revlens.llm.graph import components
from revlens.llm.shingles import make_seeds, mix, shingle_sets, signature

#: Words of a shingle in op8's contract; the pipeline's stage has a size of its own.
SHINGLE = 4
PERCENT = 80
#: A pair of likeness 0.8 shares no key with a chance of 0.263 ** CHUNKS, one in nine million.
CHUNKS = 12
CHUNK_SLOTS = 5
SLOTS = CHUNKS * CHUNK_SLOTS
#: Pairs whose signatures differ in more slots are not measured: at a likeness of 0.8 or more the
#: chance of that is below 1e-10.
FAR_SLOTS = 36
#: Rows of a task that compares the members of buckets.
TASK_ROWS = 5000
#: A block of a bucket holds about this many members, and this many shingles.
BLOCK_ROWS = 2000
BLOCK_SHINGLES = 2_000_000

_SIGNED_FIELDS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_shingles", T.LongType()),
                        T.StructField("set_id", T.BinaryType()), T.StructField("signature", T.BinaryType())])


def _bytes_of(text: str | None) -> bytes:
    return (text or "").encode().lower()


def sign(docs: DataFrame, shingle: int = SHINGLE, carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, set_id (digest of the shingle set; null for no shingles), signature, and
    the columns named in ``carried``."""
    schema = T.StructType([*_SIGNED_FIELDS.fields, *(docs.schema[c] for c in carried)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = make_seeds(SLOTS)
        for batch in slices(batches):
            sets = shingle_sets([_bytes_of(t) for t in batch.column(1).to_pylist()], shingle)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, sets), pa.int64()),
                 pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                 pa.array([signature(s, seeds).tobytes() if len(s) else None for s in sets], pa.binary()),
                 *batch.columns[2:]], names=schema.names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carried).mapInArrow(run, schema)


def _digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _signatures(column) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint16).reshape(-1, SLOTS)


def index_keys(nodes: DataFrame) -> DataFrame:
    """(kind, key, node) of nodes (node, signature): every chunk with each slot left out in turn."""
    schema = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("key", T.LongType()),
                           T.StructField("node", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            slots = _signatures(batch.column(1)).astype(np.uint64)
            for kind in range(SLOTS):
                chunk, out = divmod(kind, CHUNK_SLOTS)
                key = np.full(len(slots), kind, np.uint64)
                for k in range(CHUNK_SLOTS):
                    if k != out:
                        key = mix(key * np.uint64(0x10001) + slots[:, chunk * CHUNK_SLOTS + k])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(slots), kind, np.int32)), pa.array(key.view(np.int64)), batch.column(0)],
                    names=schema.names)

    return nodes.select("node", "signature").mapInArrow(run, schema)


def _meeting(kind: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs of signatures differ in at most ``FAR_SLOTS`` slots and have ``kind`` as the
    first key that they share (so that one bucket alone measures a pair)."""
    chunk, out = divmod(kind, CHUNK_SLOTS)
    alike = np.zeros((len(left), len(right)), np.uint8)
    own = np.ones((len(left), len(right)), bool)
    for c in range(CHUNKS):
        here = np.zeros_like(alike)
        for k in range(c * CHUNK_SLOTS, (c + 1) * CHUNK_SLOTS):
            here += left[:, k][:, None] == right[:, k][None, :]
        alike += here
        if c < chunk:
            own &= here < CHUNK_SLOTS - 1
        elif c == chunk and out:
            own &= here < CHUNK_SLOTS
    return own & (alike >= SLOTS - FAR_SLOTS)


def _pairs(table: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """(row, later or other-block rows of other components that it must be measured against)."""
    kind, one, two = (table.column(c)[0].as_py() for c in ("kind", "one", "two"))
    slots = _signatures(table.column("signature"))
    comp, block = table.column("component").to_numpy(), table.column("block").to_numpy()
    first = np.flatnonzero(block == one)
    second = first if one == two else np.flatnonzero(block == two)
    for at in range(0, len(first), 256):
        rows = first[at:at + 256]
        meet = _meeting(kind, slots[rows], slots[second])
        meet &= comp[rows][:, None] != comp[second][None, :]
        if one == two:
            meet &= rows[:, None] < second[None, :]
        for i in np.flatnonzero(meet.any(axis=1)):
            yield int(rows[i]), second[meet[i]]


_GROUP = ["kind", "key", "one", "two"]


def _to_measure(table: pa.Table) -> pa.Table:
    """The rows of a block pair that some other row must be measured against."""
    active = np.zeros(table.num_rows, bool)
    for row, others in _pairs(table):
        active[row] = True
        active[others] = True
    return table.filter(pa.array(active)).select([*_GROUP, "node", "component", "block", "signature"])


def _links(percent: int):
    def run(table: pa.Table) -> pa.Table:
        """Links between components of one block pair, confirmed on the shingle sets; of links
        that join the same components only the first."""
        table = table.combine_chunks()
        sets = [np.asarray(s) for s in (x.values.to_numpy() for x in table.column("shingles"))]
        comp = table.column("component").to_numpy().tolist()
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.get(x, x) != x:
                parent[x] = parent.get(parent[x], parent[x])
                x = parent[x]
            return x

        _, numbered = np.unique(np.concatenate(sets), return_inverse=True)
        edges = np.cumsum([0, *map(len, sets)])
        tokens = [numbered[a:b] for a, b in zip(edges[:-1], edges[1:])]
        seen = np.zeros(int(numbered.max()) + 1, bool)
        out = []
        for row, others in _pairs(table):
            seen[tokens[row]] = True
            for other in others.tolist():
                a, b = root(comp[row]), root(comp[other])
                if a == b:
                    continue
                shared = int(np.count_nonzero(seen[tokens[other]]))
                if 100 * shared >= percent * (len(tokens[row]) + len(tokens[other]) - shared):
                    parent[a] = b
                    out.append((comp[row], comp[other]))
            seen[tokens[row]] = False
        return pa.table({"a": pa.array([x[0] for x in out], pa.int64()), "b": pa.array([x[1] for x in out], pa.int64())})

    return run


def _shingles_of(docs: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """(node, n, shingles) of ``nodes`` (node, set_id, doc_id): each set made again from the
    text of one document that has it."""
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("shingles", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()  # equal doc_ids meet in one task, so a repeated row is made once
        for batch in slices(batches):
            keys, digests = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            sets = shingle_sets([_bytes_of(t) for t in batch.column(2).to_pylist()], shingle)
            own = []
            for i, key in enumerate(keys):
                # rows that share their doc_id with other texts: only the text of the set counts
                if key not in done and _digest(sets[i]) == digests[i]:
                    done.add(key)
                    own.append(i)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(own, pa.int64())), pa.array([len(sets[i]) for i in own], pa.int64()),
                 pa.array([sets[i].view(np.int64) for i in own], pa.list_(pa.int64()))], names=schema.names)

    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), "text")
    rows = nodes.join(texts, F.col("doc_id").eqNullSafe(F.col("_id"))).select("node", "set_id", "text")
    return rows.mapInArrow(run, schema)


def group_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id that links reach), kept.

    Two documents are linked when 100 * shared >= percent * all of their shingles. Null and
    wordless texts have no shingles and are linked with nothing. Rows with equal doc_ids are
    rows of their own; a component of null ids only has a null component_id and is kept. Other
    columns are passed over, an empty table has no rows.
    """
    return _grouped(docs, shingle, percent).select("doc_id", "n_shingles", "component_id", "kept")


def kept_rows(docs: DataFrame, row_key: str, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, ``row_key``) of one row of each component that has an id: the one with the smallest
    doc_id, then the smallest ``row_key``, which tells apart the texts that share an id. Texts
    without shingles are components of their own."""
    kept = _grouped(docs, shingle, percent, (row_key,)).where("kept AND doc_id IS NOT NULL")
    own = F.when(F.col("at").isNull(), F.col(row_key))
    return kept.groupBy("doc_id", "at", own.alias("_own")).agg(F.min(row_key).alias(row_key)).select(
        "doc_id", row_key).distinct()


def _grouped(docs: DataFrame, shingle: int, percent: int, carried: tuple[str, ...] = ()) -> DataFrame:
    """The columns of ``group_near_duplicates``, ``at`` (the component; null without shingles) and
    the columns named in ``carried``."""
    signed = write_scratch(sign(docs, shingle, carried), "signed")
    sets = signed.where("set_id IS NOT NULL").groupBy("set_id").agg(
        F.min("doc_id").alias("doc_id"), F.first("signature").alias("signature"),
        F.first("n_shingles").alias("n_shingles"))
    nodes = write_scratch(sets.select(F.monotonically_increasing_id().alias("node"), "*"), "nodes")
    index = write_scratch(index_keys(nodes), "index")
    heads = index.groupBy("kind", "key").agg(F.min("node").alias("head"), F.count("*").alias("n")).where("n > 1")
    shared = write_scratch(index.join(heads.drop("n"), ["kind", "key"]), "shared")
    drop_scratch(index)

    members = shared.select("node").distinct().join(nodes, "node").select("node", "set_id", "doc_id")
    shingles = write_scratch(_shingles_of(docs, members, shingle), "shingles")

    # every member against the smallest of each of its buckets
    slots = nodes.select("node", "signature")
    far = F.arrow_udf(lambda a, b: pa.array((_signatures(a) != _signatures(b)).sum(axis=1), pa.int32()), "int")
    stars = shared.where("node <> head").select("node", "head").distinct().join(slots, "node").join(
        slots.withColumnsRenamed({"node": "head", "signature": "head_signature"}), "head")
    stars = stars.where(far("signature", "head_signature") <= FAR_SLOTS).select("node", "head")
    n_shared = F.size(F.array_intersect("shingles", "head_shingles"))
    linked = stars.join(shingles, "node").join(
        shingles.withColumnsRenamed({"node": "head", "shingles": "head_shingles", "n": "head_n"}), "head").select(
        "node", "head", "n", "head_n", n_shared.alias("n_shared")).where(
        100 * F.col("n_shared") >= percent * (F.col("n") + F.col("head_n") - F.col("n_shared")))
    links = write_scratch(linked.select(F.col("node").alias("a"), F.col("head").alias("b")), "links")
    first = components(links)

    # members of different components, bucket by bucket
    placed = shared.join(first, "node", "left").select(
        "kind", "key", "node", F.coalesce("component", "node").alias("component"))
    mixed = placed.join(nodes.select("node", "n_shingles"), "node").groupBy("kind", "key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"),
        F.sum("n_shingles").alias("size")).where("low <> high").select(
        "kind", "key", "n", F.ceil(F.greatest(F.col("n") / BLOCK_ROWS, F.col("size") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    mixed = write_scratch(mixed, "mixed")
    # the work goes by rows, which adaptive execution cannot see in their bytes
    tasks = -(-(mixed.agg(F.sum(F.col("n") * F.col("blocks"))).first()[0] or 1) // TASK_ROWS)
    rows = placed.join(mixed.drop("n"), ["kind", "key"]).join(slots, "node").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "kind", "key", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"),
        "node", "component", "block", "signature")
    active = write_scratch(rows.repartition(tasks, *_GROUP).groupBy(*_GROUP).applyInArrow(
        _to_measure, "kind int, key long, one int, two int, node long, component long, block int, signature binary"), "active")
    more = write_scratch(active.join(shingles.select("node", "shingles"), "node").groupBy(*_GROUP).applyInArrow(
        _links(percent), "a long, b long"), "more")
    joined = components(more)

    # a node's last component: its own id, moved by the first links, then by those between components
    last = nodes.join(first, "node", "left").withColumn("at", F.coalesce("component", "node")).drop("component").join(
        joined.withColumnRenamed("node", "at"), "at", "left").select(
        "set_id", "doc_id", F.coalesce("component", "at").alias("at"))
    last = write_scratch(last, "last")
    smallest = last.groupBy("at").agg(F.min("doc_id").alias("component_id"))
    by_set = last.select("set_id", "at").join(smallest, "at").select("set_id", "at", "component_id")
    for table in (shared, shingles, links, first, mixed, active, more, joined):
        drop_scratch(table)
    out = signed.select("doc_id", "n_shingles", "set_id", *carried).join(by_set, "set_id", "left").select(
        "doc_id", "n_shingles", "at", *carried, F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(
            F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
