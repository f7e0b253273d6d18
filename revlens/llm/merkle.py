"""Merkle manifest of a dataset, DataFrame functions only.

A tree of fan-out 16 stands over the leaves of every group (a source), and one more over the
groups' roots. Nodes are hexadecimal digests. The nodes of a level are cut in aligned blocks of
``16 ** HEIGHT``; a block keeps each of its levels as one hexadecimal string. Fixed-width
substrings of 16 digests hash to the next level, and the substrings beside a node's own digest
are its siblings. The roots of the blocks are the nodes that the next round cuts in blocks, until
a group has one node; then the rounds are walked back down, and every block hands its items the
siblings above it. A round groups at most ``16 ** HEIGHT`` rows, whatever the size of a group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.common import drop_scratch, let, write_scratch

#: Children of a node, and levels hashed in one round.
FAN_OUT = 16
HEIGHT = 3
#: Characters of a digest, and of the children of a node.
DIGEST = 64
RUN = FAN_OUT * DIGEST

_PATH = "array<struct<left:string,right:string>>"


def digest(value: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of a string's UTF-8 bytes."""
    return F.sha2(value.cast("binary"), 256)


def field(value: Column) -> Column:
    """A value as part of a leaf: ``-`` if null, else its UTF-8 byte count, ``:``, the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: list[Column]) -> Column:
    return digest(F.concat(*map(field, columns)))


def folded(start: Column, path: Column) -> Column:
    """The root that a digest and its siblings (level by level) lead to."""
    return F.aggregate(path, start, lambda acc, s: F.sha2(
        F.concat(s["left"], acc, s["right"]).cast("binary"), 256))


def siblings(path: Column) -> Column:
    """All siblings of a path, level by level and left to right, as one hexadecimal string."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def ranked(items: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``items`` with ``pos`` (place within its group by ``order``, from 0) and ``total`` (the
    group's rows), without a sort of a whole group in one task.

    Rows are dealt by ranges of (group, order) and numbered where they lie; one row for each
    partition and group tells where the partition's part of the group begins. ``order`` should
    tell all rows apart, or equal rows stay in one partition.
    """
    dealt = items.repartitionByRange(group, *order).sortWithinPartitions(group, *order).select(
        "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at"))
    dealt = write_scratch(dealt, "dealt")
    parts = dealt.groupBy(group, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    upto = Window.partitionBy(group).orderBy("_part")
    parts = parts.select(
        F.col(group).alias("_group"), F.col("_part").alias("_in"), "_first",
        (F.sum("_n").over(upto) - F.col("_n")).alias("_before"),
        F.sum("_n").over(Window.partitionBy(group)).alias("total"))
    return dealt.join(parts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_in"))).withColumn(
        "pos", F.col("_before") + F.col("_at") - F.col("_first")).drop(
        "_group", "_in", "_part", "_at", "_first", "_before")


def _run(level: Column, k: Column) -> Column:
    """The k-th (from 0) children string of a level's string."""
    return F.substring(level, (k * RUN + 1).cast("int"), F.lit(RUN))


def _parents(level: Column) -> Column:
    """The level above: the digests of all children strings, joined."""
    runs = F.ceil(F.length(level) / RUN).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(0), runs - 1), lambda k: digest(_run(level, k))), "")


def _blocks(items: DataFrame, group: str, payload: list[str], height: int) -> DataFrame:
    """(group, block, total, items, l0 .. l<height>): one row for each block of ``items``
    (group, pos, total, hash, payload). ``items`` holds the payloads in order. A level over a
    single node of the whole group is that node itself."""
    own = F.sort_array(F.collect_list(F.struct("pos", "hash", *payload)))
    rows = items.groupBy(group, F.floor(F.col("pos") / FAN_OUT ** height).cast("long").alias("block")).agg(
        F.max("total").alias("total"), own.alias("items"))
    rows = rows.withColumn("l0", F.array_join(F.col("items.hash"), ""))
    for k in range(height):
        more = F.col("total") > FAN_OUT ** k
        rows = rows.withColumn(f"l{k + 1}", F.when(more, let(F.col(f"l{k}"), _parents)).otherwise(F.col(f"l{k}")))
    return rows


def _walk(height: int, emit: Callable[[Column, Column, Column], Column]) -> Column:
    """``emit(item, digest, path)`` of all items of a block: the siblings of each level, found
    once for every run of 16 items and cut beside each item, then the block's own path."""
    def run(r: Column) -> Column:
        above = []  # the same for all items of the run
        for k in range(1, height):
            at, off = F.floor(r / FAN_OUT ** k).cast("int"), F.pmod(F.floor(r / FAN_OUT ** (k - 1)), F.lit(FAN_OUT)).cast("int")
            above.append(F.when(F.col("total") > FAN_OUT ** k, _beside(_run(F.col(f"l{k}"), at), off)))
        upper = F.concat(F.array_compact(F.array(*above)).cast(_PATH), F.col("path"))

        def item(shared: Column) -> Column:
            def one(x: Column, j: Column) -> Column:
                first = F.when(F.col("total") > 1, F.array(_beside(shared["run"], j))).otherwise(
                    F.array().cast(_PATH))
                return emit(x, F.substring(shared["run"], j * DIGEST + 1, F.lit(DIGEST)),
                            F.concat(first.cast(_PATH), shared["upper"]))

            return F.transform(F.slice("items", r * FAN_OUT + 1, FAN_OUT), one)

        return let(F.struct(_run(F.col("l0"), r).alias("run"), upper.alias("upper")), item)

    runs = F.ceil(F.size("items") / FAN_OUT).cast("int")
    return F.flatten(F.transform(F.sequence(F.lit(0), runs - 1), run))


def _beside(run: Column, off: Column) -> Column:
    """What stands left and right of the digest at place ``off`` of a children string."""
    return F.struct(F.substring(run, F.lit(1), off * DIGEST).alias("left"),
                    F.substring(run, off * DIGEST + DIGEST + 1, F.lit(RUN)).alias("right"))


class Forest:
    """One tree for each group of ``items`` (group, order, hash, payload), written block by block.

    ``roots`` is (group, root, total): a row for each group. ``walk`` gives every item its path.
    """

    def __init__(self, items: DataFrame, group: str, order: list[str], payload: list[str], height: int = HEIGHT):
        self.group, self.payload, self.height = group, payload, height
        self.rounds: list[DataFrame] = []
        rows, kept = ranked(items, group, order), payload
        while True:
            blocks = write_scratch(_blocks(rows, group, kept, height), "blocks")
            self.rounds.append(blocks)
            blocks_of = F.ceil(F.col("total") / FAN_OUT ** height).cast("long")
            rows = blocks.select(group, F.col("block").alias("pos"), blocks_of.alias("total"),
                                 F.col(f"l{height}").alias("hash"))
            kept = []
            if (rows.agg(F.max("total")).first()[0] or 0) <= 1:
                break
        self.roots = rows.select(group, F.col("hash").alias("root"))

    def walk(self, tops: DataFrame, carried: list[str], emit: Callable[[Column, Column, Column], Column]) -> DataFrame:
        """``emit(item, digest, path)`` (a struct) of every item, its fields as columns, and the
        ``carried`` columns of ``tops`` (group, path, carried): the path above each group's root."""
        above = tops.select(self.group, F.lit(0).cast("long").alias("pos"), "path", *carried)
        for depth, blocks in reversed(list(enumerate(self.rounds))):
            last = depth == 0
            step = emit if last else (lambda x, _, path: F.struct(x["pos"].alias("pos"), path.alias("path")))
            joined = blocks.alias("b").join(above.alias("a"), F.col(f"b.{self.group}").eqNullSafe(
                F.col(f"a.{self.group}")) & (F.col("b.block") == F.col("a.pos"))).select("b.*", "a.path", *carried)
            above = joined.select(self.group, *carried, F.inline(_walk(self.height, step)))
            if not last:
                above = write_scratch(above, "paths")
        return above

    def drop(self) -> None:
        """Delete the written blocks."""
        for blocks in self.rounds:
            drop_scratch(blocks)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tampered(key: Column) -> Column:
    """Where 5 divides the unsigned CRC-32 of the decimal key; a null key never is."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def manifest(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every document.

    A leaf is the digest of doc_id, source, lang, n_chars and text. Per source the leaves ascend
    by doc_id (null first, equal ids by leaf; a repeated row is a leaf of its own), a null source
    is a source; the sources' roots ascend by source, null first, by bytes. The proof is the
    digest of all siblings from the leaf up to the root. ``folded_root`` folds the siblings over
    the leaf of the tampered row (text in lower case where ``tampered``), else over the leaf, and
    ``verified`` tells whether that is the root. Other columns are passed over; an empty table
    has no rows.
    """
    fields = ["doc_id", "source", "lang", "n_chars"]
    rows = docs.select(*fields, "text")
    hashed = rows.select(
        "doc_id", "source", leaf([F.col(c) for c in (*fields, "text")]).alias("hash"),
        F.when(tampered(F.col("doc_id")), leaf([*map(F.col, fields), lower_ascii(F.col("text"))])).alias("other"),
        F.monotonically_increasing_id().alias("row"))
    hashed = write_scratch(hashed, "leaves")
    trees = Forest(hashed, "source", ["doc_id", "hash", "row"], ["doc_id", "other"], height)
    roots = write_scratch(trees.roots.select(F.lit(0).alias("all"), "source", F.col("root").alias("hash")), "subroots")
    top = Forest(roots, "all", ["source"], ["source"], height)
    root = write_scratch(top.roots, "root")
    tops = top.walk(
        root.select("all", F.array().cast(_PATH).alias("path"), "root"), ["root"],
        lambda x, h, path: F.struct(x["source"].alias("source"), h.alias("subroot"), path.alias("path")))
    tops = write_scratch(tops.select("source", "subroot", "root", "path"), "tops")
    out = trees.walk(tops, ["subroot", "root"], lambda x, h, path: F.struct(
        x["doc_id"].alias("doc_id"), h.alias("leaf"), digest(siblings(path)).alias("proof_sha256"),
        folded(F.coalesce(x["other"], h), path).alias("folded_root")))
    top.drop()
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))
