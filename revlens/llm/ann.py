"""Approximate nearest neighbours by cross-polytope hashing.

A table's hash is one or more pseudo-rotations (three rounds of random signs and a fast
Hadamard transform) of the unit vector; each gives the signed axis that lies nearest. Rows lie
in one bucket a table. A query looks into the ``probes`` buckets a table whose axes score
highest, so near rows that fell to a neighbouring axis are found too. Candidates are measured
exactly, on the original vectors, where they meet the query; only the ``k`` best of a bucket
leave it. The number of rotations a hash follows from the row count, so that buckets stay near
``BUCKET_ROWS`` rows at any size.

With several rotations the probes grow with the number of buckets, so that a query meets the
share ``SHARE`` of all rows in some table, whatever the number of rotations. They are not listed:
rows and queries meet by the first axis, and the query's bound on the sum of axis scores tells
there which rows lie in a probed bucket.

Equal vectors beyond the ``k + 1`` smallest ids can be nobody's answer and leave before
hashing; buckets that still hold more than ``GROUP_ROWS`` rows or queries are split in blocks.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import slices, write_scratch

TABLES = 20
PROBES = 6
#: Share of the rows that a query of a hash of several rotations is expected to meet.
SHARE = 1 / 3
#: Steps in which axis scores are counted to find the bound of a query.
SCORE_BINS = 1024
#: Rows aimed at in a bucket.
BUCKET_ROWS = 400
#: Most rows, and most queries, of a bucket that meet in one group.
GROUP_ROWS = 10_000
SEED = 71


def _hadamard(rows: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of every row, scaled to keep lengths."""
    n, d = rows.shape
    step = 1
    while step < d:
        pair = rows.reshape(n, d // (2 * step), 2, step)
        rows = np.concatenate([pair[:, :, :1] + pair[:, :, 1:], pair[:, :, :1] - pair[:, :, 1:]], axis=2).reshape(n, d)
        step *= 2
    return rows / math.sqrt(d)


class CrossPolytope:
    """``scores(unit, table, part)``: the scores of the 2d signed axes."""

    def __init__(self, dim: int, tables: int, parts: int, seed: int = SEED):
        self.dim, self.tables, self.parts = dim, tables, parts
        self.width = 1 << max(0, (dim - 1).bit_length())
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, parts, 3, self.width))

    def scores(self, unit: np.ndarray, table: int, part: int) -> np.ndarray:
        rows = np.zeros((len(unit), self.width))
        rows[:, :self.dim] = unit
        for signs in self.signs[table, part]:
            rows = _hadamard(rows * signs)
        return np.concatenate([rows, -rows], axis=1)

    def buckets(self, unit: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """The axis of the first rotation, and those of the others as one number."""
        first, *others = (self.scores(unit, table, part).argmax(axis=1) for part in range(self.parts))
        rest = np.zeros(len(unit), np.int64)
        for axis in others:
            rest = rest * (2 * self.width) + axis
        return first, rest

    def probed(self, unit: np.ndarray, table: int, probes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, first axis, least score that the other axes must add) of the buckets with the
        highest sums of axis scores: exactly ``probes`` with one rotation, else at least so many
        (as many more as share the last step of ``SCORE_BINS``)."""
        scores = [self.scores(unit, table, part) for part in range(self.parts)]
        if self.parts == 1:
            axes = np.argsort(-scores[0], axis=1, kind="stable")[:, :probes]
            return np.repeat(np.arange(len(unit)), axes.shape[1]), axes.ravel(), np.full(axes.size, -np.inf)
        bound = np.array([_bound([s[i] for s in scores], probes) for i in range(len(unit))])
        others = sum(s.max(axis=1) for s in scores[1:])
        rows, axes = np.nonzero(scores[0] + others[:, None] >= bound[:, None])
        return rows, axes, bound[rows] - scores[0][rows, axes]

    def rest_scores(self, unit: np.ndarray, table: int, rest: np.ndarray) -> np.ndarray:
        """What the axes ``rest`` of the rotations after the first score for each row of ``unit``."""
        total = np.zeros((len(unit), len(rest)))
        for part in range(self.parts - 1, 0, -1):
            rest, axis = np.divmod(rest, 2 * self.width)
            total += self.scores(unit, table, part)[:, axis]
        return total


def _bound(scores: list[np.ndarray], probes: int) -> float:
    """A sum that at least ``probes`` combinations of one of each of ``scores`` reach, and few
    more: scores are counted in steps, rounded down, and the counts are convolved."""
    low, step = -max(s.max() for s in scores), 2 * max(s.max() for s in scores) / SCORE_BINS
    counts = np.ones(1)
    for s in scores:
        counts = np.convolve(counts, np.bincount(np.floor((s - low) / step).astype(int)))
    at_least = np.cumsum(counts[::-1])[::-1]
    return len(scores) * low + step * max(0, int(np.flatnonzero(at_least >= min(probes, at_least[0]))[-1]))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


@functools.lru_cache(maxsize=4)
def _hashes(dim: int, tables: int, parts: int) -> CrossPolytope:
    return CrossPolytope(dim, tables, parts)


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # so that no square runs over
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _hashed(rows: DataFrame, tables: int, parts: int, dim: int, probes: int | None) -> DataFrame:
    """Rows (vec_id, embedding) once a table and bucket, with the further axes as ``rest``; for
    queries the probed buckets, with the score ``least`` that the further axes must add."""
    own = T.StructField("least", T.DoubleType()) if probes else T.StructField("rest", T.LongType())
    schema = T.StructType([T.StructField("table", T.IntegerType()), T.StructField("bucket", T.LongType()), own,
                           *rows.schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _hashes(dim, tables, parts)
        for batch in slices(batches, 1024):
            unit = _unit(_matrix(batch.column(1)))
            for table in range(tables):
                if probes:
                    take, keys, more = hashes.probed(unit, table, probes)
                else:
                    take, (keys, more) = np.arange(len(unit)), hashes.buckets(unit, table)
                for at in range(0, len(keys), 8192):
                    part = slice(at, at + 8192)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(keys[part]), table, np.int32)), pa.array(keys[part], pa.int64()),
                         pa.array(more[part]), *(c.take(pa.array(take[part])) for c in batch.columns)],
                        names=schema.names)

    return rows.mapInArrow(run, schema)


FOUND = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()),
                      T.StructField("score", T.DoubleType())])


def _nearest_in_group(k: int, dim: int, tables: int, parts: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """``left``: rows, ``right``: queries of the same block; each query's k nearest of those
        rows of it that lie in a probed bucket."""
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if left.num_rows and right.num_rows:
            rows, queries = (_matrix(t.column("embedding").combine_chunks()) for t in (left, right))
            ids, asked = (t.column("vec_id").to_numpy() for t in (left, right))
            table, all_rows, all_ids = left.column("table")[0].as_py(), rows, ids
            several = parts > 1 and table >= 0
            if several:
                rest, inverse = np.unique(left.column("rest").to_numpy(), return_inverse=True)
                least = right.column("least").to_numpy()
            for i, (q, vector) in enumerate(zip(asked, queries)):
                if several:
                    adds = _hashes(dim, tables, parts).rest_scores(_unit(vector[None]), table, rest)[0]
                    met = (adds >= least[i])[inverse]
                    rows, ids = all_rows[met], all_ids[met]
                    if not len(ids):
                        continue
                distance = np.sqrt(np.square(rows - vector).sum(axis=1))
                distance[ids == q] = np.nan
                some = min(k, len(ids))
                edge = np.partition(distance, some - 1)[some - 1]
                near = np.flatnonzero(~np.isnan(distance) if np.isnan(edge) else distance <= edge)
                near = near[np.lexsort((ids[near], distance[near]))][:k]
                out.append((np.full(len(near), q), ids[near], distance[near]))
        found = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        return pa.table({"query_id": pa.array(found[0], pa.int64()), "vec_id": pa.array(found[1], pa.int64()),
                         "score": pa.array(found[2], pa.float64())})

    return run


def _meet(rows: DataFrame, queries: DataFrame, k: int, dim: int, tables: int, parts: int) -> DataFrame:
    """The k nearest rows of each query in every (table, bucket) where they meet, in blocks."""
    key = ["table", "bucket"]
    sizes = rows.groupBy(key).agg(F.count("*").alias("n")).join(
        queries.groupBy(key).agg(F.count("*").alias("m")), key).where(
        (F.col("n") > GROUP_ROWS) | (F.col("m") > GROUP_ROWS)).select(
        *key, F.ceil(F.col("n") / GROUP_ROWS).cast("int").alias("row_blocks"),
        F.ceil(F.col("m") / GROUP_ROWS).cast("int").alias("query_blocks"))
    sizes = write_scratch(sizes, "blocks")

    def blocks(side: DataFrame, own: str, other: str, own_name: str, other_name: str, more: str) -> DataFrame:
        side = side.join(sizes, key, "left")
        return side.select(
            *key, more, "vec_id", "embedding",
            F.pmod(F.xxhash64("vec_id"), F.coalesce(F.col(own), F.lit(1))).cast("int").alias(own_name),
            F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)).alias(other_name))

    left = blocks(rows, "row_blocks", "query_blocks", "row_block", "query_block", "rest")
    right = blocks(queries, "query_blocks", "row_blocks", "query_block", "row_block", "least")
    group = [*key, "row_block", "query_block"]
    return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(
        _nearest_in_group(k, dim, tables, parts), FOUND)


def _usable(embedding: Column) -> Column:
    """True for vectors with only finite components, not all of them zero."""
    return F.coalesce(F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                      & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _parts(n: int, axes: int) -> int:
    """Rotations a hash of ``n`` rows."""
    return max(1, round(math.log(max(1, n / BUCKET_ROWS)) / math.log(axes)))


def _probes(tables: int, probes: int, parts: int, axes: int) -> int:
    """Buckets to look into a table: ``probes`` with one rotation, else so many that a row is
    met in some table with the chance ``SHARE``, and ``probes`` at least."""
    if parts == 1:
        return probes
    return max(probes, math.ceil((1 - (1 - SHARE) ** (1 / tables)) * axes ** parts))


def nearest(embeddings: DataFrame, is_query: Column, k: int = 10, tables: int = TABLES,
            probes: int = PROBES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k nearest rows found for each query row.

    ``embeddings`` has vec_id and embedding; ``is_query`` picks the queries. Null vectors, those
    with null or non-finite components, all zero, or of another length than the commonest take
    no part, nor do rows without a vec_id. Rows with a query's vec_id are not its candidates;
    a repeated row counts once. Nearness is Euclidean distance, ties go to the smaller vec_id.
    A query that finds fewer than k rows in its buckets is held against all rows, in blocks.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"),
                             F.col("embedding").cast("array<double>").alias("embedding"), is_query.alias("_asks"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & _usable(F.col("embedding")))
    sizes = rows.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), F.desc("dim")).limit(1).collect()
    dim, n = (sizes[0]["dim"], sizes[0]["n"]) if sizes else (1, 0)
    rows = rows.where(F.size("embedding") == dim)
    axes = 2 * (1 << max(0, (dim - 1).bit_length()))
    parts = _parts(n, axes)
    probes = _probes(tables, probes, parts, axes)
    queries = rows.where("_asks").groupBy("vec_id", "embedding").agg(F.lit(1)).select("vec_id", "embedding")
    # of equal vectors, only the k + 1 smallest ids can be an answer; the limit also runs before the shuffle
    least = Window.partitionBy("embedding").orderBy("vec_id")
    rows = rows.select("vec_id", "embedding").withColumn("_rank", F.rank().over(least)).where(
        F.col("_rank") <= k + 1).groupBy("vec_id", "embedding").agg(F.lit(1)).select("vec_id", "embedding")
    rows, queries = write_scratch(rows, "vectors"), write_scratch(queries, "queries")

    hashed = dim, tables, parts
    found = write_scratch(_meet(_hashed(rows, tables, parts, dim, None),
                                _hashed(queries, tables, parts, dim, probes), k, *hashed), "found")
    enough = found.groupBy("query_id").agg(F.countDistinct("vec_id").alias("n")).where(F.col("n") >= k)
    short = write_scratch(queries.join(enough, F.col("vec_id") == F.col("query_id"), "left_anti"), "short")
    if not short.isEmpty():
        one = [F.lit(-1).alias("table"), F.lit(0).cast("long").alias("bucket"), "vec_id", "embedding",
               F.lit(0).cast("long").alias("rest"), F.lit(float("-inf")).alias("least")]
        found = found.unionByName(_meet(rows.select(*one), short.select(*one), k, *hashed))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")).withColumn(
        "rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
