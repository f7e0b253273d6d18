"""Stop words from a table of any size.

A list of at most ``BROADCAST_WORDS`` words and ``BROADCAST_BYTES`` bytes is sent to every task, which
drops its words from the lists of some rows at once: no row is shuffled. A task looks up the rows' words
in the list the other way round, so that beside the list it holds only tables of ``SLICE_WORDS`` words.
A larger list meets, in a join, the different words of every block of rows; a task then drops from a
block's rows the words found for it. The rows are shuffled once, their words never one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.session import materialize, ship_package

BROADCAST_WORDS = 2_000_000
BROADCAST_BYTES = 64_000_000
#: Rows of a block (its power of two) whose different words meet a larger list together.
BLOCK_ROWS_LOG2 = 10
#: Words of the rows that a task handles at once (a longer row is handled by itself).
SLICE_WORDS = 500_000


def drop_listed(lists: pa.ListArray, listed: pa.Array) -> pa.ListArray:
    """The lists without null words and words in ``listed``; null lists stay null."""
    values, parents = lists.flatten(), lists.value_parent_indices().to_numpy()
    # is_in builds a table of its value_set: of the words at hand, never of the whole list
    present = listed.filter(pc.is_in(listed, value_set=values.unique()))
    keep = pc.and_not(pc.is_valid(values), pc.is_in(values, value_set=present))
    left = np.bincount(parents[keep.to_numpy(zero_copy_only=False)], minlength=len(lists))
    ends = pa.array(np.concatenate([[0], np.cumsum(left)]), pa.int32())
    return pa.ListArray.from_arrays(ends, values.filter(keep), mask=lists.is_null())


def _slices(batch: pa.RecordBatch, place: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows that hold at most ``SLICE_WORDS`` words, or in single rows."""
    ends, at = batch.column(place).offsets.to_numpy()[1:], 0
    while at < len(batch):
        begin = int(ends[at - 1]) if at else int(batch.column(place).offsets[0].as_py())
        to = max(at + 1, int(np.searchsorted(ends, begin + SLICE_WORDS, "right")))
        yield batch.slice(at, to - at)
        at = to


def _dropped(batches: Iterator[pa.RecordBatch], place: int, listed: pa.Array) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _slices(batch, place):
            columns = list(part.columns)
            columns[place] = drop_listed(columns[place], listed)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def _sent(docs: DataFrame, words: pa.Array, words_col: str) -> DataFrame:
    spark = docs.sparkSession
    ship_package(spark)
    listed, place = spark.sparkContext.broadcast(words), docs.columns.index(words_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _dropped(batches, place, listed.value)

    return docs.mapInArrow(run, docs.schema)


def _joined(docs: DataFrame, stop: DataFrame, words_col: str) -> DataFrame:
    ship_package(docs.sparkSession)
    block = F.shiftright(F.monotonically_increasing_id(), BLOCK_ROWS_LOG2).alias("_block")
    rows = materialize(docs.select("*", block), "numbered")
    words = rows.select(F.col("_block").alias("_found_in"), F.explode(words_col).alias("word")).distinct()
    found = words.join(stop, "word", "left_semi")
    names, place = docs.columns, docs.columns.index(words_col)

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        listed = found.column("word").combine_chunks().cast(pa.string())
        batches = rows.select(names).to_batches()
        return pa.Table.from_batches(list(_dropped(iter(batches), place, listed)))

    return rows.groupBy("_block").cogroup(found.groupBy("_found_in")).applyInArrow(run, docs.schema)


def remove_stop_words(docs: DataFrame, stop: DataFrame, words_col: str = "words",
                      max_words: int = BROADCAST_WORDS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` with the words of ``stop (word)`` taken out of ``words_col``, order and repeats of the
    others kept, as ``functions.text.remove_stop_words`` does with a short list.

    Null words are dropped, a null list stays null, a list of stop words only becomes empty. Null and
    repeated rows of ``stop`` count once or not at all; an empty one drops nulls alone. Other columns and
    repeated rows are handed on. The list is written and measured first: up to ``max_words`` words and
    ``max_bytes`` bytes it is sent to the tasks, beyond that it is joined, with the same rows.
    """
    stop = materialize(stop.select("word").filter(F.col("word").isNotNull()).distinct(), "stop-words")
    size = stop.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("word")), F.lit(0))).first()
    if size[0] <= max_words and size[1] <= max_bytes:
        words = stop.toArrow().column("word").cast(pa.string()).combine_chunks()
        return _sent(docs, words, words_col)
    return _joined(docs, stop, words_col)
