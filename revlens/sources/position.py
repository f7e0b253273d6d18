"""Rows in file order: where a row stands in its files, without sorting them.

The files of a scan follow each other by path, the rows of a file as they stand in it. Rows are
counted for each file or block alone, a running sum over those few counts gives each its start, and
a row's position is that start plus its place within.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.operators.joins import DEFAULT_BROADCAST_ROWS, broadcast_if_bounded
from revlens.session import materialize

POSITION = "position"
#: Most rows that ``first_rows_of_files`` takes: it names the files that hold them in a filter.
MAX_FIRST = 100_000


def placed(scan: DataFrame) -> DataFrame:
    """``scan`` (a table just read from files) with ``_file``, ``_block`` and ``_place``, which orders
    the rows of a block. Parquet tells a row's place in its file. For other formats it is the
    row's number within the reading task, which another run may deal otherwise: write the result
    before it is read twice."""
    known = scan.select("_metadata").schema["_metadata"].dataType.names
    if "row_index" in known:
        block, place = F.lit(0).cast("long"), F.col("_metadata.row_index")
    else:
        block, place = F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    return scan.select("*", F.col("_metadata.file_path").alias("_file"), block.alias("_block"), place.alias("_place"))


def block_starts(rows: DataFrame) -> DataFrame:
    """``(_file, _block, _first, _start, _line)`` of ``placed`` rows: the smallest place of a block, the
    rows before it in all files, and those before it in its own file.

    One row a block is summed up in one task: about 800,000 rows for 100 TB in blocks of 128 MB.
    """
    blocks = rows.groupBy("_file", "_block").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    own = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    return blocks.select("_file", "_block", "_first", F.coalesce(F.sum("_n").over(before), zero).alias("_start"),
                         F.coalesce(F.sum("_n").over(own), zero).alias("_line"))


def with_starts(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """``placed`` rows with the columns of their block; the starts are broadcast if they are few."""
    return rows.join(broadcast_if_bounded(starts, starts.count(), DEFAULT_BROADCAST_ROWS), ["_file", "_block"])


def with_position(scan: DataFrame, name: str = POSITION) -> DataFrame:
    """``scan`` with ``name``: the number of a row in file order, from 0, without gaps.

    ``scan`` is a table as its reader gives it (columns may be left out, rows not). Parquet is read
    twice, the first time without any column; other formats are written once, since the place of
    a row in a task holds for one run only. Empty files count no rows, an empty table has none.
    """
    columns = [c for c in scan.columns]
    rows = placed(scan)
    if "row_index" not in scan.select("_metadata").schema["_metadata"].dataType.names:
        rows = materialize(rows, "placed")
    starts = materialize(block_starts(rows), "starts")
    return with_starts(rows, starts).select(
        *columns, (F.col("_start") + F.col("_place") - F.col("_first")).alias(name))


def first_rows_of_files(scan: DataFrame, n: int, name: str = POSITION) -> DataFrame:
    """The first ``n`` rows in file order with their position, as ``take(n)`` reads them; fewer if
    there are fewer. Nothing is sorted. Of a parquet table the files that hold them alone are
    read (at most ``n``, since only files with rows count); ``n`` is at most ``MAX_FIRST``."""
    if not 0 <= n <= MAX_FIRST:
        raise ValueError(f"first_rows_of_files takes 0 to {MAX_FIRST} rows, not {n}")
    columns = scan.columns
    if "row_index" not in scan.select("_metadata").schema["_metadata"].dataType.names:
        return with_position(scan, name).filter(F.col(name) < n)
    starts = materialize(block_starts(placed(scan)).filter(F.col("_start") < n), "starts")
    files = [r["_file"] for r in starts.select("_file").collect()]
    rows = placed(scan.filter(F.col("_metadata.file_path").isin(files)))
    return with_starts(rows, starts).select(
        *columns, (F.col("_start") + F.col("_place") - F.col("_first")).alias(name)).filter(F.col(name) < n)


def zip_by_position(a: DataFrame, b: DataFrame, name: str = POSITION) -> DataFrame:
    """Pair the rows of two tables (with ``name`` from ``with_position``) that stand at the same place.

    A full join by position, evenly spread whatever the data; a position that one side lacks fails
    the job, as ``zip`` fails on unequal counts. The column names of the two must differ.
    """
    clash = set(a.columns) & set(b.columns) - {name}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    j = a.withColumn("_a", F.lit(True)).join(b.withColumn("_b", F.lit(True)), name, "full")
    paired = F.when(F.col("_a") & F.col("_b"), F.lit(True)).otherwise(F.raise_error(F.concat(
        F.lit("zip_by_position: one side has no row at "), F.col(name).cast("string"))))
    return j.filter(paired).drop("_a", "_b")
