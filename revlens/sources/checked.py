"""Review files read against a schema, with the lines that break it kept aside.

A line is a rating, a tab and a review. Lines that are not so go to a table of their own with a
reason and the place they stand at, in the same pass over the files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.operators.clean import HEADER_RATING, rating_of, split_fields, with_once
from revlens.session import materialize
from revlens.sources.position import block_starts, placed, with_starts
from revlens.sources.text import read_gbk_lines, read_lines

REVIEW = T.StructType([T.StructField("rating", T.IntegerType()), T.StructField("document", T.StringType())])
#: Why a line is put aside.
NULL, FIELDS, HEADER, RATING = "null line", "not two fields", "header", "rating is no number"


class BadLine(ValueError):
    """A line that a strict reading does not take."""


def check_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema`` in its order. A column that is missing or of another type,
    and one that holds nulls by its schema where ``schema`` allows none, is an error that names
    all of them; other columns are dropped."""
    own = {f.name: f for f in df.schema.fields}
    wrong = [f"{f.name}: missing" if f.name not in own else
             f"{f.name}: {own[f.name].dataType.simpleString()}, not {f.dataType.simpleString()}"
             if own[f.name].dataType != f.dataType else f"{f.name}: may be null"
             for f in schema.fields
             if f.name not in own or own[f.name].dataType != f.dataType or own[f.name].nullable and not f.nullable]
    if wrong:
        raise ValueError("schema: " + "; ".join(wrong))
    return df.select(*schema.names)


def checked_lines(lines: DataFrame, reading: str = "jvm", line_col: str = "line") -> DataFrame:
    """Every line with ``rating``, ``document`` and ``reason`` (null for a good line), its other columns
    handed on. A header is a reason of its own in the ``jvm`` reading. Narrow, no line is lost."""
    keep = [c for c in lines.columns if c != line_col]
    df = with_once(lines, [*keep, line_col], split_fields(F.col(line_col), reading), "_f")
    first = F.get("_f", F.lit(0))
    rating = rating_of(first, reading)
    header = (first == HEADER_RATING) if reading == "jvm" else F.lit(False)
    reason = (F.when(F.col(line_col).isNull(), NULL).when(F.size("_f") != 2, FIELDS).when(header, HEADER)
              .when(rating.isNull(), RATING))
    good = reason.isNull()
    return df.select(*keep, F.when(good, rating).alias("rating"), F.when(good, F.get("_f", F.lit(1))).alias("document"),
                     F.when(~good, F.col(line_col)).alias(line_col), reason.alias("reason"))


@dataclass
class Checked:
    rows: DataFrame       # the columns of REVIEW
    rejects: DataFrame    # file, line (from 1), reason, text


def read_reviews(spark: SparkSession, path: str, reading: str = "jvm", charset: str = "UTF-8",
                 strict: bool = False) -> Checked:
    """The reviews of a file or folder, and the lines that are none.

    The files are read and split once; good and bad lines are written together and told apart by
    ``reason``. The line number of a bad one comes from counts of the written blocks. ``strict``
    raises ``BadLine`` for the first line that is not a review, headers excepted, and names file,
    line and reason. An empty file has neither.
    """
    lines = read_lines(spark, path) if charset.upper() in ("UTF-8", "UTF8") else read_gbk_lines(spark, path, charset)
    found = checked_lines(placed(lines), reading, "value")
    found = materialize(found.withColumn("_bad", F.col("reason").isNotNull()), "checked")
    starts = materialize(block_starts(found), "starts")
    rejects = with_starts(found.filter("_bad"), starts).select(
        F.col("_file").alias("file"), (F.col("_line") + F.col("_place") - F.col("_first") + 1).alias("line"),
        "reason", F.col("value").alias("text"))
    if strict:
        first = rejects.filter(F.col("reason") != HEADER).orderBy("file", "line").first()
        if first is not None:
            raise BadLine(f"{first['file']}, line {first['line']}: {first['reason']}")
    return Checked(check_schema(found.filter(~F.col("_bad")), REVIEW), rejects)
