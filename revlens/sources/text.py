"""Text sources and sinks: UTF-8 lines, GBK lines, word-count TSV, line files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_JAVA_CHARSETS = "spark.sql.legacy.javaCharsets"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """UTF-8 text, a file or a folder of part files: one row ``value`` per line (splittable)."""
    return spark.read.text(path)


def read_gbk_lines(spark: SparkSession, path: str, charset: str = "GBK") -> DataFrame:
    """Lines of a GBK-encoded text file as strings, read in parallel.

    The text scan splits on raw ``\\n`` bytes, which is safe for GBK (a second byte is
    never below 0x40), and keeps the bytes of each line; ``decode`` then turns them into
    strings. Spark 4 accepts GBK in ``decode`` only with ``spark.sql.legacy.javaCharsets``;
    the flag is read when the plan is built, so it is set for the build and restored after.
    """
    conf = spark.conf
    before = conf.get(_JAVA_CHARSETS, None)
    conf.set(_JAVA_CHARSETS, "true")
    try:
        df = spark.read.text(path).select(
            F.decode(F.col("value").cast("binary"), charset).alias("value"))
        df.schema  # force analysis while the flag is on
    finally:
        if before is None:
            conf.unset(_JAVA_CHARSETS)
        else:
            conf.set(_JAVA_CHARSETS, before)
    return df


def read_word_counts(spark: SparkSession, path: str) -> DataFrame:
    """``word<TAB>count`` lines as ``(word string, n bigint)``; quotes are not special."""
    return (spark.read.schema("word string, n bigint")
            .option("sep", "\t").option("quote", "").option("escape", "")
            .csv(path))


def write_lines(df: DataFrame, path: str, column: str = "line", mode: str = "overwrite") -> None:
    """Write one text line per row as a folder of part files."""
    df.select(F.col(column).cast("string").alias("value")).write.mode(mode).text(path)


def write_word_counts(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ``word<TAB>count`` lines (the input of the word-cloud step)."""
    write_lines(df.select(F.concat_ws("\t", "word", F.col("n").cast("string")).alias("line")),
                path, mode=mode)


def preview(df: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` rows, for looking at; a plan, not a driver-side list."""
    return df.limit(n)
