"""Raw lines -> reviews(rating, document).

Two readings of "a line with exactly two tab fields" exist in the reference:

* ``jvm``    -- Java/Scala ``split`` drops trailing empty fields, so trailing tabs are stripped
               first (``rtrim``); the header line (rating field ``Rating``) is dropped; a rating parses
               only when it is an optionally signed run of digits (no blanks).
* ``python`` -- Python ``split`` keeps trailing empty fields; the header is not special;
               ``int()`` accepts surrounding blanks.

Ratings are parsed leniently by default (a bad rating becomes null and is not selected by
any label policy). ``strict=True`` casts with ANSI semantics instead, so a bad rating fails
the job the way the reference's strict filters do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEADER_RATING = "Rating"  # fixed value: header text of the rating column


def rating_of(rating_txt: Column, reading: str = "jvm", strict: bool = False) -> Column:
    """A rating field as a number; null for a bad one, unless ``strict``."""
    if strict:
        return rating_txt.cast("int")
    if reading == "jvm":
        return F.when(rating_txt.rlike(r"^[+-]?[0-9]+$"), rating_txt.try_cast("int"))
    return rating_txt.try_cast("int")


def split_fields(line: Column, reading: str = "jvm") -> Column:
    """Tab fields of a line under one of the two readings."""
    if reading == "jvm":
        line = F.rtrim(line, F.lit("\t"))
    elif reading != "python":
        raise ValueError(f"unknown reading {reading!r}")
    return F.split(line, "\t", -1)


def with_once(df: DataFrame, keep: list[str], expr: Column, name: str) -> DataFrame:
    """``keep`` columns plus ``expr`` as ``name``, evaluated once per row.

    A filter on an alias is pushed below the projection with the alias replaced by its
    expression, so an expensive expression (splitting a whole review line) would run once
    in the filter and again in the projection. Produced by a one-element generator it is
    computed once; the generator stays inside the same code-generated stage.
    """
    return df.select(*keep, F.inline(F.array(F.struct(expr.alias(name)))))


def parse_lines(lines: DataFrame, reading: str = "jvm", strict: bool = False,
                drop_header: bool | None = None, line_col: str = "line") -> DataFrame:
    """Keep lines with exactly two tab fields; add ``rating_txt``, ``rating``, ``document``.

    Other columns (a row key such as ``doc_id``) pass through; ``line`` is dropped.
    One narrow stage: split, filter and cast all fuse into whole-stage code.
    """
    if drop_header is None:
        drop_header = reading == "jvm"
    parts = split_fields(F.col(line_col), reading)
    keep = [c for c in lines.columns if c != line_col]
    df = with_once(lines, keep, parts, "_f").filter(F.size("_f") == 2)
    if drop_header:
        df = df.filter(F.col("_f")[0] != HEADER_RATING)
    rating_txt = F.col("_f")[0]
    return df.select(*keep, rating_txt.alias("rating_txt"),
                     rating_of(rating_txt, reading, strict).alias("rating"),
                     F.col("_f")[1].alias("document"))


def distinct_lines(lines: DataFrame, key: str = "doc_id", line_col: str = "line") -> DataFrame:
    """One row per distinct line, keyed by the smallest key among its copies.

    Lines are compared by their SHA-256, so only (digest, key) is shuffled, with map-side
    partial aggregation: a line repeated millions of times leaves each map task as one row.
    The surplus copies' keys are then anti-joined away; ``key`` must be unique.
    """
    # both out of a generator: no condition on the key is pushed below it, so the readers of ``lines`` share its shuffle
    digests = lines.select(F.inline(F.array(F.struct(key, F.sha2(F.col(line_col), 256).alias("_d")))))
    first = digests.groupBy("_d").agg(F.min(key).alias("_first"), F.count(F.lit(1)).alias("_n"))
    repeated = first.filter(F.col("_n") > 1).select("_d", "_first")
    surplus = digests.join(repeated, "_d").filter(F.col(key) != F.col("_first")).select(key)
    return lines.join(surplus, key, "left_anti").select(key, line_col)


def extract_reviews(raw: DataFrame, rating_field: int = 2, review_field: int = 10,
                    quotes: bool = False, value_col: str = "value",
                    keep: list[str] | None = None) -> DataFrame:
    """Comma-separated raw rows -> ``line = rating TAB review`` for rows a later step can read.

    ``quotes=False`` splits on every comma as the reference does (a quoted comma cuts the
    review short); ``quotes=True`` parses the row as CSV. A row too short to hold both
    fields is dropped (the reference fails on it). Rows whose line has other than two tab fields (JVM reading) and the
    header row are dropped.
    """
    keep = keep or []
    v = F.col(value_col)
    if quotes:
        n = max(rating_field, review_field) + 1
        schema = ", ".join(f"c{i} string" for i in range(n))
        rec = F.from_csv(v, schema, {"mode": "PERMISSIVE", "escape": "\""})
        rating, review = rec[f"c{rating_field}"], rec[f"c{review_field}"]
    else:
        fields = F.split(v, ",", -1)
        rating = F.get(fields, F.lit(rating_field))
        review = F.get(fields, F.lit(review_field))
    line = F.concat(rating, F.lit("\t"), review)
    staged = with_once(raw, keep, line, "line")
    return (with_once(staged, keep + ["line"], split_fields(F.col("line"), "jvm"), "_f")
            .filter(F.col("line").isNotNull() & (F.size("_f") == 2)
                    & (F.col("_f")[0] != HEADER_RATING))
            .select(*keep, "line"))
