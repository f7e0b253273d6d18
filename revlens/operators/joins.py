"""Join helpers: broadcast only with a proven bound, salt hot keys before a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest table broadcast on a proven row bound (rows, not bytes: the tables broadcast here
# are narrow -- a key and one or two numbers).
DEFAULT_BROADCAST_ROWS = 2_000_000
# Rows of one key that a reducer gets in a salted join.
ROWS_PER_SALT = 1_000_000


def broadcast_if_bounded(small: DataFrame, bound: int | None,
                         max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when ``bound`` (a proven upper bound on rows) is at most ``max_rows``.

    ``bound`` comes from the construction of the table (hashed features: buckets x classes,
    a one-row aggregate: 1), never from a guess. Without a bound the plan is left to the
    optimizer and adaptive execution.
    """
    if bound is not None and bound <= max_rows:
        return F.broadcast(small)
    return small


def salted_join(big: DataFrame, small: DataFrame, key: str, weights: DataFrame, weight: str,
                how: str = "inner", rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Shuffled join of ``big`` to ``small`` (one row per key) in one pass over ``big``, with
    each key spread over as many reducers as its ``weight`` asks for.

    ``weights (key, weight)`` tells about how many rows of ``big`` a key has (its document
    frequency, say). A key above ``rows_per_salt`` gets ``weight / rows_per_salt`` salts: a row
    of ``big`` takes one by a hash of the whole row, and the row of ``small`` is copied once per
    salt. There are at most total weight / rows_per_salt such keys and copies. Other keys keep
    salt 0, so every pair comes out exactly once, for inner and left joins alike.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    hot = weights.filter(F.col(weight) > rows_per_salt).select(
        key, F.ceil(F.col(weight) / rows_per_salt).cast("int").alias("_salts"))
    b = (big.join(hot, key, "left")
         .withColumn("_salt", F.when(F.col("_salts").isNotNull(), F.pmod(
             F.xxhash64(*[F.col(c) for c in big.columns]), F.col("_salts")).cast("int")).otherwise(F.lit(0)))
         .drop("_salts"))
    s = (small.join(hot, key, "left")
         .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
         .drop("_salts"))
    return b.join(s, [key, "_salt"], how).drop("_salt")
