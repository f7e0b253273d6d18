"""Hashing expressions: feature buckets and repeatable per-row random keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reference hashes terms into 2^18 = 262,144 buckets with the
# DataFrame HashingTF (Spark SQL murmur3 ``hash``, seed 42); the RDD HashingTF
# default is 2^20 buckets.
REFERENCE_NUM_FEATURES = 1 << 18
RDD_DEFAULT_NUM_FEATURES = 1 << 20


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def murmur_bucket(term: str | Column, num_features: int = REFERENCE_NUM_FEATURES) -> Column:
    """Bucket of a term as the reference computed it: ``pmod(hash(term), n)``."""
    return F.pmod(F.hash(_col(term)), F.lit(num_features))


def md5_bucket(term: str | Column, hex_digits: int = 4) -> Column:
    """Bucket from the first ``hex_digits`` hex digits of md5(term): 16**hex_digits buckets.

    Portable: any SQL engine with md5 computes the same bucket.
    """
    return F.conv(F.substring(F.md5(_col(term)), 1, hex_digits), 16, 10).cast("int")


def md5_num_features(hex_digits: int = 4) -> int:
    return 16 ** hex_digits


def row_hash(salt: str, key: str | Column) -> Column:
    """Repeatable pseudo-random hex key of a row: md5(salt || key).

    Unlike ``rand(seed)`` it does not depend on partitioning or task order, so a sample or
    split is the same after a repartition, a retry or on another engine.
    """
    return F.md5(F.concat(F.lit(salt), _col(key).cast("string")))
