"""Sampling: exact class balancing, repeatable splits, first rows, zip by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.functions.hashing import row_hash
from revlens.operators.clean import with_once

# The reference's split is 60 % / 40 % with seed 1234 (Scala, Java) or 0 (Python).
TRAIN_FRACTION = 0.6
REFERENCE_SEED = 1234


def _hex_threshold(fraction: float, digits: int = 8) -> str:
    """Lower-case hex string t with: first ``digits`` hex digits of a hash < t  <=>  u < fraction."""
    return format(int(fraction * 16 ** digits), f"0{digits}x")


def balance(labelled: DataFrame, positive_label: int = 1, key: str = "doc_id",
            label_col: str = "label", salt: str = "balance", bucket_digits: int = 4) -> DataFrame:
    """Down-sample the positive class to the size of all other rows, exactly and lazily.

    The kept positives are the first n (= number of other rows) in the order of
    ``(md5(salt || key), key)``; when there are fewer than n positives all are kept, as
    ``take(n)`` does. Nothing reaches the driver, there is no global sort, and no review text
    is shuffled:

    1. positives are bucketed by the first ``bucket_digits`` hex digits of their hash
       (16**digits buckets, uniform whatever the keys look like); one narrow aggregate counts
       the rows per bucket, negatives as one extra group; the bucket counts (<= 16**digits
       rows) get a running sum -- the only single-partition step, bounded by the bucket count;
    2. only the one boundary bucket is ranked, on (hash, key) alone, which gives the last kept
       (hash, key);
    3. buckets and that last pair are one scalar subquery, and keeping is a filter.
    """
    is_pos = F.col(label_col) == positive_label
    # the hash is computed once per row (a one-element generator) and then cut to a bucket
    narrow = with_once(labelled.select(key, label_col), [key], F.when(is_pos, row_hash(salt, F.col(key))), "_h")
    narrow = narrow.withColumn("_b", F.substring("_h", 1, bucket_digits))
    stats = narrow.groupBy("_b").agg(F.count(F.lit(1)).alias("_c"))
    # one pass over the <= 16**digits + 1 stat rows gives both n (the negatives' group,
    # _b null) and the running count of positives over the buckets in hash order
    everything = Window.partitionBy()
    running = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_neg = F.col("_b").isNull()
    plan = (stats.select("_b", "_c",
                         F.sum(F.when(is_neg, F.col("_c")).otherwise(F.lit(0))).over(everything)
                         .alias("_n"),
                         F.sum(F.when(is_neg, F.lit(0)).otherwise(F.col("_c"))).over(running)
                         .alias("_cum"))
            .filter(~is_neg)
            .select("_b", "_c",
                    F.least(F.col("_c"),
                            F.greatest(F.col("_n") - (F.col("_cum") - F.col("_c")),
                                       F.lit(0))).alias("_take")))
    partial = plan.filter((F.col("_take") > 0) & (F.col("_take") < F.col("_c"))).select("_b", "_take")
    last = (narrow.join(F.broadcast(partial), "_b")
            .withColumn("_rn", F.row_number().over(Window.partitionBy("_b").orderBy("_h", key)))
            .filter(F.col("_rn") == F.col("_take")).select("_b", F.struct("_h", key).alias("_last")))
    whole = plan.filter(F.col("_take") == F.col("_c"))
    cut = (whole.select(F.col("_b").alias("_whole"), F.lit(None).cast("string").alias("_b"),
                        F.lit(None).cast(last.schema["_last"].dataType).alias("_last"))
           .unionByName(last.withColumn("_whole", F.lit(None).cast("string"))))
    cut = cut.agg(F.struct(F.max("_whole").alias("whole"), F.max("_b").alias("b"), F.max("_last").alias("last"))).scalar()
    hashed = with_once(labelled, labelled.columns, F.when(is_pos, row_hash(salt, F.col(key))), "_h")
    bucket = F.substring("_h", 1, bucket_digits)
    in_whole = F.coalesce(bucket <= cut["whole"], F.lit(False))
    in_last = F.coalesce((bucket == cut["b"]) & (F.struct("_h", key) <= cut["last"]), F.lit(False))
    return hashed.filter(F.col("_h").isNull() | in_whole | in_last).select(*labelled.columns)


def hash_split(df: DataFrame, key: str = "doc_id", train_fraction: float = TRAIN_FRACTION,
               seed: int = REFERENCE_SEED, out_col: str = "split") -> DataFrame:
    """Add ``split`` = 'train' / 'test' from md5(seed || key): repeatable, engine-independent.

    ``randomSplit`` depends on partitioning and row order inside partitions, so the same
    rows can land in different halves after a repartition or a retried stage; a hash of the
    key does not. One projection, no shuffle.
    """
    h = row_hash(f"split:{seed}:", F.col(key))
    return df.withColumn(out_col, F.when(F.substring(h, 1, 8) < _hex_threshold(train_fraction),
                                         F.lit("train")).otherwise(F.lit("test")))


def random_split(df: DataFrame, train_fraction: float = TRAIN_FRACTION,
                 seed: int = REFERENCE_SEED) -> list[DataFrame]:
    """Spark's own ``randomSplit`` with the reference's weights and seed, for parity runs."""
    return df.randomSplit([train_fraction, 1.0 - train_fraction], seed)


def first_rows(df: DataFrame, n: int, order_key: str = "doc_id") -> DataFrame:
    """First ``n`` rows in key order (a repeatable ``take(n)``): top-n per task, then merged."""
    return df.orderBy(order_key).limit(n)


def zip_by_key(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Pair the rows of two tables that describe the same keys, failing on a mismatch.

    Positional ``zip`` needs equal partitioning and counts; a full outer equi-join on an
    explicit key gives the same pairs at any partitioning, and ``raise_error`` fails the job
    when a key is on one side only, as ``zip`` fails on unequal counts.
    """
    other = [c for c in b.columns if c != key]
    j = a.withColumn("_a", F.lit(True)).join(b.withColumn("_b", F.lit(True)), key, "full")
    ok = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    check = F.when(ok, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("zip_by_key: key on one side only: "),
                               F.col(key).cast("string"))))
    return j.filter(check).select(key, *[c for c in a.columns if c != key], *other)
