"""Threshold-scaled document fingerprints, DataFrame functions only.

A document's sketch is every hash of its word shingles that lies below a fixed fraction of the
hash space. Sketches of any two documents use the same threshold, so they merge by union, and
the share of one sketch found in another estimates containment however unequal the documents.
A document whose shingles all lie above the threshold has an empty sketch: in its place stands
its smallest hash, which lies above the threshold, tells equal texts from others, drops out of a
merge with a sketch that holds hashes, and is no ground for an estimate of containment.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.common import let

#: Words in a shingle.
SHINGLE = 5
#: One in SCALE hashes is kept.
SCALE = 8
#: Documents in one bucket of neighbouring ids, and about the most buckets there are (their boundary
#: rows, three numbers each, are broadcast); ids sampled for each cut between buckets.
BUCKET_DOCS = 32
MAX_BUCKETS = 100_000
CUT_ROWS = 16

_LOWEST = -(1 << 63)


def _limit(scale: int) -> Column:
    return F.lit(_LOWEST + (1 << 64) // scale)


def sketch(text: Column, shingle: int = SHINGLE, scale: int = SCALE) -> Column:
    """Sorted distinct shingle hashes below the threshold (array of long) of a text.

    Words are runs of characters other than ASCII white space, lower-cased. A text with fewer
    words than a shingle has one shingle of all its words; null and wordless texts have the
    shingle of no words, so their sketches are equal.
    """
    limit = _limit(scale)
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[ \t\n\x0B\f\r]+"), lambda w: w != "")

    def shingles(hashes: Column) -> Column:
        whole = F.array(F.xxhash64(F.array_join(F.transform(hashes, lambda h: h.cast("string")), " ")))
        runs = F.transform(F.sequence(F.lit(0), F.size(hashes) - shingle),
                           lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(shingle))))
        return F.when(F.size(hashes) < shingle, whole).otherwise(runs)

    def kept(all_hashes: Column) -> Column:
        low = F.filter(all_hashes, lambda h: h < limit)
        return let(low, lambda a: F.when(F.size(a) > 0, F.array_sort(F.array_distinct(a)))
                   .otherwise(F.array(F.array_min(all_hashes))))

    return let(let(F.transform(words, lambda w: F.xxhash64(w)), shingles), kept)


def jaccard(a: Column, b: Column) -> Column:
    """Shared hashes over all hashes of two sketches (0 to 1)."""
    shared = F.size(F.array_intersect(a, b))
    return let(shared, lambda n: n / (F.size(a) + F.size(b) - n))


def containment(a: Column, b: Column, scale: int = SCALE) -> Column:
    """Share of the hashes of sketch ``a`` that sketch ``b`` holds (0 to 1); null if ``a`` has
    none below the threshold, unless the sketches are equal."""
    shared = F.size(F.array_intersect(a, b)) / F.size(a)
    return F.when((F.get(a, F.lit(0)) < _limit(scale)) | (a == b), shared)


def merge(a: Column, b: Column, scale: int = SCALE) -> Column:
    """The sketch of the union of two documents' shingles."""
    both = F.array_sort(F.array_union(a, b))
    return let(both, lambda u: F.when(F.get(u, F.lit(0)) < _limit(scale), F.filter(u, lambda h: h < _limit(scale)))
               .otherwise(F.slice(u, 1, 1)))


def as_text(sketched: Column) -> Column:
    """A sketch as text: its hashes in hexadecimal, comma-joined."""
    return F.array_join(F.transform(sketched, lambda h: F.lower(F.hex(h))), ",")


def _numbers(values: list[int]) -> Column:
    """A constant array of longs; one string of text is folded far faster than as many literals."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def neighbours(ids: DataFrame, key: str, tie: str) -> Column:
    """The bucket of a row of ``ids`` (key: long, tie: hash): rows in order of (key, falling tie),
    null keys first, cut into runs of some ``BUCKET_DOCS`` rows, at most about ``MAX_BUCKETS``.

    The cuts are quantiles of a sample of the keys, so far-off keys crowd nothing; a key that holds
    several quantiles, or null, is cut at even steps of the tie. Cuts decide where rows meet, not
    what is found.
    """
    size, known = ids.agg(F.count("*"), F.count(key)).first()
    buckets = max(1, min(MAX_BUCKETS, size // BUCKET_DOCS))
    share = min(1.0, CUT_ROWS * buckets / max(size, 1))
    cuts = ids.where(F.col(key).isNotNull()).sample(share, seed=3).agg(
        F.filter(F.sort_array(F.collect_list(key)), lambda _, i: i % CUT_ROWS == CUT_ROWS - 1)).first()[0]
    runs = {_LOWEST: 1}  # first key of a run of keys, and the buckets it is cut into
    for cut in cuts:
        runs[cut] = runs.get(cut, 0) + 1
    for cut, parts in list(runs.items()):
        if parts > 1 and cut < -_LOWEST - 1:
            runs.setdefault(cut + 1, 1)  # the keys after a hot one
    firsts = sorted(runs)
    nulls = max(1, (size - known) * buckets // max(size, 1))
    begins = [0, *accumulate([nulls, *(runs[k] for k in firsts)])]  # the null keys' run comes before all
    table, offsets = _numbers(firsts), _numbers(begins)

    def halve(at: Column, step: Column) -> Column:
        return F.when(F.get(table, (at + step).cast("int")) <= F.col(key), at + step).otherwise(at)

    steps = _numbers([1 << k for k in reversed(range(len(firsts).bit_length()))])
    run = F.when(F.col(key).isNull(), F.lit(0).cast("long")).otherwise(
        F.aggregate(steps, F.lit(0).cast("long"), halve) + 1)

    def place(at: Column) -> Column:
        begin, end = F.get(offsets, at.cast("int")), F.get(offsets, (at + 1).cast("int"))
        top = F.shiftrightunsigned(F.col(tie).bitwiseXOR(F.lit(-1 - _LOWEST)), 33)  # the larger the smaller the tie
        return begin + F.shiftright(top * (end - begin), 31)

    return let(run, place)


def with_next(docs: DataFrame, carried: list[str], key: str = "doc_id", tie: str = "_tie") -> DataFrame:
    """``docs`` (key: long, tie: hash, carried columns) with ``next_<column>`` of the next row in
    descending ``key`` order (null last, equal keys by ``tie``); the last row's next is the first.

    Rows are dealt to buckets of neighbours. The first row of each bucket goes to the bucket before
    it as well, as its closing row, so each bucket finds its successors alone. Rows equal in key and
    tie stay together.
    """
    ids = docs.select(key, tie)
    bucket = neighbours(ids, key, tie)
    # the first row of each bucket, and the next higher bucket that has rows (the lowest bucket for the highest)
    first = F.max(F.struct(F.col(key), F.bitwise_not(tie).alias("tie")))
    heads = ids.groupBy(bucket.alias("bucket")).agg(first.alias("head")).collect()
    order = sorted((r["bucket"], r["head"][0], ~r["head"]["tie"]) for r in heads)
    above = [(order[(i + 1) % len(order)][0], *head) for i, (_, *head) in enumerate(order)]
    edges = docs.sparkSession.createDataFrame(above, "also long, head long, head_tie long")
    rows = docs.withColumn("_bucket", bucket).join(
        F.broadcast(edges), F.col(key).eqNullSafe(F.col("head")) & (F.col(tie) == F.col("head_tie")), "left")
    places = F.array_compact(F.array(
        F.struct(F.col("_bucket").alias("bucket"), F.lit(False).alias("closing")),
        F.when(F.col("also").isNotNull(), F.struct(F.col("also").alias("bucket"), F.lit(True).alias("closing")))))
    rows = rows.withColumn("_place", F.explode(places)).select(
        key, tie, *carried, "_place.bucket", "_place.closing")
    order_in = Window.partitionBy("bucket").orderBy("closing", F.desc_nulls_last(key), tie)
    return rows.select("*", *(F.lead(c).over(order_in).alias(f"next_{c}") for c in carried)).where(
        ~F.col("closing")).drop("bucket", "closing", tie)


def compare_edited(docs: DataFrame) -> DataFrame:
    """Every text's fingerprint beside that of its edited text (the last half of its characters
    replaced by the first as many of the next document's) and that of the next document.

    Null texts count as empty, also as neighbours. Rows with the same doc_id follow each other
    by a hash of their text; a single row is its own next one. Texts of any length are read whole,
    other columns are passed over, an empty table has no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("_tie"), "text", sketch(F.col("text")).alias("print"))
    rows = with_next(rows, ["text", "print"])
    n = F.length("text")
    edited = F.concat(F.expr("substring(text, 1, int(length(text) - length(text) div 2))"),
                      F.expr("substring(next_text, 1, int(length(text) div 2))"))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "print", "next_print")
    rows = rows.select("*", sketch(F.col("edited")).alias("edited_print"))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("print")).alias("fingerprint"), as_text(F.col("edited_print")).alias("edited_fingerprint"),
        jaccard(F.col("print"), F.col("edited_print")).alias("near_edited"),
        jaccard(F.col("print"), F.col("next_print")).alias("near_next"),
        containment(F.col("print"), F.col("edited_print")).alias("edited_containment"))
