"""Balancing, splitting, first rows, zip: exactness and repeatability properties."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from revlens.functions.hashing import row_hash
from revlens.operators.sample import balance, first_rows, hash_split, zip_by_key


def _labelled(spark, n_pos, n_neg):
    rows = [(i, 1, f"p{i}") for i in range(n_pos)] + [(1000 + i, 0, f"n{i}") for i in range(n_neg)]
    return spark.createDataFrame(rows, "doc_id long, label int, document string")


def _counts(df):
    return {r.label: r["count"] for r in df.groupBy("label").count().collect()}


def test_balance_cuts_positives(spark):
    assert _counts(balance(_labelled(spark, 5, 3))) == {1: 3, 0: 3}


def test_balance_keeps_all_when_short(spark):
    assert _counts(balance(_labelled(spark, 2, 3))) == {1: 2, 0: 3}


def test_balance_no_negatives(spark):
    assert _counts(balance(_labelled(spark, 4, 0))) == {}


@pytest.mark.parametrize("n_pos,n_neg,digits", [(3000, 777, 2), (3000, 1234, 4), (500, 20, 1)])
def test_balance_equals_row_number_oracle(spark, n_pos, n_neg, digits):
    df = _labelled(spark, n_pos, n_neg)
    got = balance(df.repartition(7), bucket_digits=digits).filter("label = 1")
    w = Window.orderBy(row_hash("balance", F.col("doc_id")), "doc_id")
    want = (df.filter("label = 1").withColumn("rn", F.row_number().over(w))
            .filter(F.col("rn") <= n_neg).select("doc_id"))
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in want.collect())


def test_hash_split_disjoint_complete_stable(spark):
    df = spark.range(5000).withColumnRenamed("id", "doc_id")
    a = {(r.doc_id, r.split) for r in hash_split(df).collect()}
    b = {(r.doc_id, r.split) for r in hash_split(df.repartition(7)).collect()}
    assert a == b and len(a) == 5000
    train = sum(1 for _, s in a if s == "train")
    assert 0.57 < train / 5000 < 0.63


def test_first_rows(spark):
    df = spark.range(100).withColumnRenamed("id", "doc_id").repartition(5)
    assert [r.doc_id for r in first_rows(df, 10).collect()] == list(range(10))


def test_zip_by_key(spark):
    a = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, label int")
    b = spark.createDataFrame([(1, 5), (2, 7)], "doc_id long, n long")
    assert sorted(tuple(r) for r in zip_by_key(a, b, "doc_id").collect()) == [(1, 0, 5), (2, 1, 7)]
    c = spark.createDataFrame([(1, 5)], "doc_id long, n long")
    with pytest.raises(Exception):
        zip_by_key(a, c, "doc_id").collect()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, how):
    from revlens.operators.joins import salted_join
    big = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 7}", i * 1.0) for i in range(300)]
                                + [(999, "missing", 0.0)], "doc_id long, term string, x double")
    small = spark.createDataFrame([("hot", 1.5)] + [(f"k{i}", float(i)) for i in range(7)],
                                  "term string, idf double")
    weights = big.groupBy("term").count()
    got = sorted(tuple(r) for r in salted_join(big, small, "term", weights, "count", how, rows_per_salt=20)
                 .select("doc_id", "term", "x", "idf").collect())
    want = sorted(tuple(r) for r in big.join(small, "term", how)
                  .select("doc_id", "term", "x", "idf").collect())
    assert got == want


def test_first_rows_below_the_row_count(spark):
    from revlens.operators.sample import first_rows
    df = spark.range(50).select((49 - F.col("id")).alias("doc_id")).repartition(5)
    assert [r.doc_id for r in first_rows(df, 7).collect()] == list(range(7))


@pytest.mark.parametrize("n_neg,n_pos", [(0, 9), (40, 100), (100, 40), (99, 100), (0, 0)])
def test_balance_cuts_where_the_order_says(spark, n_neg, n_pos):
    import hashlib
    rows = [(i, 0, "n") for i in range(n_neg)] + [(1000 + i, 1, "p") for i in range(n_pos)]
    df = spark.createDataFrame(rows, "doc_id long, label int, document string")
    order = sorted(range(1000, 1000 + n_pos), key=lambda k: (hashlib.md5(f"balance{k}".encode()).hexdigest(), k))
    want = sorted([*range(n_neg), *order[:n_neg]])
    for digits in (1, 4):
        assert sorted(r.doc_id for r in balance(df, bucket_digits=digits).collect()) == want


def test_binary_4neg_with_a_real_cut(spark):
    from revlens.operators.label import labelled_reviews
    lines = [(i, f"{1 + i % 4}\tbad {i}") for i in range(10)] + [(100 + i, f"5\tgood {i}") for i in range(30)]
    lines += [(200, "5\tgood 0"), (201, "1\tbad 0")]
    lab = labelled_reviews(spark.createDataFrame(lines, "doc_id long, line string"), "binary_4neg")
    kept = balance(lab).groupBy("label").count().collect()
    assert {r.label: r["count"] for r in kept} == {0: 10, 1: 10}


def test_random_split_shares(spark):
    from revlens.operators.sample import random_split
    a, b = random_split(spark.range(5000), seed=1)
    assert a.count() + b.count() == 5000 and abs(a.count() / 5000 - 0.6) < 0.05
