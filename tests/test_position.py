"""Rows in file order over many part files, and review files read against a schema."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.operators.clean import parse_lines
from revlens.sources.checked import FIELDS, HEADER, RATING, REVIEW, BadLine, check_schema, checked_lines, read_reviews
from revlens.sources.position import first_rows_of_files, with_position, zip_by_position
from revlens.sources.text import read_lines


@pytest.fixture()
def small_blocks(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def _write(folder, files):
    os.makedirs(folder)
    for name, lines in files.items():
        with open(os.path.join(folder, name), "w") as f:
            f.writelines(line + "\n" for line in lines)
    return folder


def test_lines_of_many_files_in_order(spark, tmp_dir, small_blocks):
    files = {f"part-{k}": [f"{k}:{i}:" + "x" * (i % 37) for i in range(n)]
             for k, n in enumerate((300, 0, 1, 120, 7))}
    scan = read_lines(spark, _write(os.path.join(tmp_dir, "lines"), files))
    assert scan.rdd.getNumPartitions() > 10
    want = [line for name in sorted(files) for line in files[name]]
    got = sorted((r.position, r.value) for r in with_position(scan).collect())
    assert got == list(enumerate(want))
    first = sorted((r.position, r.value) for r in first_rows_of_files(scan, 305).collect())
    assert first == list(enumerate(want))[:305]


def test_parquet_rows_in_order(spark, tmp_dir):
    path = os.path.join(tmp_dir, "rows")
    spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), "id").repartition(9, "v").write.parquet(path)
    scan = spark.read.parquet(path)
    want = []
    for name in sorted(f for f in os.listdir(path) if f.endswith(".parquet")):
        want += [r.id for r in spark.read.parquet(os.path.join(path, name)).coalesce(1).collect()]
    assert [r.id for r in sorted(with_position(scan.select("id")).collect(), key=lambda r: r.position)] == want
    assert first_rows_of_files(scan, 5000).count() == 1000
    assert first_rows_of_files(scan, 0).count() == 0
    with pytest.raises(ValueError):
        first_rows_of_files(scan, -1)
    first = first_rows_of_files(scan, 3)
    os.remove(os.path.join(path, max(f for f in os.listdir(path) if f.endswith(".parquet"))))  # is not read
    assert {(r.position, r.id) for r in first.collect()} == set(enumerate(want[:3]))


def test_zip_by_place(spark, tmp_dir):
    a, b, c = (os.path.join(tmp_dir, x) for x in "abc")
    spark.range(100).repartition(7).write.parquet(a)
    spark.range(100).select((F.col("id") * 2).alias("twice")).repartition(3).write.parquet(b)
    spark.range(99).select(F.col("id").alias("other")).write.parquet(c)
    left, right, short = (with_position(spark.read.parquet(x)) for x in (a, b, c))
    rows = zip_by_position(left, right).collect()
    assert sorted(r.id for r in rows) == list(range(100)) and sorted(r.twice for r in rows) == list(range(0, 200, 2))
    with pytest.raises(Exception, match="one side has no row at 99"):
        zip_by_position(left, short).collect()
    with pytest.raises(ValueError, match="id"):
        zip_by_position(left, left)


LINES = ["Rating\tReview", "5\t好", "x\tbad", "", "4\ta\tb", "3\tc\t\t", "99999999999\tlong", "2", " 1\tblank"]


def test_bad_lines_are_kept_aside(spark, tmp_dir, small_blocks):
    many = [f"{i % 5 + 1}\treview {i}" for i in range(200)]
    folder = _write(os.path.join(tmp_dir, "reviews"), {"a": many + LINES, "b": LINES[2:3]})
    got = read_reviews(spark, folder)
    assert got.rows.schema == REVIEW
    assert sorted((r.rating, r.document) for r in got.rows.collect()) == sorted(
        [(i % 5 + 1, f"review {i}") for i in range(200)] + [(5, "好"), (3, "c")])
    assert sorted((os.path.basename(r.file), r.line, r.reason, r.text) for r in got.rejects.collect()) == [
        ("a", 201, HEADER, LINES[0]), ("a", 203, RATING, LINES[2]), ("a", 204, FIELDS, ""), ("a", 205, FIELDS, LINES[4]),
        ("a", 207, RATING, LINES[6]), ("a", 208, FIELDS, "2"), ("a", 209, RATING, LINES[8]), ("b", 1, RATING, LINES[2])]
    # the ratings put aside are those the lenient reading makes null
    lines = read_lines(spark, folder).withColumnRenamed("value", "line")
    assert got.rejects.filter(F.col("reason") == RATING).count() == parse_lines(lines).filter("rating IS NULL").count()
    with pytest.raises(BadLine, match="a, line 203: rating"):
        read_reviews(spark, folder, strict=True)


def test_strict_takes_clean_files_and_gbk(spark, tmp_dir):
    folder = _write(os.path.join(tmp_dir, "good"), {"a": ["Rating\tReview", "5\tx"], "b": []})
    assert read_reviews(spark, folder, strict=True).rows.count() == 1
    path = os.path.join(tmp_dir, "gbk")
    with open(path, "wb") as f:
        f.write("4\t服务员态度\n差\n".encode("gbk"))
    got = read_reviews(spark, path, charset="GBK")
    assert [tuple(r) for r in got.rows.collect()] == [(4, "服务员态度")]
    assert [(r.line, r.text) for r in got.rejects.collect()] == [(2, "差")]
    with pytest.raises(BadLine, match="line 2: not two"):
        read_reviews(spark, path, charset="GBK", strict=True)


def test_readings_nulls_and_schema(spark):
    lines = spark.createDataFrame([(1, "5\tx"), (1, "5\tx"), (2, None), (3, "Rating\tx"), (4, " 1\tx"), (5, "1\tx\t")],
                                  "doc_id int, line string")
    jvm = sorted((r.doc_id, r.reason or "") for r in checked_lines(lines).collect())
    assert jvm == [(1, ""), (1, ""), (2, "null line"), (3, HEADER), (4, RATING), (5, "")]
    python = sorted((r.doc_id, r.reason or "") for r in checked_lines(lines, "python").collect())
    assert python == [(1, ""), (1, ""), (2, "null line"), (3, RATING), (4, ""), (5, FIELDS)]
    rows = spark.createDataFrame([("x", 5, 1)], "document string, rating int, more int")
    assert check_schema(rows, REVIEW).columns == ["rating", "document"]
    with pytest.raises(ValueError, match="rating: string, not int; document: missing"):
        check_schema(spark.createDataFrame([("5",)], "rating string"), REVIEW)
    strict = T.StructType([T.StructField("rating", T.IntegerType(), False)])
    with pytest.raises(ValueError, match="may be null"):
        check_schema(rows, strict)
