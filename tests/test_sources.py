"""Sources and sinks: GBK lines, word-count TSV, line files (round trips)."""

import os

from revlens.operators.clean import extract_reviews, parse_lines
from revlens.sources.text import (read_gbk_lines, read_lines, read_word_counts, write_lines,
                                  write_word_counts)


def test_gbk_round_trip(spark, tmp_dir):
    rows = ["id,x,Rating,c3,c4,c5,c6,c7,c8,c9,content_review",
            "1,x,5,c,c,c,c,c,c,c,这个价位，这个口味就那样",
            "2,x,1,c,c,c,c,c,c,c,服务员态度差",
            "3,x,4,c,c,c,c,c,c,c,表情|符号\\也行"]   # 表 and 号 have second byte 0x7C / 0x5C
    path = os.path.join(tmp_dir, "comment_data.csv")
    with open(path, "wb") as f:
        f.write(("\n".join(rows) + "\n").encode("gbk"))
    lines = read_gbk_lines(spark, path)
    got = [r.value for r in lines.collect()]
    assert got == rows
    reviews = parse_lines(extract_reviews(lines), "jvm")
    assert sorted((r.rating, r.document) for r in reviews.collect()) == [
        (1, "服务员态度差"), (4, "表情|符号\\也行"), (5, "这个价位，这个口味就那样")]
    # the session flag is restored after the plan is built
    assert spark.conf.get("spark.sql.legacy.javaCharsets", "false") in ("false", None)


def test_line_files_and_word_counts(spark, tmp_dir):
    df = spark.createDataFrame([("好吃", 3), ('"q"', 2)], "word string, n long")
    p = os.path.join(tmp_dir, "wc")
    write_word_counts(df, p)
    back = read_word_counts(spark, p)
    assert sorted(tuple(r) for r in back.collect()) == [('"q"', 2), ("好吃", 3)]
    p2 = os.path.join(tmp_dir, "lines")
    write_lines(spark.createDataFrame([("5\ta",)], "line string"), p2)
    assert [r.value for r in read_lines(spark, p2).collect()] == ["5\ta"]


def test_gbk_lines_survive_file_splits(spark, tmp_dir):
    rows = [f"{i},x,{1 + i % 5},c,c,c,c,c,c,c,第{i}条评论：价格实惠，表情|符号\\也行" for i in range(300)]
    path = os.path.join(tmp_dir, "big.csv")
    with open(path, "wb") as f:
        f.write(("\n".join(rows) + "\n").encode("gbk"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        lines = read_gbk_lines(spark, path)
        assert lines.rdd.getNumPartitions() > 5
        assert sorted(r.value for r in lines.collect()) == sorted(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_preview_is_a_plan_of_the_first_rows(spark):
    from revlens.sources.text import preview
    few = preview(spark.range(0, 100, 1, 7))
    assert few.count() == 3 and {r.id for r in few.collect()} <= set(range(100))
    assert preview(spark.range(2), 5).count() == 2 and preview(spark.range(5), 0).collect() == []
