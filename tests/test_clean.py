"""Parsing edge rows (FIXTURES §4): the two readings of 'two tab fields', header, ratings."""

import pytest
from pyspark.sql import functions as F

from revlens.operators.clean import distinct_lines, extract_reviews, parse_lines

# line, jvm kept, python kept (FIXTURES §4)
EDGE = [
    ("5\tgood", True, True),
    ("5\t", False, True),
    ("\tgood", True, True),
    ("5", False, False),
    ("5\ta\tb", False, False),
    ("5\ta\t", True, False),
    ("Rating\tContent", False, True),
    ("x\tgood", True, True),
    (" 5\tgood", True, True),
    ("4\tok", True, True),
]


def _lines(spark):
    return spark.createDataFrame([(i, l) for i, (l, _, _) in enumerate(EDGE)], "doc_id long, line string")


def test_jvm_reading(spark):
    got = {r.doc_id: r for r in parse_lines(_lines(spark), "jvm").collect()}
    assert set(got) == {i for i, (_, j, _) in enumerate(EDGE) if j}
    assert got[2].rating is None and got[2].rating_txt == ""
    assert got[7].rating is None            # x
    assert got[8].rating is None            # ' 5': Java parseInt does not trim
    assert got[5].document == "a"           # trailing tab dropped
    assert got[0].rating == 5 and got[0].document == "good"


def test_python_reading(spark):
    got = {r.doc_id: r for r in parse_lines(_lines(spark), "python").collect()}
    assert set(got) == {i for i, (_, _, p) in enumerate(EDGE) if p}
    assert got[1].document == ""            # '5\t' keeps the empty review
    assert got[8].rating == 5               # int(' 5') trims
    assert got[6].rating is None            # header kept, rating not a number


def test_strict_rating_fails(spark):
    df = spark.createDataFrame([(0, "x\tgood")], "doc_id long, line string")
    with pytest.raises(Exception):
        parse_lines(df, "jvm", strict=True).collect()


def test_distinct_lines_keeps_smallest_key(spark):
    df = spark.createDataFrame([(3, "5\ta"), (1, "5\ta"), (2, "1\tb")], "doc_id long, line string")
    assert sorted(tuple(r) for r in distinct_lines(df).collect()) == [(1, "5\ta"), (2, "1\tb")]


def _csv(spark, rows):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "doc_id long, value string")


def test_extract_reviews_reference_and_csv(spark):
    rows = [
        "a,b,Rating,d,e,f,g,h,i,j,content_review",       # header
        "1,x,5,d,e,f,g,h,i,j,tasty",                      # normal
        '2,x,4,d,e,f,g,h,i,j,"good, cheap"',              # quoted comma
        "3,x,3,d,e,f,g,h,i,j",                             # 10 columns
        "4,x,1,d,e,f,g,h,i,j,",                            # empty review
    ]
    ref = {r.doc_id: r.line for r in extract_reviews(_csv(spark, rows), keep=["doc_id"]).collect()}
    assert ref == {1: "5\ttasty", 2: '4\t"good'}
    q = {r.doc_id: r.line for r in extract_reviews(_csv(spark, rows), quotes=True,
                                                   keep=["doc_id"]).collect()}
    assert q[2] == "4\tgood, cheap" and q[1] == "5\ttasty" and 0 not in q and 3 not in q


def test_quoted_rows_keep_doubled_quotes(spark):
    rows = ['1,x,5,d,e,f,g,h,i,j,"good ""very"" nice, cheap"']
    got = extract_reviews(_csv(spark, rows), quotes=True, keep=["doc_id"]).collect()
    assert [r.line for r in got] == ['5\tgood "very" nice, cheap']
