"""Text expressions: tokens, stop words, slash re-split, Latin parts, Chinese numerals."""

from pyspark.sql import functions as F

from revlens.functions import text as T


def one(spark, expr, value, type_="string"):
    return spark.createDataFrame([(value,)], f"v {type_}").select(expr("v").alias("o")).first().o


def test_stop_words_full_removal(spark):
    # the reference removed while iterating and kept one 的; every stop word goes here
    assert one(spark, T.remove_stop_words, ["的", "的", "好"], "array<string>") == ["好"]
    assert len(T.STOP_WORDS) == 19


def test_slash_rejoin(spark):
    assert one(spark, T.slash_rejoin, ["a/b", "c"], "array<string>") == ["a", "b", "c"]


def test_words_and_marks(spark):
    assert one(spark, T.words, "Héllo, Wörld 42x") == ["héllo", "wörld", "42", "x"]
    assert one(spark, T.words_and_marks, "a, b!") == ["a", ",", "b", "!"]


def test_latin_parts(spark):
    assert one(spark, T.latin_parts, "abc123x9") == ["abc", "123"]
    assert one(spark, T.with_latin_parts, ["ab12", "cd"], "array<string>") == ["ab12", "cd", "ab", "12"]


def test_cn_numerals(spark):
    cases = {"三万": 30000, "三万五千": 35000, "十五": 15, "一百零五": 105, "一亿三千万": 130000000,
             "两千": 2000, "二零二三": 2023, "好吃": None, "十万": 100000}
    for k, v in cases.items():
        assert one(spark, T.cn_numeral_to_arabic, k) == v, k


def test_words_keep_marks(spark):
    got = one(spark, T.words_keep_marks, "Pi is 3.14, mail a@b.com. C++ & R&D!")
    assert got == ["pi", "is", "3.14", "mail", "a@b.com", "c", "r&d"]


def test_cn_numerals_beyond_64_bits_are_null(spark):
    for token in ("九" * 20, "一亿亿亿", "九千亿亿"):
        assert one(spark, T.cn_numeral_to_arabic, token) is None, token
    assert one(spark, T.cn_numeral_to_arabic, "九" * 18) == int("9" * 18)


def test_numerals_in_running_text(spark):
    rows = {"花了三百二十元": "花了320元", "二零二三年十二月一起去": "2023年12月一起去", "十分好": "十分好", "千万别来": "千万别来",
            "两千万\n三十": "20000000\n30", "": "", "abc 12": "abc 12", "九" * 30: "九" * 30, "三万零五百六": "30506"}
    df = spark.createDataFrame([*enumerate(rows), (99, None)], "i int, t string")
    got = {r.t: r.v for r in df.select("t", T.cn_numerals_in_text("t").alias("v")).collect()}
    assert got == {**rows, None: None}
