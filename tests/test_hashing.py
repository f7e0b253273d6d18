"""Goldens G1-G3: the reference's printed hashed term counts and TF-IDF values."""

from revlens.functions.hashing import RDD_DEFAULT_NUM_FEATURES, murmur_bucket
from revlens.operators.features import MURMUR, Hashing, idf, term_counts, tfidf

# Two segmented reviews, their printed hashed counts, and printed TF-IDF values.
G1 = ["这个", "价位", "，", "这个", "口味", "就", "那样", "，", "说不上", "特别", "好吃"]
G1_VEC = {12231: 1, 17078: 1, 37436: 1, 54992: 1, 67849: 1, 85364: 2, 112276: 1, 153025: 2, 154679: 1}
G2 = ["吃完", "会", "感觉", "很", "舒服", "的", "地方", "，", "这个", "季节", "最爱", "炖汤", "和", "滋补", "的",
      "菜式", "，", "朋友", "来", "广州", "首推", "的", "地方", "。"]
G2_IDX = [5224, 12859, 13599, 26081, 30776, 37083, 45248, 52547, 85364, 101376, 132859, 137444,
          140763, 145803, 153025, 167900, 177554, 186651, 217856, 238030]
G2_CNT = [1, 1, 1, 1, 1, 1, 1, 1, 2, 1, 1, 1, 2, 1, 1, 1, 1, 1, 1, 3]
G3_DF = {12231: 56, 17078: 167, 37436: 1, 54992: 147, 67849: 49, 85364: 438, 112276: 6, 153025: 50, 154679: 6}
G3_TFIDF = {12231: 2.1893967487159727, 17078: 1.1084840371472637, 37436: 5.539300835990577,
            54992: 1.2352357427864076, 67849: 2.3204250111223765, 85364: 0.2958972069507029,
            112276: 4.286537867495209, 153025: 4.6012447676523935, 154679: 4.286537867495209}


def _vector(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "w string")
    rows = df.groupBy(murmur_bucket("w").alias("b")).count().collect()
    return {r.b: r["count"] for r in rows}


def test_g1_term_counts(spark):
    assert _vector(spark, G1) == G1_VEC


def test_g2_term_counts(spark):
    assert _vector(spark, G2) == dict(zip(G2_IDX, G2_CNT))


def test_g1_g2_through_term_counts(spark):
    docs = spark.createDataFrame([(1, G1), (2, G2), (3, []), (4, None), (5, [None, "a", "a"])], "doc_id long, words array<string>")
    got = {}
    for r in term_counts(docs, hashing=MURMUR).collect():
        got.setdefault(r.doc_id, {})[r.term] = r.tf
    assert got[1] == G1_VEC and got[2] == dict(zip(G2_IDX, G2_CNT)) and 3 not in got and 4 not in got
    assert list(got[5].values()) == [2]
    wide = {r.term: r.tf for r in term_counts(docs.filter("doc_id = 1"), hashing=Hashing("murmur", RDD_DEFAULT_NUM_FEATURES)).collect()}
    assert sum(wide.values()) == len(G1) and len(wide) == 9 and all(0 <= t < 1 << 20 for t in wide)


def test_g3_through_idf_and_tfidf(spark):
    """508 documents whose document frequencies are the printed ones."""
    docs = spark.createDataFrame([(1, G1)], "doc_id long, words array<string>")
    first = term_counts(docs, hashing=MURMUR)
    others = spark.createDataFrame([(d, b, 1) for b, df in G3_DF.items() for d in range(2, df + 1)],
                                   "doc_id long, term int, tf long")
    counts = first.unionByName(others)
    everyone = spark.range(1, 509).withColumnRenamed("id", "doc_id")
    x = tfidf(counts, idf(counts, everyone), MURMUR, fit_docs=everyone)
    got = {r.term: r.tfidf for r in x.filter("doc_id = 1").collect()}
    assert got.keys() == G3_TFIDF.keys() and all(abs(got[b] - v) < 1e-12 for b, v in G3_TFIDF.items())


def test_terms_are_counted_by_number_in_any_steps(spark, monkeypatch):
    from collections import Counter
    from hashlib import md5

    from pyspark.sql import Row

    from revlens.operators import features as feat
    lists = {1: ["b", "a", "b", None, "é"], 2: [], 3: None, 4: ["a"] * 9 + ["😀"], 5: ["x", "b"]}
    docs = spark.createDataFrame([Row(doc_id=k, label=k % 2, words=w) for k, w in [*lists.items(), (5, ["x"])]],
                                 "doc_id long, label int, words array<string>")
    for hashing, term in ((feat.EXACT, lambda w: w), (feat.MD5_16, lambda w: int(md5(w.encode()).hexdigest()[:4], 16))):
        want = Counter()
        for key, words in [*lists.items(), (5, ["x"])]:
            want.update([(key, key % 2, t, n) for t, n in Counter(term(w) for w in words or [] if w is not None).items()])
        for words in (1_000_000, 3):
            monkeypatch.setattr(feat, "STEP_WORDS", words)
            got = feat.term_counts(docs, hashing=hashing, carry=["label"])
            assert Counter(map(tuple, got.collect())) == want
            assert "transform(" not in got._jdf.queryExecution().executedPlan().toString()  # no md5 a word
