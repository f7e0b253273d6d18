"""Stop words from a table: sent to the tasks or joined, the same rows as a short list."""

import pyarrow as pa
from pyspark.sql import functions as F

from revlens.functions import text as T
from revlens.operators import stopwords
from revlens.operators.stopwords import remove_stop_words

ROWS = [(1, ["a", "b", "a", "c", "b"], "x"), (1, ["a", "b", "a", "c", "b"], "x"), (2, [], "y"), (3, None, None),
        (4, ["a", "a"], "z"), (5, ["c", None, "😀", "", "c"], "_n"), (None, ["b", "d"] * 3000, "long")]
SCHEMA = "doc_id int, words array<string>, _n string"


def _rows(df):
    return sorted(((r.doc_id, r.words, r["_n"]) for r in df.collect()), key=str)


def test_both_ways_equal_the_short_list(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    for stop in (["a", "b", ""], ["a", "a", None], [None], []):
        words = [w for w in stop if w is not None]
        want = _rows(docs.withColumn("words", T.remove_stop_words("words", words) if words
                                     else F.filter("words", lambda w: w.isNotNull())))
        table = spark.createDataFrame([(w,) for w in stop], "word string")
        assert _rows(remove_stop_words(docs, table)) == want
        assert _rows(remove_stop_words(docs, table, max_words=-1)) == want


def test_a_million_stop_words(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    table = spark.range(1_000_000).select(F.concat(F.lit("stop"), F.col("id").cast("string")).alias("word"))
    table = table.union(spark.createDataFrame([("a",), ("d",)], "word string"))
    want = _rows(docs.withColumn("words", T.remove_stop_words("words", ["a", "d"])))
    assert _rows(remove_stop_words(docs, table)) == want
    assert _rows(remove_stop_words(docs, table, max_bytes=1000)) == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    stop = spark.createDataFrame([("a",)], "word string")
    assert remove_stop_words(docs, stop).collect() == remove_stop_words(docs, stop, max_words=0).collect() == []


def _held(listed, batches):
    """Most bytes that Arrow allocates while a task's batches are handled one after another."""
    before, pool = pa.default_memory_pool(), pa.proxy_memory_pool(pa.default_memory_pool())
    pa.set_memory_pool(pool)
    try:
        rows = [r for b in stopwords._dropped(iter(batches), 0, listed) for r in map(len, b.column(0).to_pylist())]
    finally:
        pa.set_memory_pool(before)
    return pool.max_memory(), rows


def test_a_task_holds_no_table_of_the_whole_list(monkeypatch):
    listed = pa.array([f"stop{i:07}" for i in range(1_000_000)])
    words = pa.array([["a", "stop0000007", "b", "stop0999999"] * 50] * 1000)
    batch = pa.RecordBatch.from_arrays([words], names=["words"])
    most, rows = _held(listed, [batch, batch])
    assert rows == [100] * 2000
    assert most < listed.nbytes  # the table of the list alone takes more
    monkeypatch.setattr(stopwords, "SLICE_WORDS", 10_000)
    less, rows = _held(listed.slice(0, 10), [batch, batch])
    assert rows == [150] * 2000
    assert less < words.nbytes / 4  # a part of the batch at a time


def test_slices_keep_rows_nulls_and_order(monkeypatch):
    monkeypatch.setattr(stopwords, "SLICE_WORDS", 3)
    lists = [["a"] * 7, None, [], ["b", None], ["a", "c"], ["c"] * 3, None, ["d"] * 4, []]
    whole = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(lists, pa.list_(pa.string()))], names=["k", "words"])
    want = [None if x is None else [w for w in x if w not in (None, "a")] for x in lists]
    for batch, begin in ((whole, 0), (whole.slice(3), 3), (whole.slice(0, 0), 9)):
        parts = list(stopwords._dropped(iter([batch]), 1, pa.array(["a", "z"])))
        assert [k for p in parts for k in p.column(0).to_pylist()] == list(range(begin, 9))
        assert [x for p in parts for x in p.column(1).to_pylist()] == want[begin:]
        assert all(len(p) == 1 or sum(map(len, filter(None, p.column(1).to_pylist()))) <= 3 for p in parts)


def test_larger_lists_meet_the_different_words_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(stopwords, "BLOCK_ROWS_LOG2", 1)
    docs = spark.createDataFrame(ROWS * 3, SCHEMA).coalesce(1)
    want = _rows(docs.withColumn("words", T.remove_stop_words("words", ["a", "d"])))
    got = remove_stop_words(docs, spark.createDataFrame([("a",), ("d",), ("z",)], "word string"), max_words=-1)
    assert _rows(got) == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan and "LeftSemi" in plan  # a word goes out once a block, not once a place
