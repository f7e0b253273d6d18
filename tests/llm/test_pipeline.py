"""The corpus pipeline against brute force, stage by stage."""

from __future__ import annotations

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from revlens.llm.common import write_scratch
from test_operators import brute_groups, brute_removal, check_packing, word_ids

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id long"


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stages_are_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "suffix_array_dedup", "best_fit_packing"]


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect() if any(c.isalpha() for c in r.text or "")]
    firsts = [(k, t) for (k, t), (_, _, c) in zip(rows, brute_groups(rows, 5)) if k == c]
    left = [(k, kept.decode(errors="ignore")) for (k, _), (_, _, _, kept) in zip(firsts, brute_removal([t for _, t in firsts]))]
    left = [(k, t) for k, t in left if t]
    got = corpus_pipeline.run(spark, SF).collect()
    check_packing(got, [(k, word_ids(t)) for k, t in left])


def test_language_id_without_fitting_rows(spark):
    rows = [(1, None), (2, ""), (3, "123 !!"), (4, "plain words stand here"), (5, "漢字"), (None, "no id")]
    docs = spark.createDataFrame([(k, t, None, "s", 1, 0) for k, t in rows], SCHEMA)
    out = stage("language_id")(spark, docs, SF)
    assert out.columns == corpus_pipeline.COLUMNS
    assert sorted(r.doc_id or 0 for r in out.collect()) == [0, 4, 5]


def test_near_dedup_takes_five_words(spark):
    """Five edits in 200 words: a likeness of 0.816 on four words, of 0.774 on five."""
    words = [f"w{i}" for i in range(200)]
    edited = [f"e{i}" if i % 40 == 20 else w for i, w in enumerate(words)]
    less = [f"e{i}" if i % 50 == 20 else w for i, w in enumerate(words)]  # four edits: 0.815 on five
    rows = [(1, " ".join(words)), (2, " ".join(edited)), (3, " ".join(w + "x" for w in words)), (4, " ".join(w + "x" for w in less))]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t), 0) for k, t in rows], SCHEMA)
    assert sorted(r.doc_id for r in stage("near_dedup")(spark, docs, SF).collect()) == [1, 2, 3]


def test_near_dedup_of_a_table_by_five_words(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, (r.text or "").encode().lower().split()) for r in docs.collect())
    sets = [frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset() for _, w in rows]
    root = list(range(len(rows)))
    for a, one in enumerate(sets):
        for b in range(a):
            if one and sets[b] and 100 * (n := len(one & sets[b])) >= 80 * (len(one) + len(sets[b]) - n):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    got = stage("near_dedup")(spark, docs, SF)
    assert sorted(r.doc_id for r in got.collect()) == [k for i, (k, _) in enumerate(rows) if root[i] == i]


def test_near_dedup_tells_texts_of_one_id_apart(spark):
    """Id 5 holds a near copy of 1, a text of its own in two equal rows, and one more; 7 two near copies."""
    texts = [" ".join(f"{c}{i}" for i in range(100)) for c in "abcd"]
    rows = [(1, texts[0]), (5, texts[0] + " tail"), (5, texts[1]), (5, texts[1]), (5, texts[2]),
            (7, texts[3]), (7, texts[3] + " tail")]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame([(k, t, "en", "s", len(t), 0) for k, t in order], SCHEMA).repartition(3)
        out = sorted((r.doc_id, r.text) for r in stage("near_dedup")(spark, docs, SF).collect())
        assert out[:3] == [(1, texts[0]), (5, texts[1]), (5, texts[2])]
        assert [k for k, _ in out[3:]] == [7] and out[3][1].startswith(texts[3])


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_edge_rows(spark, empty):
    rows = [] if empty else [
        (1, None, "en", "s", None), (2, "", "en", "s", 0), (3, "123 !!", None, None, 6), (4, "plain words stand here", None, "s", 4),
        (5, "plain words stand here", "en", "s", 4), (5, "plain words stand here", "en", "s", 4), (None, "no id", "en", "s", 5)]
    docs = spark.createDataFrame([(*r, 7) for r in rows], SCHEMA)
    for name, f in corpus_pipeline.STAGES[:-1]:
        docs = write_scratch(f(spark, docs, SF), "test")
        assert docs.columns == corpus_pipeline.COLUMNS, name
    assert sorted((r.doc_id or 0, r.text, r.n_chars) for r in docs.collect()) == (
        [] if empty else [(0, "no id", 5), (4, "plain words stand here", 22)])
    packed = stage("best_fit_packing")(spark, docs, SF)
    assert packed.count() == (0 if empty else 2)


def test_repeats_are_cut_at_character_borders(spark):
    shared = "é" * 150
    rows = [(i, f"{c * 3}{shared}{c * 5}", "en", "s", 158, 0) for i, c in enumerate("ab")]
    out = stage("suffix_array_dedup")(spark, spark.createDataFrame(rows, SCHEMA), SF)
    assert sorted((r.doc_id, r.text, r.n_chars) for r in out.collect()) == [(0, "a" * 8, 8), (1, "b" * 8, 8)]
    assert out.where(F.col("n_chars") != F.length("text")).count() == 0
