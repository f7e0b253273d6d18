"""Ranked search against scoring every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from revlens.llm import lexical

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, score int, rank string, item_id string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(ASCII_LOWER))


def brute(docs, queries, k=10):
    bags = [(key, Counter(terms(t))) for key, t in docs]
    bags = [(key, bag) for key, bag in bags if bag]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(w for _, b in bags for w in b)
    out = []
    for item, text in queries:
        asked = set(terms(text))
        scored = []
        for key, bag in bags:
            m = 100 - 90 + (90 * sum(bag.values()) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((1000000000 * bag[w]) // (1000 * bag[w] + 8 * m))
                    for w in asked if w in bag)
            if s > 0:
                scored.append((-s, key is not None, key or 0))
        out += [(item, i + 1, key if some else None, -s) for i, (s, some, key) in enumerate(sorted(scored)[:k])]
    return Counter(out)


def check(spark, docs, queries, k=10):
    d = spark.createDataFrame([(key, t, 7, "x", "y") for key, t in docs], SCHEMA).repartition(3)
    q = spark.createDataFrame([(i, t, 5) for i, t in queries], "item_id long, text string, doc_id int")
    assert Counter(map(tuple, lexical.rank_documents(d, q, k).collect())) == brute(docs, queries, k)


def test_search_edges(spark):
    long = " ".join(f"w{i * 7919 % 4001}" for i in range(30_000))
    docs = [(1, None), (2, ""), (3, " .,;"), (4, "One two THREE"), (5, "one two three"), (5, "one two three"), (5, "another one"),
            (None, "one without id"), (None, "two"), (6, long), (7, "Ünïcödé 漢字 É é ß one"), (8, "a\x00b\x7fc one-two"), (-3, "one two three"),
            (9, "w1 " * 70_000)]
    queries = [(1, "One"), (2, None), (3, ""), (4, "unknown words"), (5, "one two three one"), (5, "one two three one"), (None, "w1 w2 漢字"),
               (6, "é É"), (7, "A B C"), (8, long)]
    check(spark, docs, queries)
    check(spark, docs, queries, k=2)
    check(spark, docs, [])
    check(spark, [], queries)
    check(spark, [(1, None), (2, "?")], queries)


@pytest.mark.parametrize("postings", [200, 5000, 2_000_000])
def test_search_of_many_shards_and_blocks(spark, postings, monkeypatch):
    """Common and rare words, ties between equal texts, queries in several blocks."""
    monkeypatch.setattr(lexical, "QUERY_ROWS", 7)
    monkeypatch.setattr(lexical.build_index, "__defaults__", (postings,))
    draw = random.Random(3)
    words = [f"t{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    docs = [(i, " ".join(draw.choices(words, weights, k=draw.choice([3, 20, 200])))) for i in range(900)]
    docs += [(2000 + i, docs[i % 5][1]) for i in range(60)]
    queries = [(i, " ".join(draw.choices(words, k=draw.choice([1, 3, 30])))) for i in range(20)]
    check(spark, docs, queries)


def test_search_of_a_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    queries = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    check(spark, docs, queries)


def test_blocks_are_rejected_unopened():
    """A rare word decides; of the common word's blocks most are never unpacked."""
    builder = lexical.ShardBuilder(lexical.Statistics(20_000, 20_000 * 3))
    for i in range(20_000):
        builder.add(i, [b"common", b"x%d" % (i % 7)] + ([b"rare"] * 3 if i % 1900 == 5 else [b"pad"]))
    row = builder.row()
    lists = lexical.Lists({n: row.column(i)[0].as_py() for i, n in enumerate(row.schema.names)})
    opened = []
    docs, scores = lexical.top_of_shard(lists, {b"common": 3, b"rare": 7000, b"nowhere": 9}, 10, opened=opened)
    assert docs.tolist() == list(range(5, 19_100, 1900))[:10] and (np.diff(scores) <= 0).all()
    assert opened[0] == (1, 1) and opened[1][0] <= 11 and opened[1][1] == -(-20_000 // lexical.BLOCK)


def test_lists_unpack_any_blocks():
    draw = random.Random(8)
    builder = lexical.ShardBuilder(lexical.Statistics(5000, 50_000))
    held = {}
    for i in range(5000):
        bag = [b"a"] * draw.choice([0, 1, 300, 70_000 if i == 77 else 2]) + [b"b"] * (i % 900 == 0) + [b"z"]
        builder.add(i, bag)
        held[i] = Counter(bag)
    row = builder.row()
    lists = lexical.Lists({n: row.column(i)[0].as_py() for i, n in enumerate(row.schema.names)})
    for word in (b"a", b"b", b"z"):
        t = lists.numbers[word]
        docs, score = lists.unpack(t)
        assert docs.tolist() == [i for i in held if held[i][word]]
        assert score.tolist() == [int(lexical.impact(held[i][word], lists.lengths[i])) for i in docs.tolist()]
        n = len(lists.blocks(t)[0])
        for picked in ([0], [n - 1], list(range(0, n, 3))):
            some, part = lists.unpack(t, np.array(picked))
            want = [d for p in picked for d in docs[p * lexical.BLOCK:(p + 1) * lexical.BLOCK].tolist()]
            assert some.tolist() == want and len(part) == len(want)
