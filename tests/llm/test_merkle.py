"""The Merkle manifest against a plain tree."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest

from revlens.llm import merkle
from revlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, total int, path string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    """(root, path of each node: list of (left, right) strings)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            low = k // 16 * 16
            paths[i].append(("".join(nodes[low:k]), "".join(nodes[k + 1:low + 16])))
        nodes = [h(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)]
        at = [k // 16 for k in at]
    return nodes[0], paths


def lower(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    if not rows:
        return Counter()
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[1]].append((r[0] is not None, r[0] or 0, leaf_of(*r), r))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: (sorted(by_source[s], key=lambda x: x[:3]),) for s in sources}
    trees = {s: (own, *tree([x[2] for x in own])) for s, (own,) in trees.items()}
    root, tops = tree([trees[s][1] for s in sources])
    out = []
    for s, top in zip(sources, tops):
        own, subroot, paths = trees[s]
        for (_, _, leaf, r), path in zip(own, paths):
            whole = path + top
            now = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                now = leaf_of(*r[:4], lower(r[4]))
            for left, right in whole:
                now = h(left, now, right)
            out.append((r[0], leaf, subroot, root, h("".join(a + b for a, b in whole)), now, now == root))
    return Counter(out)


def check(spark, rows, height=3):
    df = spark.createDataFrame([(k, t, lang, s, n, "x", 1, "y") for k, s, lang, n, t in rows], SCHEMA)
    assert Counter(map(tuple, merkle.manifest(df, height).collect())) == brute(rows)


@pytest.mark.parametrize("height", [1, 2, 3])
def test_manifest_of_many_sizes(spark, height):
    """Sources of 1, 2, 15, 16, 17, 256, 257 and 300 documents, so that levels end ragged."""
    rows = [(1000 * i + k, f"s{i}", "en", k, f"Text {k} OF {i}") for i, n in enumerate([1, 2, 15, 16, 17, 256, 257, 300])
            for k in range(n)]
    check(spark, rows[::-1], height)


def test_manifest_of_many_sources(spark):
    """More sources than a run, names that differ beyond ASCII, blocks of one level."""
    names = [f"{c}{i}" for i in range(9) for c in ("a", "é", "漢", "😀", "Z")] + ["", None]
    check(spark, [(i, s, None, None, "One") for i, s in enumerate(names)], 1)


def test_manifest_edges(spark):
    long = "LONG Words " * 60_000
    check(spark, [
        (1, None, None, None, None), (2, "", "", 0, ""), (3, "s", "en", -5, long), (3, "s", "en", -5, long), (3, "s", "en", 1, "other"),
        (None, "s", "en", 1, "no ID"), (None, "s", "en", 1, "no ID at all"), (None, None, None, None, None), (-7, "s", "en", 2, "ÉA:1-"),
        (10, "s", "1:2", 3, "-")])
    check(spark, [(5, "only", "en", 1, "ALONE")])
    check(spark, [])


def test_manifest_of_a_table(spark):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = Counter(map(tuple, QUERIES["op13_merkle_manifest"](spark, SF).collect()))
    assert got == brute(rows)
    assert {r[6] for r in got} == {True, False}


def test_manifest_tells_what_changed(spark):
    rows = [(i, "s", "en", 1, "lower only") for i in range(40)]
    df = spark.createDataFrame([(k, t, lang, s, n, "x", 1, "y") for k, s, lang, n, t in rows], SCHEMA)
    assert {r.verified for r in merkle.manifest(df).collect()} == {True}  # lower case has nothing to tamper with


def test_manifest_plan_is_native(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = merkle.manifest(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
