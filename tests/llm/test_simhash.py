"""SimHash groups against comparing all fingerprints."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from revlens.llm import simhash
from revlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, print string, component_id int"


def brute_print(text, size=4):
    words = (text or "").encode().lower().split()
    runs = [words[i:i + size] for i in range(len(words) - size + 1)] if len(words) >= size else [words] if words else []
    hashes = [xxhash.xxh64_intdigest(b" ".join(r), 42) for r in runs]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def brute_components(prints, distance):
    """print -> smallest print that links reach."""
    nodes = np.array(sorted(set(prints)), np.uint64)
    at = np.arange(len(nodes))
    for i in range(len(nodes)):
        near = np.flatnonzero(np.bitwise_count(nodes ^ nodes[i]) <= distance)
        roots = np.unique(at[near])
        at[np.isin(at, roots)] = roots[0]
    return {int(n): int(nodes[a]) for n, a in zip(nodes, at)}


def brute(rows, distance=4):
    prints = [brute_print(t) for _, t in rows]
    comp = brute_components(prints, distance)
    least = {}
    for (key, _), p in zip(rows, prints):
        if key is not None:
            least[comp[p]] = min(key, least.get(comp[p], key))
    return Counter((key, f"{p:016x}", least.get(comp[p])) for (key, _), p in zip(rows, prints))


def check(spark, rows):
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], SCHEMA).repartition(3)
    assert Counter(map(tuple, simhash.group_near_duplicates(df).collect())) == brute(rows)


def test_simhash_edges(spark):
    long = " ".join(f"w{i * 7919 % 100003}" for i in range(30_000))
    check(spark, [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "One"), (5, "one"), (6, "one two three"), (6, "one two three four"),
                  (6, "one two three four"), (None, "no id at all here"), (None, "no id at all here"), (7, long), (8, long + " tail"),
                  (9, "É é\xa0ü 漢字 😀 x\x1cy"), (-4, "ONE TWO three FOUR"), (10, "a " * 50_000)])
    check(spark, [])


def test_simhash_of_a_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = Counter(map(tuple, QUERIES["op11_simhash_pigeonring"](spark, SF).collect()))
    assert got == brute(rows)


def prints_of(draw, n, groups, flips):
    """Random prints and walks that start from some of them and flip a few bits at a time."""
    out = [draw.getrandbits(64) for _ in range(n)]
    for _ in range(groups):
        now = draw.getrandbits(64)
        for _ in range(draw.randrange(40)):
            for b in draw.sample(range(64), draw.randint(1, flips)):
                now ^= 1 << b
            out.append(now)
    return out


@pytest.mark.parametrize("distance,block,small", [(4, 2000, 64), (4, 2000, 2), (4, 3, 2), (2, 2000, 64), (7, 5, 2)])
def test_links_of_prints(spark, monkeypatch, distance, block, small):
    """Every link counts, whatever the sizes of buckets that are dealt out in blocks."""
    monkeypatch.setattr(simhash, "BLOCK_ROWS", block)
    monkeypatch.setattr(simhash, "SMALL_ROWS", small)
    draw = random.Random(distance * 100 + block)
    prints = prints_of(draw, 200, 12, distance + 1)
    prints += [0, (1 << 64) - 1, 1 << 63, *(sum(1 << b for b in draw.sample(range(64), 2)) for _ in range(60))]
    nodes = sorted(set(prints))
    df = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in nodes], "node long")
    got = {}
    for r in simhash.linked_prints(df, distance).collect():
        got[int(np.int64(r.node).view(np.uint64))] = r.component
    want = brute_components(nodes, distance)
    linked = {p for p, n in Counter(want.values()).items() if n > 1}
    assert set(got) == {p for p in nodes if want[p] in linked}
    assert len({(got[p], want[p]) for p in got}) == len(set(got.values())) == len(linked)


def test_ring_keeps_every_pair():
    """By hand: of all pairs within distance some key is shared and passes the chains."""
    draw = random.Random(6)
    for distance in (2, 3, 4, 9):
        ring = simhash.Ring(distance)
        for _ in range(300):
            a = draw.getrandbits(64)
            b = a
            for bit in draw.sample(range(64), distance):
                b ^= 1 << bit
            met = 0
            for k, segment in enumerate(ring.segments):
                both = sum(1 << x for x in (*segment, *ring.segments[k - 1]))
                for bit in segment:
                    if not (a ^ b) & both & ~(1 << bit):
                        met += len(ring.alike(bit, np.array([a], np.uint64), np.array([b], np.uint64)))
            assert met
        with pytest.raises(ValueError):
            simhash.Ring(1)
