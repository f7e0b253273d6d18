"""Operators against brute force, on whole small tables and on hand-made edge rows."""

from __future__ import annotations

import base64
import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import regex
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from revlens.llm import (ann, byte_bpe, fingerprints, language, licenses, neardup, packing, suffix_dedup,
                         token_trie, wavelet)
from revlens.llm.graph import components
from revlens.llm.queries import ORACLE, QUERIES
from revlens.llm.suffix_array import suffix_array
from revlens.llm.word_encoder import word_encoder

SF = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(WORDS)
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tokens int, sequence_id string"

LONG = " ".join(f"w{i * 7919 % 100003}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))
EDGES = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "Tie tie TIE"), (6, LONG), (7, LONG + " tail"),
    (8, "Ünïcödé 漢字 😀 emoji é combining ﬁ ligature İ ß"), (9, f"front {PASSAGE} back one"),
    (10, f"other {PASSAGE} back two"), (11, "12345 !!! ???"), (12, "x" * 5000), (13, "ab" * 700),
    (14, "same words here twice and that is all"), (15, "same words here twice and that is all"),
    (15, "same words here twice and that is all"), (None, "no id at all"), (16, "a\x1cb c d"),
    (17, "thing " * 400), (18, "\x00 nul and <|endoftext|> mark"),
]


@pytest.fixture(scope="module")
def edge_docs(spark):
    rows = [(k, t, "en" if t else None, "s", None, 1, "x") for k, t in EDGES]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}


def rows_of(df):
    return sorted(df.collect(), key=lambda r: tuple((v is not None, v) for v in r))


# -- 1 packing ----------------------------------------------------------------------------

def word_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def check_packing(rows, ids):
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for placed in seqs.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    expected = Counter()
    for key, i in ids:
        i = i + [0]
        for k, at in enumerate(range(0, len(i), packing.CAPACITY)):
            part = np.array(i[at:at + packing.CAPACITY], "<u4")
            expected[(key, k, at, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    return len(seqs)


def test_packing_edges(edge_docs, empty_docs):
    rows = packing.pack_documents(edge_docs, WORDS).collect()
    check_packing(rows, [(k, word_ids(t)) for k, t in EDGES])
    assert packing.pack_documents(empty_docs, WORDS).collect() == []


def test_packing_table_is_tight(docs, texts):
    rows = packing.pack_documents(docs, WORDS).collect()
    n = check_packing(rows, [(k, word_ids(t)) for k, t in texts.items()])
    least = -(-sum(r.length for r in rows) // packing.CAPACITY)
    assert n <= least * 1.02 + 1


def test_packing_merges_underfull_bins(spark):
    """Many nodes with few items each: the rounds must join their bins; clashing names go."""
    items = spark.range(4000).select(F.col("id").alias("item"), (F.col("id") % 700 + 1).alias("length"),
                                     F.lit("x").alias("offset")).repartition(16)
    rows = packing.pack(items, node_rows=100, fan_in=4).collect()
    fill = defaultdict(int)
    for r in rows:
        fill[r.sequence_id] += r.length
    assert len(rows) == 4000 and max(fill.values()) <= 2048
    assert len(fill) <= sum(fill.values()) / 2048 * 1.01 + 1


def test_packing_items_that_never_pair(spark):
    items = spark.range(1000).select("id", F.lit(1100).cast("long").alias("length"))
    rows = packing.pack(items, node_rows=50).collect()
    assert len({r.sequence_id for r in rows}) == 1000


def test_packing_rejects_bad_lengths(spark):
    with pytest.raises(Exception, match="lengths must lie"):
        packing.pack(spark.createDataFrame([(1, 0)], "id long, length long"))


# -- 2 repeated strings -------------------------------------------------------------------

def brute_removal(texts):
    seen = Counter()
    raws = [(t or "").encode() for t in texts]
    for raw in raws:
        seen.update(raw[i:i + 200] for i in range(len(raw) - 199))
    out = []
    for raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - 199):
            if seen[raw[i:i + 200]] > 1:
                gone[i:i + 200] = b"\1" * 200
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(raw), sum(gone), spans, kept))
    return out


def test_suffix_array_against_sorting():
    draw = random.Random(5)
    for _ in range(400):
        kinds = draw.choice([1, 2, 3, 40])
        a = [draw.randrange(kinds) for _ in range(draw.randint(0, 40))] * draw.choice([1, 1, 3])
        assert suffix_array(np.array(a, int)).tolist() == sorted(range(len(a)), key=lambda i: a[i:])


@pytest.mark.parametrize("hot", [20_000, 2])
def test_removal_edges(edge_docs, empty_docs, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_CELLS", hot)
    small = [(k, t) for k, t in EDGES if t != LONG and t != LONG + " tail"]
    near = edge_docs.where("doc_id is null or doc_id not in (6, 7)")
    expected = Counter((k, *row) for (k, _), row in zip(small, brute_removal([t for _, t in small])))
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
                  for r in suffix_dedup.remove_repeats(near).collect())
    assert got == expected
    assert suffix_dedup.remove_repeats(empty_docs).collect() == []


@pytest.mark.parametrize("hot", [20_000, 3])
def test_removal_random_overlaps(spark, hot, monkeypatch):
    """Passages cut at random places, periodic runs and copies, down to one byte at the borders."""
    monkeypatch.setattr(suffix_dedup, "HOT_CELLS", hot)
    draw = random.Random(9)
    source = "".join(draw.choice("abcdeé ") for _ in range(1500))
    rows = []
    for k in range(120):
        a = draw.randrange(1200)
        piece = source[a:a + draw.choice([190, 199, 200, 201, 230, 300])]
        noise = ["".join(draw.choice("uvwxyz ") for _ in range(draw.randrange(300))) for _ in range(2)]
        rows.append((k, noise[0] + piece + noise[1]))
    rows += [(200, "ab" * 150), (201, "z" * 199), (202, "y" * 200), (203, "x" * 201)]
    expected = {k: row for (k, _), row in zip(rows, brute_removal([t for _, t in rows]))}
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == expected[r.doc_id], r.doc_id


def test_removal_of_texts_that_share_an_id(spark, monkeypatch):
    """Rows of one id, or of none, are told apart, whatever their texts."""
    draw = random.Random(12)
    shared = "".join(draw.choice("abcde") for _ in range(400))
    rows = [(7, shared + " one"), (7, "".join(draw.choice("fghij") for _ in range(649))), (7, "x" + shared), (7, "x" + shared)]
    rows += [(None, "".join(draw.choice("klmno") for _ in range(300)) + shared[:draw.choice([0, 150, 250])]) for _ in range(30)]
    expected = Counter((k, *row) for (k, _), row in zip(rows, brute_removal([t for _, t in rows])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(df).collect())
    assert got == expected


def test_hot_cores_are_sorted_salt_by_salt(spark, monkeypatch):
    """A passage before distinct texts: its cells are split over salts, and a task that gets several
    of them holds only one at a time."""
    monkeypatch.setattr(suffix_dedup, "HOT_CELLS", 30)
    monkeypatch.setattr(suffix_dedup, "BLOCK_SYMBOLS", 1)
    draw = random.Random(13)
    passage = "".join(draw.choice("abcdefgh") for _ in range(260))
    rows = [(i, f"{draw.getrandbits(80):x}{passage}{draw.getrandbits(80):x}") for i in range(300)]
    expected = {k: row for (k, _), row in zip(rows, brute_removal([t for _, t in rows]))}
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got} == expected
    cells = [(k % 3, b"ab" * 15, b"cd" * 15, k, 100, False, True, k % 3 * 10 + k // 100) for k in range(300)]
    cells.sort(key=lambda c: (c[0], c[7]))
    held = []
    monkeypatch.setattr(suffix_dedup, "_equal_windows", lambda kept, cell: held.append(len(kept)) or [])
    names = ["core", "left", "right", "row", "base", "known", "hot", "salt"]
    batch = pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*cells)], names=names)
    list(suffix_dedup._sort_cells(200, 32)(iter([batch])))
    assert len(held) == 9


def test_removal_table(docs, texts):
    keys = list(texts)
    expected = dict(zip(keys, brute_removal([texts[k] for k in keys])))
    for r in QUERIES["op2_suffix_array_dedup"](docs.sparkSession, SF).collect():
        n, gone, spans, kept = expected[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (n, gone, spans)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


# -- 3 fingerprints -----------------------------------------------------------------------

def test_fingerprints_edited_text(edge_docs, empty_docs):
    rows = fingerprints.compare_edited(edge_docs).collect()
    assert len(rows) == len(EDGES)
    listed = sorted((r for r in EDGES if r[0] is not None and r[0] != 15), key=lambda r: -r[0])
    by_id = {r.doc_id: r for r in rows}
    for i, (k, text) in enumerate(listed[:-1]):
        text, after = text or "", listed[i + 1][1] or ""
        if k - 1 != listed[i + 1][0]:
            continue  # the repeated id lies between
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        assert by_id[k].n_chars == len(text)
        assert by_id[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    first = listed[0][1]
    assert by_id[None].edited_sha256 == hashlib.sha256(("no id " + first[:6]).encode()).hexdigest()
    same = {r.fingerprint for r in rows if r.doc_id in (14, 15)}
    assert len(same) == 1 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert fingerprints.compare_edited(empty_docs).collect() == []


def test_fingerprint_single_row_is_its_own_next(spark):
    one = spark.createDataFrame([(3, "abcd")], "doc_id long, text string")
    (r,) = fingerprints.compare_edited(one).collect()
    assert r.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and r.near_next == 1.0


def test_fingerprint_likeness_and_merge(spark):
    words = [f"w{i}" for i in range(4000)]
    rows = spark.createDataFrame([(" ".join(words), " ".join(words[:3000]), " ".join(words[3000:]))], "a string, b string, c string")
    s = rows.select(*(fingerprints.sketch(F.col(c)).alias(c) for c in "abc"))
    r = s.select(fingerprints.jaccard(F.col("a"), F.col("b")).alias("j"), fingerprints.containment(F.col("b"), F.col("a")).alias("in"),
                 fingerprints.containment(F.col("a"), F.col("b")).alias("of"),
                 F.size(F.array_except(F.col("a"), fingerprints.merge(F.col("b"), F.col("c")))).alias("lost")).first()
    assert r["in"] == 1.0 and abs(r["j"] - 0.75) < 0.06 and abs(r["of"] - 0.75) < 0.06 and r["lost"] <= 4


def brute_sketch(text):
    words = regex.split(r"[ \t\n\x0B\f\r]+", (text or "").lower())
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words if w]
    signed = [h - (1 << 64) if h >> 63 else h for h in hashes]
    if len(signed) < fingerprints.SHINGLE:
        found = {xxhash.xxh64_intdigest(" ".join(map(str, signed)).encode(), 42)}
    else:
        found = set()
        for i in range(len(signed) - fingerprints.SHINGLE + 1):
            seed = 42
            for h in signed[i:i + fingerprints.SHINGLE]:
                seed = xxhash.xxh64_intdigest(struct.pack("<q", h), seed)
            found.add(seed)
    found = {h - (1 << 64) if h >> 63 else h for h in found}
    low = {h for h in found if h < -(1 << 63) + (1 << 64) // fingerprints.SCALE}
    return low or {min(found)}


def brute_fingerprints(rows):
    """rows (doc_id, text) with ids of their own; the next one is the next smaller id."""
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for i, (k, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        a, b, c = map(brute_sketch, (text, text[:len(text) - half] + after[:half], after))
        shown = [",".join(f"{h % (1 << 64):x}" for h in sorted(s)) for s in (a, b)]
        out[k] = (*shown, len(a & b) / len(a | b), len(a & c) / len(a | c))
    return out


def test_fingerprints_of_a_table_by_brute_force(spark, docs, texts):
    want = brute_fingerprints(list(texts.items()))
    rows = QUERIES["op3_document_fingerprints"](spark, SF).collect()
    assert len(rows) == len(want)
    for r in rows:
        shown, edited, near_edited, near_next = want[r.doc_id]
        assert (r.fingerprint, r.edited_fingerprint) == (shown.lower(), edited.lower()), r.doc_id
        assert abs(r.near_edited - near_edited) < 1e-12 and abs(r.near_next - near_next) < 1e-12


def test_fingerprints_of_short_passages(spark):
    """Passages taken out of long texts are contained or say nothing; a merge is the union's sketch."""
    draw = random.Random(3)
    rows = []
    for n in (5, 8, 12, 30) * 40:
        words = [f"w{draw.randrange(10**6)}" for _ in range(500)]
        at = draw.randrange(500 - n)
        rows.append((" ".join(words[at:at + n]), " ".join(words), " ".join(f"o{draw.randrange(10**6)}" for _ in range(6))))
    df = spark.createDataFrame(rows, "part string, whole string, other string")
    s = df.select(*(fingerprints.sketch(F.col(c)).alias(c) for c in df.columns))
    got = s.select(fingerprints.containment(F.col("part"), F.col("whole")).alias("in"), fingerprints.merge(F.col("part"), F.col("other")).alias("both"),
                   fingerprints.merge(F.col("part"), F.col("part")).alias("twice"), "part").collect()
    assert {r["in"] for r in got} == {1.0, None} and all(r.twice == r.part for r in got)
    limit = -(1 << 63) + (1 << 64) // fingerprints.SCALE
    for r, (part, _, other) in zip(got, rows):
        union = brute_sketch(part) | brute_sketch(other)
        low = sorted(h for h in union if h < limit)
        assert r.both == (low or [min(union)])


def test_fingerprint_plan_has_no_python(spark, docs):
    plan = fingerprints.compare_edited(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("buckets", [1, 100_000])
def test_next_rows_of_crowded_and_far_ids(spark, monkeypatch, buckets):
    """Null ids, one id in a third of the rows, far ids and repeated rows: the order is a plain
    sort's, and no bucket holds more than a few times its share."""
    monkeypatch.setattr(fingerprints, "MAX_BUCKETS", buckets)
    draw = random.Random(11)
    ids = [None] * 700 + [5] * 700 + [draw.randrange(2000) for _ in range(600)] + [-(1 << 63), (1 << 63) - 1, (1 << 63) - 1]
    rows = [(k, draw.getrandbits(64) - (1 << 63)) for k in ids]
    rows += [(7, 7), (7, 7), (7, 7)]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, _tie long, row int").repartition(5)
    got = fingerprints.with_next(df.withColumns({"id": F.col("doc_id"), "hash": F.col("_tie")}), ["row", "id", "hash"]).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = Counter(zip(order, order[1:] + order[:1]))
    assert Counter(((r.id, r.hash), (r.next_id, r.next_hash)) for r in got) == want
    assert sorted(r.row for r in got) == sorted(r.next_row for r in got) == list(range(len(rows)))
    if buckets > 1:
        bucket = fingerprints.neighbours(df, "doc_id", "_tie")
        sizes = [r["count"] for r in df.groupBy(bucket.alias("b")).count().collect()]
        assert len(sizes) > len(rows) // fingerprints.BUCKET_DOCS // 2 and max(sizes) < 5 * fingerprints.BUCKET_DOCS


# -- 4 token counts -----------------------------------------------------------------------

def brute_tokens(scores, word):
    best = [(0.0, 0)] + [(-1e300, 0)] * len(word)
    for i in range(1, len(word) + 1):
        size = len(word[i - 1].encode())
        s, n = best[i - 1][0] + size * token_trie.BYTE_SCORE, best[i - 1][1] + size
        for a in range(i):
            if word[a:i] in scores:
                t = scores[word[a:i]] + best[a][0]
                if t > s or t == s and best[a][1] + 1 < n:
                    s, n = t, best[a][1] + 1
        best[i] = (s, n)
    return best[-1][1]


def test_trie_counts(edge_docs, empty_docs, monkeypatch):
    path = public_tokenizers.path("piece_bpe_32k.model")
    trie = token_trie.token_trie(path)
    got = Counter((r.doc_id, r.n_pretokens, r.n_tokens) for r in token_trie.count_tokens(edge_docs, path).collect())
    short = [(k, t) for k, t in EDGES if len(t or "") < 2000]
    for k, t in short:
        words = (t or "").split()
        assert (k, len(words), sum(brute_tokens(trie.scores, "▁" + w) for w in words)) in got
    assert token_trie.count_tokens(empty_docs, path).collect() == []
    fresh = token_trie.TokenTrie(trie.scores)
    monkeypatch.setattr(token_trie, "MAX_NODES", 50)  # dropped and grown anew all the time
    for w in ["hello", "hell", "help", "héllo", "漢字", "hello", "x" * 60]:
        assert fresh.count(w) == brute_tokens(trie.scores, "▁" + w)


# -- 5 language ---------------------------------------------------------------------------

def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = QUERIES["op5_language_id"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    asked = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in asked) / len(asked) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(edge_docs, empty_docs, spark):
    got = {r.doc_id: r for r in language.predictions(edge_docs).collect()}
    for k in (1, 2, 3, 11):
        assert (got[k].lang_pred, got[k].score) == ("und", 0.0)
    assert got[8].lang_pred == "en"
    assert language.predictions(empty_docs).collect() == []
    unlabelled = edge_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.predictions(unlabelled).collect()} == {"und"}
    rows = [(i, "the cat and the dog", "en", "clash") for i in range(40)] + [(i, "le chat et le chien", "fr", "clash") for i in range(40, 80)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string, score string"))
    asked = spark.createDataFrame([(1, "the dogs", 0.5), (2, "les chiens", 0.5), (3, "漢字", 0.5)], "doc_id long, text string, score double")
    found = {r.doc_id: r.lang_pred for r in language.identify(asked, model).collect()}
    assert found[1] == "en" and found[2] == "fr" and found[3] in ("en", "fr")


def plain_counts(rows):
    """lang -> size -> entry -> count; size 0 are the words."""
    out = defaultdict(lambda: defaultdict(Counter))
    for text, lang in rows:
        for w in regex.findall(r"\p{L}+", (text or "").lower()):
            if len(w) <= language.FIT_CHARS:
                out[lang][0][w] += 1
            out[lang][1].update(w)
            for n in range(2, language.MAX_N + 1):
                edged = f"^{w}$"
                out[lang][n].update(edged[i:i + n] for i in range(len(edged) - n + 1))
    return out


def test_language_tables_equal_a_plain_count(spark, monkeypatch):
    rows = [(r.text, r.lang) for r in language.fitting_rows(spark.read.parquet(f"{SF}/documents.parquet")).collect()]
    rows += [("alpha beta gamma x", "toy"), ("漢字" * 100 + " é", "toy")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string")
    got = []
    monkeypatch.setattr(language, "_model", lambda docs, counts: got.append((docs, counts.to_pydict())))
    language.fit(df)
    (docs, table), = got
    assert docs == Counter(lang for _, lang in rows)
    found = defaultdict(lambda: defaultdict(dict))
    for lang, size, key, n in zip(*(table[c] for c in ("lang", "size", "key", "n"))):
        found[lang][size][key] = n
    for lang, by_size in plain_counts(rows).items():
        assert set(found[lang]) == set(by_size) == set(range(language.MAX_N + 1))
        for size, counts in by_size.items():
            kept = language.MAX_WORDS if size == 0 else language.MAX_NGRAMS
            want = sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))[:kept]
            assert found[lang][size] == dict(want), (lang, size)
    assert {"$", "^", ""} & set(found["toy"][1]) == set() and found["toy"][2]["^a"] == 1


def test_language_by_ngrams_alone(spark):
    """One held-out word at a time, no word known."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(language.fitting_rows(docs))
    model.words = {}
    asked = [(w[len(w) // 2], r.lang) for r in docs.where(language.held_out()).collect()
             if r.lang and (w := [x for x in language._words(r.text) if len(x) > 2])]
    assert len(asked) > 200
    assert sum(model.predict(w)[0] == lang for w, lang in asked) / len(asked) >= 0.96


def test_language_without_blanks(spark):
    """Texts that are one unbroken run of letters teach their language all the same."""
    draw = random.Random(4)
    rows = [(i, "".join(draw.choice(letters) for _ in range(400)), lang) for i, (letters, lang) in enumerate(
        [("天地玄黄宇宙洪荒", "zh"), ("กขคงจฉชซ", "th"), ("abcdefgh", "la")] * 30)]
    found = {r.doc_id: r for r in language.predictions(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert any(r.held_out for r in found.values())
    assert all(found[i].lang_pred == lang for i, _, lang in rows)


# -- 6 wavelet shards ---------------------------------------------------------------------

def test_wavelet_matrix_queries():
    draw = np.random.default_rng(3)
    for n, top in [(0, 1), (1, 1), (17, 2), (9000, 50_000), (9000, 3), (5000, 1 << 20)]:
        ids = draw.integers(0, top, n).astype(np.uint32)
        m = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(ids).to_bytes())
        assert m.ids().tolist() == ids.tolist()
        for at in draw.integers(0, n, min(n, 30)).tolist():
            assert m.access(at) == ids[at]
        for t in {*ids[:5].tolist(), top + 7}:
            assert m.count(t) == int((ids == t).sum())
            lo, hi = n // 3, n // 2
            assert m.count(t, lo, hi) == int((ids[lo:hi] == t).sum())
            assert m.occurrences(t)[:20] == np.flatnonzero(ids == t)[:20].tolist()


def check_shards(rows, listed):
    at = 0
    for r, (k, text) in zip(rows, listed):
        ids = word_ids(text) + [2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (k, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_wavelet_round_trip(edge_docs, empty_docs, docs, texts, monkeypatch):
    rows = sorted(wavelet.round_trip(edge_docs, WORDS).collect(), key=lambda r: r.start)
    check_shards(rows, sorted(EDGES, key=lambda r: (r[0] is not None, r[0])))
    assert wavelet.round_trip(empty_docs, WORDS).collect() == []
    rows = sorted(QUERIES["op6_wavelet_shards"](docs.sparkSession, SF).collect(), key=lambda r: r.start)
    assert len(rows) == len(texts)
    check_shards(rows, sorted(texts.items()))
    few = wavelet.read_shards(wavelet.write_shards(docs, WORDS, 2, shard_tokens=500))
    assert rows == sorted(few.collect(), key=lambda r: r.start)


def test_word_encoder_equals_library():
    draw = random.Random(4)
    enc = word_encoder(WORDS)
    assert np.frombuffer(enc.encode("hello <|endoftext|> world"), "<u4").tolist() == [3306, 49407, 1002]
    for text in ["<|startoftext|>a<|endoftext|>", "x<|ENDOFTEXT|> y", "<|endoftext|", "It's we'll 'S'D 5th a.b\x00c"]:
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == word_ids(text), repr(text)
    pool = "abc XYZ 019 !?.,'’ \t\n\x0b\x1d\x85  éÉßµªºÅ̊́ﬁİΣς漢字😀²½٣"
    for _ in range(400):
        text = "".join(draw.choice(pool) for _ in range(draw.randint(0, 40)))
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == word_ids(text), repr(text)


# -- 7 licenses ---------------------------------------------------------------------------

MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
       "documentation files (the Software), to deal in the Software without restriction, including without limitation "
       "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software")


def test_license_templates():
    s = licenses.Scanner(licenses.BASE, licenses.TEMPLATES)

    def labels(text):
        return {m[0] for m in s.matches(licenses.words_of(text))}

    assert labels("Released under the MIT License.") == {"mit"}
    assert labels(MIT) == {"mit"} and labels(MIT.replace("merge", "join")) == set()
    assert labels("Licensed under the Apache License, Version 2.0") == labels("under the apache license 2.0") == {"apache-2.0"}
    assert labels("GNU General Public License, either version 3") == {"gpl", "gpl-3.0"}
    assert labels("Copyright (c) 2020 Some Body. All rights reserved") == {"copyright-notice", "reserved"}
    assert labels("cc by nc 4.0") == {"cc-by", "cc-by-nc"} and labels("general license public") == set()


def test_license_compiler():
    a = licenses.compile_template("x", "a [b c] <2> d")
    s = licenses.Scanner({}, {"x": ["a [b c] <2> d"]})
    for text, ok in [("a d", 1), ("a b c d", 1), ("a b d", 1), ("a b c x y d", 1), ("a x y z d", 0), ("b c d", 0)]:
        assert bool(s.matches(text.encode().split())) == bool(ok), text
    assert a.accept == len(a.steps)
    for bad in ["", "[a", "<3> a", "[a]"]:
        with pytest.raises((ValueError, IndexError)):
            licenses.Scanner({}, {"x": [bad]})


def test_license_query_base(edge_docs, empty_docs, spark):
    extra = spark.createDataFrame([(50, "CC BY cc by, All Rights Reserved Ünder cc-by"), (51, "ccby by cc")], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.summarize(licenses.scan(edge_docs.select("doc_id", "text").unionByName(extra))).collect()}
    assert (got[50].n_words, got[50].n_base, got[50].first_word, got[50].last_word, got[50].base_labels) == (10, 4, 0, 8, "cc-by,reserved")
    assert (got[51].n_base, got[51].first_word, got[51].base_labels, got[51].labels, got[51].score) == (0, None, "", "", 0.0)
    assert (got[1].n_words, got[1].score) == (0, 0.0)
    assert licenses.summarize(licenses.scan(empty_docs)).collect() == []


# -- 8 near-duplicates --------------------------------------------------------------------

def brute_groups(rows, size=4):
    sets = []
    for k, t in rows:
        w = (t or "").encode().lower().split()
        sets.append((k, frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])))
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for x in s:
            holders[x].append(i)
    shared = Counter((a, b) for h in holders.values() for i, a in enumerate(h) for b in h[i + 1:])
    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a][1]) + len(sets[b][1]) - n):
            parent[root(a)] = root(b)
    least = {}
    for i, (k, _) in enumerate(sets):
        if k is not None:
            least[root(i)] = min(k, least.get(root(i), k))
    return [(k, len(s), least.get(root(i)) if s else k) for i, (k, s) in enumerate(sets)]


def check_groups(df, rows):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in neardup.group_near_duplicates(df).collect())
    assert got == Counter(brute_groups(rows))


def test_near_duplicates_edges(edge_docs, empty_docs):
    check_groups(edge_docs, EDGES)
    assert neardup.group_near_duplicates(empty_docs).collect() == []


def test_near_duplicates_chains_and_hot_groups(spark, monkeypatch):
    """Many edits of one text, so that buckets mix components, and blocks of a few rows."""
    draw = random.Random(2)
    base = [f"t{draw.randrange(10**6)}" for _ in range(120)]
    rows = []
    for k in range(150):
        words = list(base)
        for _ in range(draw.randint(0, 9)):
            words[draw.randrange(120)] = f"e{draw.randrange(10**6)}"
        rows.append((1000 - k, " ".join(words)))
    rows += rows[:20]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check_groups(df, rows)
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 20)
    check_groups(df, rows)


def test_near_duplicates_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check_groups(df, [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000 + i, 1000) for i in range(50)] + [(5, 5)]
    found = defaultdict(set)
    for r in components(spark.createDataFrame(edges, "a long, b long")).collect():
        found[r.component].add(r.node)
    assert sorted(map(len, found.values())) == [51 - 1, 201] and all(c in g for c, g in found.items())
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# -- 9 neighbours -------------------------------------------------------------------------

def test_neighbours_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    found = defaultdict(list)
    for r in QUERIES["op9_cross_polytope_neighbours"](spark, "/root/testdata/sf0.1").collect():
        found[r.query_id].append(r)
    x, ids, hit, n = np.array(rows.embedding.tolist(), float), rows.vec_id.to_numpy(), 0, 0
    for i in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        d[i] = np.inf
        near = sorted(found[ids[i]], key=lambda r: r["rank"])
        assert [r["rank"] for r in near] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in near] == sorted((r.score, r.vec_id) for r in near)
        hit += len({r.vec_id for r in near} & set(ids[np.lexsort((ids, d))[:10]].tolist()))
        n += 10
    assert hit / n >= 0.9


def test_neighbours_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0]), (2, [0.9, 0.1, 0.0]), (3, None), (4, [0.0, 0.0, 0.0]),
            (5, [nan, 1.0, 0.0]), (6, [inf, 1.0, 0.0]), (7, [None, 1.0, 0.0]), (8, [1.0, 1.0]), (9, [-1.0, 0.0, 5.0]),
            (100, [0.9, 0.1, 0.0]), (100, [0.9, 0.1, 0.0]), (None, [1.0, 0.0, 0.0]), (200, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, rank string")
    got = [(r.query_id, r["rank"], r.vec_id) for r in rows_of(ann.nearest(df, F.col("vec_id") % 100 == 0, k=3))]
    assert got == [(0, 1, 1), (0, 2, 2), (0, 3, 100), (100, 1, 2), (100, 2, 0), (100, 3, 1)]
    assert ann.nearest(df.where("false"), F.col("vec_id") % 100 == 0).collect() == []


def test_neighbours_blocks_and_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "GROUP_ROWS", 7)
    df = spark.range(300).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 3 == 0, F.array(F.lit(1.0), F.lit(2.0)))
                                 .otherwise(F.array(F.cos(F.col("id")), F.sin(F.col("id")))).alias("embedding"))
    got = {(r.query_id, r["rank"]): r.vec_id for r in ann.nearest(df, F.col("vec_id") % 100 == 0, k=5).collect()}
    assert [got[0, i] for i in range(1, 6)] == [3, 6, 9, 12, 15] and [got[300 - 300, i] for i in (1, 2)] == [3, 6]


@pytest.mark.parametrize("parts", [2, 3])
def test_neighbours_recall_with_several_rotations(spark, parts, monkeypatch):
    """The hash of larger tables: as many probes as the buckets of several rotations need."""
    monkeypatch.setattr(ann, "BUCKET_ROWS", 2000 / 128 ** parts)
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.toPandas()
    x, ids = np.array(rows.embedding.tolist(), float), rows.vec_id.to_numpy()
    assert len(ids) == 2000
    got = ann.nearest(df, F.col("vec_id") % 100 == 0).collect()
    found = defaultdict(set)
    for r in got:
        found[r.query_id].add(r.vec_id)
    hit = n = 0
    for i in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        d[i] = np.inf
        hit += len(found[ids[i]] & set(ids[np.lexsort((ids, d))[:10]].tolist()))
        n += 10
    assert len(got) == n and hit / n >= 0.9


# -- 10 byte BPE --------------------------------------------------------------------------

def test_byte_bpe_equals_library(edge_docs, empty_docs, docs, texts):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def expected(key, text):
        ids = np.array(other.encode_ordinary(text or ""), "<u4").tobytes()
        return key, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()

    args = RANKS, public_tokenizers.PATTERN
    assert Counter(map(tuple, byte_bpe.round_trip(edge_docs, *args).collect())) == Counter(expected(*r) for r in EDGES)
    assert Counter(map(tuple, byte_bpe.round_trip(docs, *args).collect())) == Counter(expected(*r) for r in texts.items())
    assert byte_bpe.round_trip(empty_docs, *args).collect() == []
    back = byte_bpe.decode_documents(byte_bpe.encode_documents(edge_docs, *args), *args).collect()
    assert Counter((r.doc_id, bytes(r.bytes)) for r in back) == Counter((k, (t or "").encode()) for k, t in EDGES)
    codec = byte_bpe.byte_bpe(*args)
    draw = random.Random(1)
    for _ in range(300):
        piece = bytes(draw.choice(b"aab \xc3\xa9xyz") for _ in range(draw.randint(1, 60)))
        assert b"".join(codec.tokens[i] for i in codec.merge(piece)) == piece
        text = "".join(draw.choice("aaab  \n\t'stéÉ漢1²!") for _ in range(draw.randint(0, 50)))
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == other.encode_ordinary(text), repr(text)


def test_every_operator_has_a_query():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(ORACLE) <= set(QUERIES)


def test_trie_steps_read_the_scores_of_the_path_from_lists():
    from revlens.llm.token_trie import TokenTrie
    trie = TokenTrie({"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -3.0, "▁ab": -4.0, "ba": -3.5})
    assert trie._step("▁ab", 3, [0.0, -3.0, -5.0], [0, 1, 2]) == (-4.0, 1)
    words = ["ab", "abab", "baab", "abé", "b", "abab"]
    assert [trie.count(w) for w in words] == [trie._alone("▁" + w) for w in words]
