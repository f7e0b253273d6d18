"""Segmentation modes against brute force on small lexicons."""

import itertools
import math
import random
import time
from collections import Counter

import numpy as np
import pytest

from revlens.operators import segment as seg
from revlens.plans.pipeline import segmented

LEX = ["好吃", "好吃的", "吃的", "价位", "这个", "口味", "说不上", "特别", "好吃", " ", "", None]
TEXTS = ["这个价位这个口味就那样说不上特别好吃的", "好吃的好吃", "xyz", "", None, "ab\n好吃", "😀好吃😀的", "好\t吃@的."]
WORDS = {w for w in LEX if w and w.strip()}


def _frames(spark, texts=TEXTS, words=LEX):
    t = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return t, spark.createDataFrame([(w,) for w in words], "word string")


def _full(text, words=WORDS, longest=7):
    return {(p, text[p:p + k]) for p in range(len(text)) for k in range(2, longest + 1)
            if p + k <= len(text) and text[p:p + k] in words}


def _max(text, words=WORDS, longest=7):
    out, i = [], 0
    while i < len(text):
        k = next((k for k in range(longest, 1, -1) if text[i:i + k] in words and i + k <= len(text)), 1)
        out.append(text[i:i + k])
        i += k
    return out


def _mmseg(text, words, longest=7, counts=None):
    def sizes(i):
        return [k for k in range(min(longest, len(text) - i), 1, -1) if text[i:i + k] in words] + [1]

    out, i = [], 0
    while i < len(text):
        best = None
        for a in sizes(i):
            for b in (sizes(i + a) if i + a < len(text) else [0]):
                for c in (sizes(i + a + b) if b and i + a + b < len(text) else [0]):
                    got = [x for x in (a, b, c) if x]
                    mean = sum(got) / len(got)
                    at = [i, i + a, i + a + b]
                    free = sum(math.floor(1e6 * math.log(counts[text[p]])) for p, x in zip(at, (a, b, c)) if x == 1) if counts else 0
                    score = (sum(got), mean, -round(sum((x - mean) ** 2 for x in got) / len(got), 9), free, a)
                    best = max(best or score, score)
        out.append(text[i:i + best[4]])
        i += best[4]
    return out


def _by_doc(rows, *fields):
    got = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r[fields[0]])):
        got.setdefault(r.doc_id, []).append(r.word)
    return got


def test_full_positions_are_code_points(spark):
    got = {}
    for r in seg.segment(*_frames(spark), "full").collect():
        got.setdefault(r.doc_id, []).append((r.pos, r.word))
    for i, text in enumerate(TEXTS):
        assert sorted(got.get(i, [])) == sorted(_full(text or ""))  # lists: no repeated match either


def _uncovered(text, words=WORDS):
    over = {i for p, w in _full(text, words) for i in range(p, p + len(w))}
    return {(p, c) for p, c in enumerate(text) if p not in over}


@pytest.mark.parametrize("bound", [500_000, 0])
def test_full_gives_the_characters_that_no_word_covers(spark, monkeypatch, bound):
    monkeypatch.setattr(seg, "BROADCAST_WORDS", bound)
    want = {i: sorted(_full(x or "") | _uncovered(x or "")) for i, x in enumerate(TEXTS)}
    got = {i: [] for i in want}
    for r in seg.segment(*_frames(spark), "full", uncovered=True).collect():
        got[r.doc_id].append((r.pos, r.word))
    assert {i: sorted(x) for i, x in got.items()} == want
    lists = {r.doc_id: r.words for r in seg.segment_lists(*_frames(spark), "full", uncovered=True).collect()}
    assert {i: Counter(x) for i, x in lists.items()} == {i: Counter(w for _, w in x) for i, x in want.items()}
    marks = seg.segment(*_frames(spark), "full", uncovered=True, keep_unknown=False, keep_marks="@.").collect()
    assert sorted(r.word for r in marks) == sorted([*(w for x in TEXTS for _, w in _full(x or "")), "@", "."])
    assert [r.word for r in seg.segment(*_frames(spark, ["ab"], []), "full", uncovered=True).collect()] == ["a", "b"]


def test_segment_full_leaves_no_character_out(spark):
    from conftest import SF_SMALL
    from revlens.plans.queries import QUERIES, _unsegmented
    over = {r.doc_id: set() for r in _unsegmented(spark, SF_SMALL).collect()}
    for r in QUERIES["segment_full"](spark, SF_SMALL).collect():
        over[r.doc_id] |= set(range(r.pos, r.pos + len(r.word)))
    assert all(over[r.doc_id] == set(range(len(r.text))) for r in _unsegmented(spark, SF_SMALL).collect())


def test_max_match_and_search(spark):
    got = _by_doc(seg.segment(*_frames(spark), "max_match").collect(), "idx")
    want = set()
    for i, text in enumerate(TEXTS):
        assert got.get(i, []) == _max(text or "")
        for idx, tok in enumerate(_max(text or "")):
            want.add((i, idx, 0, tok))
            want |= {(i, idx, p, w) for p, w in _full(tok) if w != tok}
    rows = [(r.doc_id, r.idx, r.off, r.word) for r in seg.segment(*_frames(spark), "search").collect()]
    assert sorted(rows) == sorted(want)


@pytest.mark.parametrize("mode", ["full", "max_match", "search", "mmseg"])
def test_every_mode_takes_every_setting(spark, mode):
    t, lex = _frames(spark, ["的好吃@x", ""], ["好吃", "吃@", "的好"])
    order = "pos" if mode == "full" else "idx"
    rows = seg.segment(t, lex, mode, max_len=8, min_len=2, keep_unknown=False, clear_stop_words=True,
                       keep_marks="@").collect()
    assert [r.word for r in sorted(rows, key=lambda r: r[order])] == {
        "full": ["的好", "好吃", "吃@"], "max_match": ["的好", "吃@"], "search": ["的好", "吃@"], "mmseg": ["的好", "吃@"]}[mode]


def test_kept_marks_and_stop_words(spark):
    t, lex = _frames(spark, ["的a@b，好吃"], ["好吃"])
    words = lambda **s: [r.word for r in sorted(seg.segment(t, lex, **s).collect(), key=lambda r: r.idx)]
    assert words() == ["的", "a", "@", "b", "，", "好吃"]
    assert words(clear_stop_words=True) == ["a", "@", "b", "好吃"]
    assert words(keep_unknown=False) == ["@", "好吃"]


def test_long_words_and_inner_words_of_any_length(spark):
    t, lex = _frames(spark, ["abcdefgh", "abcdefg"], ["abcdefgh", "cde", "abcdefg"])
    got = {(r.doc_id, r.off, r.word) for r in seg.segment(t, lex, "search", max_len=8).collect()}
    assert got == {(0, 0, "abcdefgh"), (0, 0, "abcdefg"), (0, 2, "cde"), (1, 0, "abcdefg"), (1, 2, "cde")}
    long = "x" * 15 + "y" * 15
    t, lex = _frames(spark, [long + "z"], [long])
    assert [r.word for r in seg.segment(t, lex, max_len=40).collect()] == [long, "z"]


@pytest.mark.parametrize("mode", ["max_match", "search", "mmseg"])
def test_empty_lexicon_leaves_characters(spark, mode):
    t, lex = _frames(spark, ["a b", None], [])
    assert sorted((r.idx, r.word) for r in seg.segment(t, lex, mode).collect()) == [(0, "a"), (1, " "), (2, "b")]
    assert seg.segment(t, lex, "full").collect() == []


def test_large_lexicons_give_the_same_rows(spark, monkeypatch):
    small = {m: sorted(map(tuple, seg.segment(*_frames(spark), m).collect())) for m in seg.MODES}
    monkeypatch.setattr(seg, "BROADCAST_WORDS", 0)
    monkeypatch.setattr("revlens.operators.joins.ROWS_PER_SALT", 1)
    for mode, rows in small.items():
        assert sorted(map(tuple, seg.segment(*_frames(spark), mode).collect())) == rows


def test_mmseg_chunk_rules(spark):
    words = ["研究", "研究生", "生命", "起源", "主要", "要是", "因为", "是因"]
    texts = ["研究生命起源", "主要是因为", "x研究生", "", "研究研究生命生命起", "是因为主要是"]
    got = _by_doc(seg.segment(*_frames(spark, texts, words), "mmseg").collect(), "idx")
    # rule 3 prefers 研究/生命/起源 over 研究生/命/起源; ties keep the longest first word
    assert got[0] == ["研究", "生命", "起源"] and got[1] == ["主要", "是因", "为"] and got[2] == ["x", "研究生"]
    for i, text in enumerate(texts):
        assert got.get(i, []) == _mmseg(text, set(words))


def test_mmseg_rule_4_decides_what_rules_1_to_3_leave(spark):
    """Two chunks of the same lengths, one with 'a' as a word of its own, one with 'd'."""
    words, texts = ["bc", "ab", "cd"], ["abcd", "dabcd", "d d d"]
    t, lex = _frames(spark, texts, words)
    # "abc" alone: ab/c and a/bc are alike to rules 1-3
    t2, lex2 = _frames(spark, ["abc"], ["ab", "bc"])
    def tokens(counts):
        chars = spark.createDataFrame(list(counts.items()), "char string, n long")
        return [r.word for r in sorted(seg.segment(t2, lex2, "mmseg", chars=chars).collect(), key=lambda r: r.idx)]
    assert tokens({"a": 9, "c": 2}) == ["a", "bc"] and tokens({"a": 2, "c": 9}) == ["ab", "c"]
    assert tokens({"a": 2, "c": 2}) == ["ab", "c"]  # still equal: the longest first word
    counts = Counter("".join(texts))
    got = _by_doc(seg.segment(t, lex, "mmseg", chars=seg.char_counts(t)).collect(), "idx")
    for i, text in enumerate(texts):
        assert got[i] == _mmseg(text, set(words), counts=counts)


def _random_texts(draw, n, letters, longest):
    words = {"".join(draw.choices(letters, k=draw.randint(2, 4))): draw.randint(1, 500) for _ in range(25)}
    return ["".join(draw.choices(letters + "é😀\n", k=draw.randint(0, longest))) for _ in range(n)], words


@pytest.mark.parametrize("large", [False, True])
def test_random_texts_in_every_mode(spark, monkeypatch, large):
    draw = random.Random(5)
    texts, words = _random_texts(draw, 40, "abc", 30)
    monkeypatch.setattr(seg, "STEP_CHARS", 70)
    if large:
        monkeypatch.setattr(seg, "BROADCAST_WORDS", 0)
    t = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lex = spark.createDataFrame(list(words.items()), "word string, n long")
    counts = Counter("".join(texts))
    for mode, brute in (("max_match", lambda x: _max(x, words)), ("mmseg", lambda x: _mmseg(x, words, counts=counts))):
        got = _by_doc(seg.segment(t, lex, mode, chars=seg.char_counts(t)).collect(), "idx")
        assert [got.get(i, []) for i in range(len(texts))] == [brute(x) for x in texts], mode
    got = {}
    for r in seg.segment(t, lex, "full").collect():
        got.setdefault(r.doc_id, []).append((r.pos, r.word))
    assert [sorted(got.get(i, [])) for i in range(len(texts))] == [sorted(_full(x, words)) for x in texts]


def _weight(path, words):
    total = sum(words.values())
    return sum(math.floor(1e6 * math.log(words.get(w, 1))) - math.floor(1e6 * math.log(total)) for w in path)


def _paths(text, words):
    if not text:
        yield []
    for k in range(1, min(7, len(text)) + 1):
        if k == 1 or text[:k] in words:
            for rest in _paths(text[k:], words):
                yield [text[:k], *rest]


@pytest.mark.parametrize("large", [False, True])
def test_best_path_among_all_paths(spark, monkeypatch, large):
    if large:
        monkeypatch.setattr(seg, "BROADCAST_WORDS", 0)
    draw = random.Random(7)
    texts, words = _random_texts(draw, 60, "abcd", 12)
    t = spark.createDataFrame([*enumerate(texts), (100, None)], "doc_id long, text string")
    lex = spark.createDataFrame(list(words.items()), "word string, n long")
    got = _by_doc(seg.segment(t, lex, "best_path").collect(), "idx")
    for i, text in enumerate(texts):
        best = max(_weight(p, words) for p in _paths(text, words))
        equal = [p for p in _paths(text, words) if _weight(p, words) == best]
        assert got.get(i, []) == max(equal, key=lambda p: [len(w) for w in p]), text
    # frequent short words win over a rare long one
    lex = spark.createDataFrame([("ab", 1000), ("cd", 1000), ("abcd", 1)], "word string, n long")
    t = spark.createDataFrame([(0, "abcd")], "doc_id long, text string")
    assert _by_doc(seg.segment(t, lex, "best_path").collect(), "idx")[0] == ["ab", "cd"]
    assert _by_doc(seg.segment(t, lex, "max_match").collect(), "idx")[0] == ["abcd"]


def test_rows_that_share_a_key_are_texts_of_their_own(spark, monkeypatch):
    t, lex = _frames(spark, ["x"], ["ab", "bc"])
    t = spark.createDataFrame([(1, "abc"), (1, "bcab"), (None, "ab"), (None, "zab")], "doc_id long, text string")
    want = Counter([(1, 0, "ab"), (1, 1, "c"), (1, 0, "bc"), (1, 1, "ab"), (None, 0, "ab"), (None, 0, "z"), (None, 1, "ab")])
    assert Counter(map(tuple, seg.segment(t, lex).collect())) == want
    lists = Counter((r.doc_id, tuple(r.words)) for r in seg.segment_lists(t, lex).collect())
    assert lists == Counter([(1, ("ab", "c")), (1, ("bc", "ab")), (None, ("ab",)), (None, ("z", "ab"))])
    monkeypatch.setattr(seg, "BROADCAST_WORDS", 0)
    assert Counter(map(tuple, seg.segment(t, lex).collect())) == want


def test_lists_equal_tokens(spark):
    for mode in seg.MODES:
        rows = seg.segment(*_frames(spark), mode, clear_stop_words=True).collect()
        want = {i: Counter() for i in range(len(TEXTS))}
        for r in rows:
            want[r.doc_id][r.word] += 1
        got = {r.doc_id: Counter(r.words) for r in seg.segment_lists(*_frames(spark), mode, clear_stop_words=True).collect()}
        assert got == want, mode


def test_long_texts_take_linear_time():
    """Ten times the text, about ten times the seconds, in every mode."""
    trie = seg.Trie(["ab", "abc", "bca", "cab", "aa"], np.array([5, 4, 3, 2, 1]))
    seconds = {}
    for n in (100_000, 1_000_000):
        chars = np.frombuffer(("abcabdaabca" * (n // 11)).encode("utf-32-le"), np.uint32)
        begins = np.array([0, len(chars)])
        for mode in seg.MODES:
            t0 = time.perf_counter()
            t = seg._Texts(chars, begins, *trie.find(chars, np.full(len(chars), len(chars))), trie.words, trie.weights)
            seg._tokens(t, mode, seg.Settings(), {}, 15)
            seconds[mode, n] = time.perf_counter() - t0
    assert all(seconds[m, 1_000_000] < 40 * seconds[m, 100_000] + 1 for m in seg.MODES)


def test_trie_holds_any_words():
    draw = random.Random(1)
    words = sorted({"".join(draw.choices("ab漢😀", k=draw.randint(1, 6))) for _ in range(300)})
    trie = seg.Trie(words, np.arange(len(words)))
    text = "".join(draw.choices("ab漢😀z", k=500))
    chars = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    got = list(zip(*(x.tolist() for x in trie.find(chars, np.full(500, 500)))))
    want = [(p, k, text[p:p + k]) for p, k in itertools.product(range(500), range(1, 7)) if p + k <= 500 and text[p:p + k] in words]
    assert [(p, k, trie.words[w].as_py()) for p, k, w in got] == want
    assert all(words[int(trie.weights[w])] == trie.words[w].as_py() for _, _, w in got)


def test_lexicon_by_count(spark):
    docs = spark.createDataFrame([(["aa", "aa", "b", "cc"],), (["aa", "cc", "dddddddd"],)], "words array<string>")
    assert sorted(map(tuple, seg.lexicon_by_count(docs, 2).collect())) == [("aa", 3), ("cc", 2)]


def test_tokenizer_for_the_models(spark):
    docs = spark.createDataFrame([(1, "好 吃 的 r2d2"), (2, "")], "doc_id long, document string")
    lex = spark.createDataFrame([("好吃",), ("r2d2",)], "word string")
    got = {r.doc_id: r.words for r in segmented("max_match", lex, despaced=True, stop_words=True)(docs).collect()}
    assert got == {1: ["好吃", "r2d2"], 2: []}
    parts = segmented("max_match", spark.createDataFrame([("ab12",)], "word string"), latin_parts=True)
    assert parts(spark.createDataFrame([(1, "ab12")], "doc_id long, document string")).first().words == ["ab12", "ab", "12"]


def test_numerals_are_read_while_segmenting(spark):
    texts, lexicon = _frames(spark, ["这个价位三百二十", "一二三好吃的", None], [*LEX, "320"])
    for mode in ("max_match", "mmseg", "best_path", "search"):
        rows = seg.segment_lists(texts, lexicon, mode, numerals=True).collect()
        got = {r.doc_id: r.words for r in rows}
        assert got[0][:3] == ["这个", "价位", "320"] and got[1][:3] == ["1", "2", "3"] and got[2] == []
    hits = {(r.doc_id, r.pos, r.word) for r in seg.segment(texts, lexicon, "full", numerals=True).collect()}
    assert (0, 4, "320") in hits and (1, 3, "好吃的") in hits


def test_the_walk_looks_steps_up_and_searches_large_tries(monkeypatch):
    import numpy as np
    from revlens.operators import segment as seg
    words, text = ["ab", "abc", "b", "😀c", "caé"], "abcaéz😀cabc"
    chars, ends = np.frombuffer(text.encode("utf-32-le"), np.uint32), np.full(len(text), len(text))
    want = sorted((i, len(w), w) for i in range(len(text)) for w in words if text.startswith(w, i))
    for cells in (seg.TABLE_STEPS, 0):
        monkeypatch.setattr(seg, "TABLE_STEPS", cells)
        trie = seg.Trie(words, np.ones(len(words), np.int64))
        assert (trie.table is None) == (cells == 0)
        place, size, word = trie.find(chars, ends)
        assert [(p, k, trie.words[w].as_py()) for p, k, w in zip(place.tolist(), size.tolist(), word.tolist())] == want


@pytest.mark.parametrize("bound", [500_000, 0])
def test_counts_equal_the_counted_lists(spark, monkeypatch, bound):
    """Terms are counted where a text is segmented, whatever the mode; stop words and carried columns too."""
    from pyspark.sql import functions as F
    from revlens.operators.features import EXACT, MD5_16, term_counts
    monkeypatch.setattr(seg, "BROADCAST_WORDS", bound)
    monkeypatch.setattr(seg, "OUT_ROWS", 3)
    t, lex = _frames(spark, [*TEXTS, "的\0好吃了吧"], [*LEX, "的好"])
    t = t.withColumn("split", F.when(F.col("doc_id") > 2, F.lit("test")))
    for mode in seg.MODES if bound else ["full", "search"]:
        for settings in ({}, {"clear_stop_words": True, "uncovered": True}):
            lists = seg.segment_lists(t, lex, mode, **settings).join(t.select("doc_id", "split"), "doc_id")
            want = term_counts(lists, hashing=MD5_16, carry=["split"])
            got = seg.segment_counts(t, lex, MD5_16, mode, carry=["split"], **settings)
            assert got.schema == want.schema and Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    with pytest.raises(ValueError, match="md5"):
        seg.segment_counts(t, lex, EXACT)
