"""Words found in unsegmented text, against a plain count."""

import math
import random
from collections import Counter, defaultdict

from revlens.operators.wordfind import find_words, runs, windows

LIMITS = dict(max_len=4, min_count=3, min_cohesion=1.5, min_entropy=0.6)


def _brute(texts, max_len, min_count, min_cohesion, min_entropy):
    n, left, right = Counter(), defaultdict(Counter), defaultdict(Counter)
    for text in texts:
        t = "".join((text or "").split())
        for i in range(len(t)):
            for k in range(1, min(max_len, len(t) - i) + 1):
                word = t[i:i + k]
                n[word] += 1
                left[word][t[i - 1] if i else "\n"] += 1
                right[word][t[i + k] if i + k < len(t) else "\n"] += 1
    n = {w: c for w, c in n.items() if c >= min_count}
    total = sum(c for w, c in n.items() if len(w) == 1)

    def entropy(beside):
        size = sum(beside.values())
        return -sum(c / size * math.log(c / size) for c in beside.values())

    out = {}
    for w, c in n.items():
        if len(w) > 1:
            row = (c, min(c * total / (n[w[:i]] * n[w[i:]]) for i in range(1, len(w))),
                   entropy(left[w]), entropy(right[w]))
            if row[1] >= min_cohesion and min(row[2:]) >= min_entropy:
                out[w] = tuple(round(x, 6) for x in row)
    return out


def _found(spark, texts, limits=LIMITS):
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "text string, n int")
    return {r["word"]: tuple(round(x, 6) for x in tuple(r)[1:]) for r in find_words(df, **limits).collect()}


def test_found_words_equal_a_plain_count(spark):
    rng = random.Random(5)
    words = ["好吃", "价位", "这个", "服务员", "的", "了", "😀笑", "ab"]
    texts = ["".join(rng.choice(words) for _ in range(rng.randrange(1, 40))) for _ in range(60)]
    texts += [texts[0], texts[0], None, "", " \n\t", "好 吃\n好\t吃", "的" * 3000]
    got = _found(spark, texts)
    assert got == _brute(texts, **LIMITS)
    assert {"好吃", "价位", "服务员", "😀笑"} <= set(got)
    assert "服务" not in got  # always goes on the same way


def test_edges_and_empty_tables(spark):
    assert _found(spark, []) == {}
    assert _found(spark, [None, "", "  "]) == {}
    assert _found(spark, ["好", "好", "好", "好"]) == {}
    seen = windows(spark.createDataFrame([("ab",), ("ab",)], "text string"), max_len=2)
    assert {(r.window, r.n) for r in seen.collect()} == {("\nab\n", 2), ("ab\n\n", 2)}
    rows = {r.word: (r.n, r.left_entropy) for r in runs(seen, 2, 1).collect()}
    assert rows == {"a": (2, 0.0), "b": (2, 0.0), "ab": (2, 0.0)}


def test_runs_are_counted_from_distinct_runs_one_longer(spark):
    """No row for each size and side of a window; every size of words equals a plain count."""
    texts = ["好吃价位", "好吃好吃", "的好吃", "a", "ab", "b", ""] * 3
    for max_len in (1, 2, 5):
        limits = dict(max_len=max_len, min_count=2, min_cohesion=0.0, min_entropy=0.0)
        assert _found(spark, texts, limits) == _brute(texts, **limits)
    seen = windows(spark.createDataFrame([(t,) for t in texts], "text string"), max_len=3)
    plan = runs(seen, 3, 2)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
