"""DuckDB SQL for each registered query (same names, same columns, same rounding).

The SQL is an independent restatement over the same parquet views (``documents``,
``labels``, ...): window ``row_number`` where the Spark plan avoids a global sort,
``string_split`` where Spark uses a regex split, and so on.
"""

from __future__ import annotations

from typing import NamedTuple


class _Policy(NamedTuple):
    negatives: tuple[int, ...]
    positives: tuple[int, ...]
    binary: bool
    distinct: bool
    reading: str


# Fixed values, restated here rather than taken from the package under test.
POLICIES = {
    "multi": _Policy((1, 2, 3), (5,), False, False, "jvm"),
    "multi_distinct": _Policy((1, 2, 3), (5,), False, True, "python"),
    "binary_drop4": _Policy((1, 2, 3), (5,), True, False, "jvm"),
    "binary_4neg": _Policy((1, 2, 3, 4), (5,), True, True, "python"),
}
WORD = r"\p{L}+|\p{N}+"
WORD_MARK = r"\p{L}+|\p{N}+|[^\p{L}\p{N}\s]"
WORD_KEEP = r"[\p{L}\p{N}]+(?:[@#%.&+]+[\p{L}\p{N}]+)*"
# The stop words, in natural order.
STOP = ("['', ' ', '，', '的', '。', '了', '！', '是', '就', '吧', '?', '…', '、', '～', '~', "
        "'很', '都', '也', '还']")

REVIEW_LINES = r"""
rl AS (
  SELECT d.doc_id,
         (CASE WHEN d.doc_id % 97 = 0 THEN ''
               WHEN d.doc_id % 89 = 0 THEN 'Rating'
               WHEN l.quality = 1 THEN '5'
               WHEN l.quality = 0 THEN CAST(1 + d.doc_id % 3 AS VARCHAR)
               ELSE '4' END)
         || chr(9) || regexp_replace(d.text, '[\r\n\t]+', ' ', 'g') AS line
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

PARSE_JVM = r"""
pj AS (
  SELECT doc_id, f[1] AS rating_txt,
         CASE WHEN regexp_full_match(f[1], '[+-]?[0-9]+') THEN TRY_CAST(f[1] AS INTEGER) END AS rating,
         f[2] AS document
  FROM (SELECT doc_id, string_split(regexp_replace(line, '\t+$', ''), chr(9)) AS f FROM rl)
  WHERE len(f) = 2 AND f[1] <> 'Rating')"""


def parse_python(src: str = "rl", name: str = "pp") -> str:
    return f"""
{name} AS (
  SELECT doc_id, f[1] AS rating_txt, TRY_CAST(f[1] AS INTEGER) AS rating, f[2] AS document
  FROM (SELECT doc_id, string_split(line, chr(9)) AS f FROM {src})
  WHERE len(f) = 2)"""


DISTINCT_LINES = """
dl AS (SELECT min(doc_id) AS doc_id, line FROM rl GROUP BY line)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def label_ctes(policy: str) -> str:
    """CTEs ending in ``lab(doc_id, label, document)``."""
    p = POLICIES[policy]
    ratings = ", ".join(str(r) for r in p.negatives + p.positives)
    lab = "CASE WHEN rating > 4 THEN 1 ELSE 0 END" if p.binary else "rating"
    if p.reading == "jvm":
        parsed = [REVIEW_LINES, PARSE_JVM]
        src = "pj"
    else:
        parsed = [REVIEW_LINES]
        if p.distinct:
            parsed.append(DISTINCT_LINES)
        parsed.append(parse_python("dl" if p.distinct else "rl", "pp"))
        src = "pp"
    if p.reading == "jvm" and p.distinct:
        raise NotImplementedError
    labq = f"""
lab AS (SELECT doc_id, CAST({lab} AS INTEGER) AS label, document FROM {src}
        WHERE rating IN ({ratings}))"""
    return ",".join(parsed + [labq])


def balanced_ctes(policy: str) -> str:
    """CTEs ending in ``bal(doc_id, label, document)``: first n positives by md5 order."""
    pos = 1 if POLICIES[policy].binary else POLICIES[policy].positives[0]
    return label_ctes(policy) + f""",
neg AS (SELECT doc_id, label, document FROM lab WHERE label <> {pos}),
pos AS (SELECT doc_id, label, document,
               row_number() OVER (ORDER BY md5('balance' || CAST(doc_id AS VARCHAR)), doc_id) AS rn
        FROM lab WHERE label = {pos}),
bal AS (SELECT * FROM neg
        UNION ALL
        SELECT doc_id, label, document FROM pos WHERE rn <= (SELECT count(*) FROM neg))"""


# 60 % of the hash space: 0.6 * 16**8 = 2576980377 = 0x99999999; seed 1234.
SPLIT_EXPR = ("CASE WHEN substr(md5('split:1234:' || CAST(doc_id AS VARCHAR)), 1, 8) "
              "< '99999999' THEN 'train' ELSE 'test' END")
MD5_TERM = "('0x' || substr(md5(w), 1, 4))::INTEGER"
MODEL_TERM = "('0x' || substr(md5(w), 1, 5))::INTEGER"
MODEL_BUCKETS = 1048576
PATTERN_TOKENS = f"SELECT doc_id, unnest(regexp_extract_all(lower(document), '{WORD}', 0)) AS w FROM sp"


def experiment_ctes(policy: str, fit_on: str = "train", tokens: str = PATTERN_TOKENS, before: str = "",
                    seen_only: bool = False) -> str:
    """CTEs of one training run: split, term counts (md5 buckets), IDF, TF-IDF, NB sums, priors;
    classes from the policy. ``before`` holds CTEs over ``sp`` that ``tokens`` reads.
    ``seen_only``: the vocabulary is what the training rows hold, other terms drop out."""
    p = POLICIES[policy]
    k = 2 if p.binary else len(p.negatives) + 1
    vocabulary = "(SELECT count(*) FROM idf)" if seen_only else MODEL_BUCKETS
    return balanced_ctes(policy) + f""",
sp AS (SELECT doc_id, label, document, {SPLIT_EXPR} AS split FROM bal),{before}
train AS (SELECT doc_id, label FROM sp WHERE split = 'train'),
test AS (SELECT doc_id, label FROM sp WHERE split = 'test'),
tok AS ({tokens}),
tc AS (SELECT doc_id, {MODEL_TERM} AS term, count(*) AS tf FROM tok GROUP BY 1, 2),
m AS (SELECT count(*) AS m FROM {"train" if fit_on == "train" else "sp"}),
idf AS (SELECT term, count(*) AS df,
               ln(((SELECT m FROM m) + 1.0) / (count(*) + 1.0)) AS idf
        FROM tc WHERE doc_id IN (SELECT doc_id FROM {"train" if fit_on == "train" else "sp"})
        GROUP BY term),
x AS (SELECT tc.doc_id, tc.term, tc.tf * coalesce(idf.idf, ln((SELECT m FROM m) + 1.0)) AS v
      FROM tc {"" if seen_only else "LEFT "}JOIN idf ON tc.term = idf.term),
sums AS (SELECT t.label, x.term, sum(x.v) AS s FROM x JOIN train t ON x.doc_id = t.doc_id
         GROUP BY 1, 2),
cls AS (SELECT label, count(*) AS n FROM train GROUP BY label),
pri AS (SELECT c.label, c.n AS n_docs,
               ln((c.n + 1.0) / ((SELECT sum(n) FROM cls) + {k} * 1.0)) AS pi,
               ln(coalesce((SELECT sum(s) FROM sums WHERE sums.label = c.label), 0) + {vocabulary} * 1.0)
                 AS log_norm
        FROM cls c),
xs AS (SELECT doc_id, sum(v) AS xsum FROM x GROUP BY doc_id),
sw AS (SELECT x.doc_id, s.label, sum(x.v * ln(1 + s.s / 1.0)) AS sw
       FROM x JOIN sums s ON x.term = s.term GROUP BY 1, 2),
sc AS (SELECT t.doc_id, t.label, p.label AS cls,
              p.pi + coalesce(xs.xsum, 0) * (ln(1.0) - p.log_norm) + coalesce(sw.sw, 0) AS score
       FROM test t CROSS JOIN pri p
       LEFT JOIN xs ON xs.doc_id = t.doc_id
       LEFT JOIN sw ON sw.doc_id = t.doc_id AND sw.label = p.label),
pred AS (SELECT doc_id, label, cls AS prediction FROM (
           SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, cls) AS rn
           FROM sc) WHERE rn = 1)"""


def svm_ctes(policy: str = "binary_drop4", iterations: int = 100, step: float = 1.0,
             reg: float = 0.01, tol: float = 0.001, **experiment) -> str:
    """The SVM iterations unrolled: one group of materialized CTEs per iteration, ending in
    ``wf(term, w)`` (final weights) and ``spred(doc_id, label, prediction)``."""
    import math
    parts = [experiment_ctes(policy, **experiment) + """,
xtr AS MATERIALIZED (SELECT x.doc_id, x.term, x.v, (2 * t.label - 1)::DOUBLE AS ys
                     FROM x JOIN train t ON x.doc_id = t.doc_id),
ntr AS (SELECT count(*)::DOUBLE AS n FROM train),
w0 AS MATERIALIZED (SELECT 0::INTEGER AS term, 0.0::DOUBLE AS w WHERE false),
c0 AS MATERIALIZED (SELECT false AS stop)"""]
    for t in range(1, iterations + 1):
        s = step / math.sqrt(t)
        conv = "false" if t == 1 else f"""(SELECT sqrt(sum((coalesce(u.w, 0) - coalesce(a.w, 0)) ^ 2))
                  < {tol!r} * greatest(sqrt(sum(coalesce(u.w, 0) ^ 2)), 1.0)
           FROM u{t} u FULL JOIN w{t-1} a ON u.term = a.term)"""
        parts.append(f"""
m{t} AS MATERIALIZED (SELECT x.doc_id, x.ys, sum(x.v * coalesce(w.w, 0)) AS m
        FROM xtr x LEFT JOIN w{t-1} w ON x.term = w.term GROUP BY x.doc_id, x.ys),
g{t} AS (SELECT x.term, sum(-x.ys * x.v) / (SELECT n FROM ntr) AS g
        FROM xtr x JOIN m{t} m ON x.doc_id = m.doc_id WHERE m.ys * m.m < 1 GROUP BY x.term),
u{t} AS MATERIALIZED (SELECT coalesce(a.term, b.term) AS term,
               coalesce(a.w, 0) * (1 - {s!r} * {reg!r}) - {s!r} * coalesce(b.g, 0) AS w
        FROM w{t-1} a FULL JOIN g{t} b ON a.term = b.term),
c{t} AS MATERIALIZED (SELECT (SELECT stop FROM c{t-1}) OR {conv} AS stop),
w{t} AS MATERIALIZED (SELECT term, w FROM u{t} WHERE NOT (SELECT stop FROM c{t-1})
        UNION ALL SELECT term, w FROM w{t-1} WHERE (SELECT stop FROM c{t-1}))""")
    parts.append(f"""
wf AS (SELECT term, w FROM w{iterations}),
smg AS (SELECT x.doc_id, sum(x.v * w.w) AS margin FROM x JOIN wf w ON x.term = w.term
        GROUP BY x.doc_id),
spred AS (SELECT t.doc_id, t.label,
                 CASE WHEN coalesce(s.margin, 0) > 0 THEN 1 ELSE 0 END AS prediction
          FROM test t LEFT JOIN smg s ON s.doc_id = t.doc_id)""")
    return ",".join(parts)


ACCURACY = """
SELECT count(*)::BIGINT AS n_test,
       coalesce(sum(CASE WHEN label = prediction THEN 1 ELSE 0 END), 0)::BIGINT AS n_correct,
       round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS accuracy
FROM pred"""

TOP_WORDS = f"""
WITH w AS (SELECT unnest(regexp_extract_all(lower(text), '{WORD}', 0)) AS word FROM documents),
c AS (SELECT word, count(*)::BIGINT AS n FROM w GROUP BY word),
t AS (SELECT word, n FROM c ORDER BY n DESC, word LIMIT 100)"""

LEX = f"""
lw AS (SELECT unnest(regexp_extract_all(lower(text), '{WORD}', 0)) AS word FROM documents),
lex AS (SELECT word FROM lw WHERE length(word) BETWEEN 2 AND 7 GROUP BY word HAVING count(*) >= 25)"""

HITS = """
ch AS (SELECT doc_id, unnest(cs) AS c, (generate_subscripts(cs, 1) - 1) AS p
       FROM (SELECT doc_id, string_split(t, '') AS cs FROM t WHERE length(t) > 0)),
ld AS (SELECT doc_id, p, c AS c0, lead(c, 1) OVER w AS c1, lead(c, 2) OVER w AS c2, lead(c, 3) OVER w AS c3,
              lead(c, 4) OVER w AS c4, lead(c, 5) OVER w AS c5, lead(c, 6) OVER w AS c6
       FROM ch WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
g AS (SELECT doc_id, p, c0||c1 AS word FROM ld WHERE c1 IS NOT NULL
      UNION ALL SELECT doc_id, p, c0||c1||c2 AS word FROM ld WHERE c2 IS NOT NULL
      UNION ALL SELECT doc_id, p, c0||c1||c2||c3 AS word FROM ld WHERE c3 IS NOT NULL
      UNION ALL SELECT doc_id, p, c0||c1||c2||c3||c4 AS word FROM ld WHERE c4 IS NOT NULL
      UNION ALL SELECT doc_id, p, c0||c1||c2||c3||c4||c5 AS word FROM ld WHERE c5 IS NOT NULL
      UNION ALL SELECT doc_id, p, c0||c1||c2||c3||c4||c5||c6 AS word FROM ld WHERE c6 IS NOT NULL),
hits AS (SELECT g.doc_id, g.p, g.word, length(g.word) AS l FROM g JOIN lex ON g.word = lex.word)"""

LONGEST = """
best AS (SELECT doc_id, p, max(l) AS l, arg_max(word, l) AS word FROM hits GROUP BY 1, 2)"""

UNCOVERED = """
bare AS (SELECT doc_id, p, c FROM (
           SELECT ch.doc_id, ch.p, ch.c, max(b.p + b.l) OVER (PARTITION BY ch.doc_id ORDER BY ch.p) AS reach
           FROM ch LEFT JOIN best b ON b.doc_id = ch.doc_id AND b.p = ch.p)
         WHERE coalesce(reach, 0) <= p)"""

CHUNKS = """
fr AS (SELECT c, floor(1000000 * ln(count(*)))::BIGINT AS f FROM ch GROUP BY c),
fc AS (SELECT ch.doc_id, ch.p, fr.f FROM ch JOIN fr ON fr.c = ch.c),
sz AS (SELECT s.doc_id, s.p, s.l, CASE WHEN s.l = 1 THEN fc.f ELSE 0 END AS f
       FROM (SELECT DISTINCT doc_id, p, l FROM hits UNION SELECT doc_id, p, 1 FROM ch) s
       JOIN fc ON fc.doc_id = s.doc_id AND fc.p = s.p),
k2 AS (SELECT a.doc_id, a.p, a.l AS a, coalesce(b.l, 0) AS b, a.f + coalesce(b.f, 0) AS f
       FROM sz a SEMI JOIN hits h ON h.doc_id = a.doc_id AND h.p = a.p
       LEFT JOIN sz b ON b.doc_id = a.doc_id AND b.p = a.p + a.l),
k3 AS (SELECT k.doc_id, k.p, k.a, k.b, coalesce(c.l, 0) AS c, k.f + coalesce(c.f, 0) AS f
       FROM k2 k LEFT JOIN sz c ON k.b > 0 AND c.doc_id = k.doc_id AND c.p = k.p + k.a + k.b),
pick AS (SELECT doc_id, p, a AS l FROM (
           SELECT doc_id, p, a, row_number() OVER (PARTITION BY doc_id, p ORDER BY a + b + c DESC,
                    (b > 0)::INT + (c > 0)::INT, a * a + b * b + c * c, f DESC, a DESC) AS rn FROM k3)
         WHERE rn = 1 AND a > 1),
best AS (SELECT k.doc_id, k.p, k.l, h.word FROM pick k JOIN hits h ON h.doc_id = k.doc_id AND h.p = k.p AND h.l = k.l)"""

FOLD = """
fold AS (SELECT doc_id, list_reduce(
           list_prepend({'p': -1::BIGINT, 'e': 0::BIGINT, 'got': []::BIGINT[]},
                        list({'p': p::BIGINT, 'e': (p + l)::BIGINT, 'got': []::BIGINT[]} ORDER BY p)),
           lambda a, x: CASE WHEN x.p >= a.e THEN {'p': x.p, 'e': x.e, 'got': list_append(a.got, x.p)} ELSE a END).got AS got
         FROM best GROUP BY doc_id),
chosen AS (SELECT b.doc_id, b.p, b.l, b.word FROM (SELECT doc_id, unnest(got) AS p FROM fold) f
           JOIN best b ON b.doc_id = f.doc_id AND b.p = f.p),
cover AS (SELECT ch.doc_id, ch.p, coalesce(k.word, ch.c) AS word, k.l,
                 max(k.p + k.l) OVER (PARTITION BY ch.doc_id ORDER BY ch.p) AS reach
          FROM ch LEFT JOIN chosen k ON k.doc_id = ch.doc_id AND k.p = ch.p),
mm AS (SELECT doc_id, word, (row_number() OVER (PARTITION BY doc_id ORDER BY p) - 1)::INTEGER AS idx
       FROM cover WHERE l IS NOT NULL OR coalesce(reach, 0) <= p)"""

# no word reaches over a place where a stretch begins, so each stretch has a best path of its own;
# ``v`` holds the values of the places after the current one, ``got`` the sizes chosen from the right
PATHS = """
lexn AS (SELECT word, count(*) AS n FROM lw SEMI JOIN lex ON lex.word = lw.word GROUP BY word),
one AS (SELECT -floor(1000000 * ln(sum(n)))::BIGINT AS w FROM lexn),
reach AS (SELECT DISTINCT doc_id, p, coalesce(max(p + l) OVER (
            PARTITION BY doc_id ORDER BY p RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) <= p AS opens FROM hits),
stretch AS (SELECT doc_id, p, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY p) AS s FROM reach),
ways AS (SELECT h.doc_id, h.p, max(h.l) AS far,
                list({'k': h.l, 'w': (SELECT w FROM one) + floor(1000000 * ln(n.n))::BIGINT}) AS o
         FROM hits h JOIN lexn n ON n.word = h.word GROUP BY h.doc_id, h.p),
ends AS (SELECT s.doc_id, s.s, min(s.p) AS lo, max(w.p + w.far) AS hi
         FROM stretch s JOIN ways w ON w.doc_id = s.doc_id AND w.p = s.p GROUP BY s.doc_id, s.s),
spots AS (SELECT e.doc_id, e.s, e.hi, x.p, coalesce(w.o, []) AS o
          FROM (SELECT *, unnest(range(lo, hi)) AS p FROM ends) x JOIN ends e ON e.doc_id = x.doc_id AND e.s = x.s
          LEFT JOIN ways w ON w.doc_id = x.doc_id AND w.p = x.p),
path AS (SELECT doc_id, hi, list_reduce(
           list_prepend({'c': 0::BIGINT, 'o': []::STRUCT(k BIGINT, w BIGINT)[], 'v': [0]::BIGINT[], 'got': []::BIGINT[]},
                        list({'c': one.w, 'o': o, 'v': []::BIGINT[], 'got': []::BIGINT[]} ORDER BY p DESC)),
           lambda a, x: {'c': x.c, 'o': []::STRUCT(k BIGINT, w BIGINT)[],
             'v': list_prepend(list_max(list_append([b.w + a.v[b.k] FOR b IN x.o], x.c + a.v[1])), a.v[1:6]),
             'got': list_append(a.got, list_max(list_append([{'h': b.w + a.v[b.k], 'k': b.k} FOR b IN x.o],
                                                            {'h': x.c + a.v[1], 'k': 1::BIGINT})).k)}).got AS got
         FROM spots CROSS JOIN one GROUP BY doc_id, hi, s),
best AS (SELECT h.doc_id, h.p, h.l, h.word
         FROM (SELECT doc_id, hi - i AS p, got[i] AS l FROM (SELECT *, unnest(range(1, len(got) + 1)) AS i FROM path)) k
         JOIN hits h ON h.doc_id = k.doc_id AND h.p = k.p AND h.l = k.l)"""

INNER_WORDS = """
subs AS (SELECT m.doc_id, m.idx, o.o AS off, substr(m.word, o.o + 1, k.k) AS word
         FROM mm m CROSS JOIN (SELECT unnest(range(0, 7)) AS o) o
                   CROSS JOIN (SELECT unnest(range(2, 7)) AS k) k
         WHERE length(m.word) > 2 AND k.k < length(m.word) AND o.o + k.k <= length(m.word)),
inside AS (SELECT s.doc_id, s.idx, s.off::INTEGER AS off, s.word FROM subs s JOIN lex ON s.word = lex.word)"""

UNSPACED_DOCS = r"""
t AS (SELECT doc_id, regexp_replace(lower(text), '\s+', '', 'g') AS t FROM documents)"""
NUMERAL_DOCS = r"""
u AS (SELECT doc_id, regexp_replace(lower(text), '\s+', '', 'g') AS u FROM documents),
t AS (SELECT doc_id, array_to_string([
        CASE WHEN regexp_full_match(x, '[0-9]{2,}') AND TRY_CAST(x AS BIGINT) IS NOT NULL
             THEN CAST(TRY_CAST(x AS BIGINT) AS VARCHAR) ELSE translate(x, '0123456789', '零一二三四五六七八九') END
        FOR x IN regexp_extract_all(u, '[0-9]+|[^0-9]+', 0)], '') AS t FROM u)"""
UNSPACED_REVIEWS = r"""
t AS (SELECT doc_id, regexp_replace(lower(document), '\s+', '', 'g') AS t FROM sp)"""

SEGMENT = "WITH " + ",".join([LEX, UNSPACED_DOCS, HITS])


def chain_ctes(policy: str, mode: str) -> dict:
    """Arguments of ``experiment_ctes`` for a chain that segments the reviews."""
    parts = [LEX, UNSPACED_REVIEWS, HITS]
    if mode == "full":
        tokens = f"SELECT doc_id, word AS w FROM hits WHERE NOT list_contains({STOP}, word)"
    else:
        parts += [LONGEST, FOLD]
        tokens = "SELECT doc_id, word AS w FROM mm"
        if mode == "search":
            parts.append(INNER_WORDS)
            tokens += " UNION ALL SELECT doc_id, word AS w FROM inside"
    return {"policy": policy, "fit_on": "all", "before": ",".join(parts) + ",", "tokens": tokens}


# Words of despaced text: windows of 9 characters (one before, 7 and one after), the runs of 1..7
# with their neighbours, cohesion over all cuts. chr(10) is the edge of a text.
FOUND_WORDS = r"""
WITH ch AS (SELECT doc_id, unnest(c) AS ch, generate_subscripts(c, 1) AS i FROM (
              SELECT doc_id, string_split(regexp_replace(lower(text), '\s+', '', 'g'), '') AS c
              FROM documents WHERE regexp_replace(lower(text), '\s+', '', 'g') <> '')),
win AS (SELECT coalesce(lag(ch) OVER o, chr(10)) || rpad(string_agg(ch, '') OVER (
                 PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING), 8, chr(10)) AS w
        FROM ch WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
seen AS (SELECT w, count(*) AS n FROM win GROUP BY w),
run AS (SELECT substr(w, 2, k) AS word, substr(w, 1, 1) AS l, substr(w, k + 2, 1) AS r, n
        FROM (SELECT w, n, unnest(range(1, 8)) AS k FROM seen)
        WHERE position(chr(10) IN substr(w, 2, k)) = 0),
lefts AS (SELECT word, sum(n)::BIGINT AS n, ln(sum(n)) - sum(n * ln(n)) / sum(n) AS e
          FROM (SELECT word, l, sum(n)::DOUBLE AS n FROM run GROUP BY 1, 2) GROUP BY word HAVING sum(n) >= 25),
rights AS (SELECT word, ln(sum(n)) - sum(n * ln(n)) / sum(n) AS e
           FROM (SELECT word, r, sum(n)::DOUBLE AS n FROM run GROUP BY 1, 2) GROUP BY word HAVING sum(n) >= 25),
total AS (SELECT sum(n)::DOUBLE AS total FROM lefts WHERE length(word) = 1),
cut AS (SELECT word, n, unnest(range(1, length(word))) AS k FROM lefts),
coh AS (SELECT c.word, min(c.n::DOUBLE * (SELECT total FROM total) / (a.n::DOUBLE * b.n)) AS cohesion
        FROM cut c JOIN lefts a ON a.word = substr(c.word, 1, c.k) JOIN lefts b ON b.word = substr(c.word, c.k + 1)
        GROUP BY c.word),
found AS (SELECT word, lefts.n, cohesion, lefts.e AS left_entropy, rights.e AS right_entropy
          FROM coh JOIN lefts USING (word) JOIN rights USING (word)
          WHERE cohesion >= 1 AND lefts.e >= 2 AND rights.e >= 2)"""

ORACLE: dict[str, str] = {
    "top_words": TOP_WORDS + "\nSELECT word, n FROM t",
    "words_by_count": TOP_WORDS + "\nSELECT word, n FROM c",
    "word_cloud_weights": TOP_WORDS + """
SELECT word, n,
       round(CASE WHEN max(n) OVER () = min(n) OVER () THEN 20.0
             ELSE 20.0 + 80.0 * (n - min(n) OVER ()) / (max(n) OVER () - min(n) OVER ()) END::DOUBLE, 6)
       AS size
FROM c""",
    "extract_reviews": r"""
WITH rv AS (
  SELECT d.doc_id,
         concat_ws(',', CAST(d.doc_id AS VARCHAR), d.lang,
                   CASE WHEN d.doc_id % 97 = 0 THEN ''
                        WHEN d.doc_id % 89 = 0 THEN 'Rating'
                        WHEN l.quality = 1 THEN '5'
                        WHEN l.quality = 0 THEN CAST(1 + d.doc_id % 3 AS VARCHAR)
                        ELSE '4' END,
                   d.source, CAST(d.n_chars AS VARCHAR), '-', '-', '-', '-', '-',
                   regexp_replace(d.text, '[\r\n\t]+', ' ', 'g')) AS value
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
f AS (SELECT doc_id, string_split(value, ',') AS f FROM rv),
ln AS (SELECT doc_id, f[3] || chr(9) || f[11] AS line FROM f WHERE len(f) >= 11)
SELECT doc_id, line FROM ln
WHERE len(string_split(regexp_replace(line, '\t+$', ''), chr(9))) = 2
  AND string_split(line, chr(9))[1] <> 'Rating'""",
    "parse_reviews_jvm": _with(REVIEW_LINES, PARSE_JVM)
    + "\nSELECT doc_id, rating_txt, rating, document FROM pj",
    "parse_reviews_python": _with(REVIEW_LINES, parse_python())
    + "\nSELECT doc_id, rating_txt, rating, document FROM pp",
    "rating_histogram": _with(REVIEW_LINES, PARSE_JVM)
    + "\nSELECT rating, count(*)::BIGINT AS n FROM pj GROUP BY rating",
    "distinct_reviews": _with(REVIEW_LINES, DISTINCT_LINES, parse_python("dl", "pp"))
    + "\nSELECT doc_id, rating_txt, document FROM pp",
    "negatives_union": _with(REVIEW_LINES, PARSE_JVM) + """
SELECT doc_id, rating, document FROM pj WHERE rating = 1
UNION ALL SELECT doc_id, rating, document FROM pj WHERE rating = 2
UNION ALL SELECT doc_id, rating, document FROM pj WHERE rating = 3""",
    "negatives_isin": _with(REVIEW_LINES, PARSE_JVM)
    + "\nSELECT doc_id, rating, document FROM pj WHERE rating IN (1, 2, 3)",
    "label_multi": "WITH " + label_ctes("multi") + "\nSELECT doc_id, label, document FROM lab",
    "label_binary_drop4": "WITH " + label_ctes("binary_drop4")
    + "\nSELECT doc_id, label, document FROM lab",
    "label_binary_4neg": "WITH " + label_ctes("binary_4neg")
    + "\nSELECT doc_id, label, document FROM lab",
    "balanced_binary_drop4": "WITH " + balanced_ctes("binary_drop4")
    + "\nSELECT doc_id, label, document FROM bal",
    "balanced_binary_4neg": "WITH " + balanced_ctes("binary_4neg")
    + "\nSELECT doc_id, label, document FROM bal",
    "balanced_multi": "WITH " + balanced_ctes("multi") + "\nSELECT doc_id, label, document FROM bal",
    "first_rows": _with(REVIEW_LINES, PARSE_JVM)
    + "\nSELECT doc_id, rating_txt, document FROM pj ORDER BY doc_id LIMIT 100",
    "rejected_reviews": "WITH " + REVIEW_LINES + r""",
pf AS (SELECT doc_id, line, string_split(regexp_replace(line, '\t+$', ''), chr(9)) AS f FROM rl),
pr AS (SELECT doc_id, line, CASE WHEN line IS NULL THEN 'null line' WHEN len(f) <> 2 THEN 'not two fields'
         WHEN f[1] = 'Rating' THEN 'header' WHEN NOT regexp_full_match(f[1], '[+-]?[0-9]+')
         OR TRY_CAST(f[1] AS INTEGER) IS NULL THEN 'rating is no number' END AS reason FROM pf)
SELECT doc_id, reason, line FROM pr WHERE reason IS NOT NULL""",
    "first_rows_of_files": """
SELECT CAST(rn - 1 AS BIGINT) AS position, doc_id, n_chars
FROM (SELECT doc_id, n_chars, row_number() OVER () AS rn FROM documents) WHERE rn <= 100""",
    "zip_file_order": """
SELECT CAST(row_number() OVER () - 1 AS BIGINT) AS position, doc_id, length(text) AS size FROM documents""",
    "train_test_split": "WITH " + balanced_ctes("binary_drop4")
    + f"\nSELECT doc_id, label, {SPLIT_EXPR} AS split FROM bal",
    "zip_labels_features": "WITH " + balanced_ctes("binary_drop4") + f"""
SELECT doc_id, label, len(regexp_extract_all(lower(document), '{WORD}', 0))::BIGINT AS n_words
FROM bal""",
    "stop_words_removed": f"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '{WORD_MARK}', 0) AS t FROM documents),
k AS (SELECT doc_id, t, list_filter(t, lambda w: NOT list_contains({STOP}, w)) AS kept FROM d)
SELECT doc_id, len(t)::BIGINT AS n_before, len(kept)::BIGINT AS n_after,
       array_to_string(kept, ' ') AS kept
FROM k""",
    "stop_words_by_table": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '{WORD}', 0) AS words FROM documents),
w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d),
stop AS (SELECT word FROM w GROUP BY word HAVING count(*) = 1 OR count(*) >= 500),
k AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS kept FROM w
      WHERE word NOT IN (SELECT word FROM stop) GROUP BY doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_before, coalesce(k.n, 0) AS n_after, coalesce(kept, '') AS kept
FROM d LEFT JOIN k ON d.doc_id = k.doc_id""",
    "slash_rejoin": f"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '{WORD_MARK}', 0) AS t FROM documents)
SELECT doc_id, len(t)::BIGINT AS n_before,
       len(string_split(array_to_string(t, '/'), '/'))::BIGINT AS n_after
FROM d""",
    "tokens_keep_marks": f"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WORD_KEEP}', 0)) AS token
           FROM documents)
SELECT doc_id, token, count(*)::BIGINT AS n FROM t
WHERE regexp_matches(token, '[@#%.&+]') GROUP BY 1, 2""",
    "term_counts": f"""
WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WORD}', 0)) AS term FROM documents)
SELECT doc_id, term, count(*)::BIGINT AS tf FROM w GROUP BY 1, 2""",
    "term_counts_hashed": f"""
WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WORD}', 0)) AS w FROM documents)
SELECT doc_id, {MD5_TERM} AS term, count(*)::BIGINT AS tf FROM w GROUP BY 1, 2""",
    "idf": f"""
WITH w AS (SELECT DISTINCT doc_id, term FROM (
             SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WORD}', 0)) AS term
             FROM documents))
SELECT term, count(*)::BIGINT AS df,
       round(ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) + 1.0))::DOUBLE, 6) AS idf
FROM w GROUP BY term""",
    "tfidf": f"""
WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WORD}', 0)) AS term FROM documents),
tc AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM w GROUP BY 1, 2),
idf AS (SELECT term, ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) + 1.0)) AS idf
        FROM tc GROUP BY term)
SELECT tc.doc_id, tc.term, tc.tf, round((tc.tf * idf.idf)::DOUBLE, 6) AS tfidf
FROM tc JOIN idf ON tc.term = idf.term""",
    "nb_model": "WITH " + experiment_ctes("binary_drop4") + """
SELECT s.label, s.term, round(s.s::DOUBLE, 6) AS s,
       round((ln(s.s + 1.0) - p.log_norm)::DOUBLE, 6) AS theta
FROM sums s JOIN pri p ON s.label = p.label""",
    "nb_priors": "WITH " + experiment_ctes("binary_drop4") + """
SELECT label, n_docs::BIGINT AS n_docs, round(pi::DOUBLE, 6) AS pi,
       round(log_norm::DOUBLE, 6) AS log_norm FROM pri""",
    "nb_predict": "WITH " + experiment_ctes("binary_drop4")
    + "\nSELECT doc_id, label, prediction FROM pred",
    "nb_accuracy": "WITH " + experiment_ctes("binary_drop4") + ACCURACY,
    "nb_accuracy_4neg": "WITH " + experiment_ctes("binary_4neg") + ACCURACY,
    "nb_accuracy_idf_all": "WITH " + experiment_ctes("binary_drop4", fit_on="all") + ACCURACY,
    "nb_multiclass_accuracy": "WITH " + experiment_ctes("multi") + ACCURACY,
    "score_new_reviews": "WITH " + experiment_ctes("binary_drop4") + f""",
cv AS (SELECT conv_id, turn, text FROM conversations),
ctok AS (SELECT conv_id, turn, unnest(regexp_extract_all(lower(text), '{WORD}', 0)) AS w FROM cv),
ctc AS (SELECT conv_id, turn, {MODEL_TERM} AS term, count(*) AS tf FROM ctok GROUP BY 1, 2, 3),
cx AS (SELECT c.conv_id, c.turn, c.term,
              c.tf * coalesce(idf.idf, ln((SELECT m FROM m) + 1.0)) AS v
       FROM ctc c LEFT JOIN idf ON c.term = idf.term),
cxs AS (SELECT conv_id, turn, sum(v) AS xsum FROM cx GROUP BY 1, 2),
csw AS (SELECT cx.conv_id, cx.turn, s.label, sum(cx.v * ln(1 + s.s / 1.0)) AS sw
        FROM cx JOIN sums s ON cx.term = s.term GROUP BY 1, 2, 3),
csc AS (SELECT c.conv_id, c.turn, p.label AS cls,
               p.pi + coalesce(cxs.xsum, 0) * (ln(1.0) - p.log_norm) + coalesce(csw.sw, 0) AS score
        FROM cv c CROSS JOIN pri p
        LEFT JOIN cxs ON cxs.conv_id = c.conv_id AND cxs.turn = c.turn
        LEFT JOIN csw ON csw.conv_id = c.conv_id AND csw.turn = c.turn AND csw.label = p.label)
SELECT conv_id, turn, cls AS prediction FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY score DESC, cls) AS rn
  FROM csc) WHERE rn = 1""",
    "ml_pipeline_predictions": "WITH " + experiment_ctes("binary_drop4", seen_only=True)
    + "\nSELECT doc_id, label, prediction FROM pred",
    "svm_weights": "WITH " + svm_ctes() + "\nSELECT term, round(w::DOUBLE, 6) AS w FROM wf",
    "svm_predict": "WITH " + svm_ctes() + "\nSELECT doc_id, label, prediction::INTEGER AS prediction FROM spred",
    "svm_accuracy": "WITH " + svm_ctes() + ACCURACY.replace("FROM pred", "FROM spred"),
    "segment_best_path": ",".join([SEGMENT, PATHS, FOLD]) + "\nSELECT doc_id, idx, word FROM mm",
    "segment_full": ",".join([SEGMENT, LONGEST, UNCOVERED]) + """
SELECT doc_id, p::INTEGER AS pos, word FROM hits
UNION ALL SELECT doc_id, p::INTEGER AS pos, c AS word FROM bare""",
    "segment_max_match": ",".join([SEGMENT, LONGEST, FOLD]) + "\nSELECT doc_id, idx, word FROM mm",
    "segment_numerals": "WITH " + ",".join([LEX, NUMERAL_DOCS, HITS, LONGEST, FOLD]) + """
SELECT doc_id, idx, word FROM mm""",
    "segment_mmseg": ",".join([SEGMENT, CHUNKS, FOLD]) + "\nSELECT doc_id, idx, word FROM mm",
    "segment_search": ",".join([SEGMENT, LONGEST, FOLD, INNER_WORDS]) + """
SELECT doc_id, idx, 0::INTEGER AS off, word FROM mm
UNION ALL SELECT doc_id, idx, off, word FROM inside""",
    "lexicon_from_text": FOUND_WORDS + """
SELECT word, n, round(cohesion, 6) AS cohesion, round(left_entropy, 6) AS left_entropy,
       round(right_entropy, 6) AS right_entropy FROM found""",
    "lexicon_from_text_quality": FOUND_WORDS + f""",
known AS (SELECT w AS word, count(*) AS n FROM (
            SELECT unnest(regexp_extract_all(lower(text), '{WORD}', 0)) AS w FROM documents) GROUP BY 1),
wanted AS (SELECT word FROM known WHERE n >= 25 AND length(word) BETWEEN 2 AND 7),
sizes AS (SELECT (SELECT count(*) FROM found) AS n_found,
                 (SELECT count(*) FROM found WHERE word IN (SELECT word FROM known)) AS n_right,
                 (SELECT count(*) FROM wanted) AS n_wanted,
                 (SELECT count(*) FROM wanted WHERE word IN (SELECT word FROM found)) AS n_both)
SELECT *, round(n_right / n_found, 6) AS precision, round(n_both / n_wanted, 6) AS recall FROM sizes""",
    "chain_multi_search_nb": "WITH " + experiment_ctes(**chain_ctes("multi_distinct", "search")) + ACCURACY,
    "chain_binary_max_match_nb": "WITH " + experiment_ctes(**chain_ctes("binary_drop4", "max_match")) + ACCURACY,
    "chain_4neg_full_svm": "WITH " + svm_ctes(**chain_ctes("binary_4neg", "full"))
    + ACCURACY.replace("FROM pred", "FROM spred"),
    "chinese_numerals": """
SELECT doc_id, translate(CAST(n_chars AS VARCHAR), '0123456789', '零一二三四五六七八九') AS numeral,
       n_chars AS value, (n_chars % 9 + 1) * 1000000 AS millions FROM documents""",
    "latin_second_split": """
WITH d AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '\\s+')) AS token FROM documents)
SELECT doc_id, token, unnest(regexp_extract_all(token, '[a-z]{2,}|[0-9]{2,}', 0)) AS part
FROM d WHERE regexp_matches(token, '[a-z]') AND regexp_matches(token, '[0-9]')""",
}
