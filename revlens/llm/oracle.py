"""DuckDB SQL for the queries that SQL can express (same names and columns)."""

from __future__ import annotations

REMOVAL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 400)) AS k
      FROM (SELECT doc_id, h, unnest(range(0, greatest(n - 199, 0))) AS p FROM d)),
rep AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY k) AS c FROM w) WHERE c > 1),
cut AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 200 THEN 0 ELSE 1 END AS fresh FROM rep),
num AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS r FROM cut),
runs AS (SELECT doc_id, r, min(p) AS a, max(p) + 200 AS b FROM num GROUP BY doc_id, r),
gaps AS (SELECT doc_id, coalesce(lag(b) OVER o, 0) AS a, a AS b, b - a AS gone FROM runs WINDOW o AS (PARTITION BY doc_id ORDER BY a)
         UNION ALL SELECT d.doc_id, coalesce(m.b, 0), d.n, 0
         FROM d LEFT JOIN (SELECT doc_id, max(b) AS b FROM runs GROUP BY doc_id) m ON m.doc_id = d.doc_id),
kept AS (SELECT g.doc_id, string_agg(substr(d.h, 2 * g.a + 1, 2 * (g.b - g.a)), '' ORDER BY g.b, g.a) AS h
         FROM gaps g JOIN d ON d.doc_id = g.doc_id GROUP BY g.doc_id),
sums AS (SELECT doc_id, sum(b - a) AS gone, count(*) AS spans FROM runs GROUP BY doc_id)
SELECT d.doc_id, d.n::BIGINT AS n_bytes, coalesce(s.gone, 0)::BIGINT AS n_removed, coalesce(s.spans, 0)::BIGINT AS n_spans,
       sha256(unhex(k.h)) AS kept_sha256
FROM d JOIN kept k ON k.doc_id = d.doc_id LEFT JOIN sums s ON s.doc_id = d.doc_id"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS i FROM d WHERE len(w) >= 4)
       UNION SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 3),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d JOIN comp c ON c.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""

RANKED_SEARCH = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
q AS (SELECT item_id, row_number() OVER () AS q, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
s AS (SELECT count(*) FILTER (len(w) > 0) AS n, sum(len(w))::BIGINT AS l FROM d),
m AS (SELECT r, doc_id, 100 - 90 + (90 * len(w) * s.n) // s.l AS m FROM d CROSS JOIN s WHERE len(w) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term),
wt AS (SELECT term, floor(1000 * ln((2 * max(s.n) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf CROSS JOIN s GROUP BY term),
qt AS (SELECT DISTINCT q, item_id, term FROM (SELECT q, item_id, unnest(w) AS term FROM q)),
sc AS (SELECT qt.q, qt.item_id, m.r, m.doc_id, sum(wt.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * m.m)))::BIGINT AS score
       FROM qt JOIN tf ON tf.term = qt.term JOIN wt ON wt.term = qt.term JOIN m ON m.r = tf.r GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id)::INTEGER AS rank FROM sc WHERE score > 0)
WHERE rank <= 10"""


def manifest_sql(levels: int = 6, source_levels: int = 4) -> str:
    """The Merkle manifest with its levels unrolled: 16 ** levels documents a source and
    16 ** source_levels sources at most."""
    def part(c: str) -> str:
        return f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(map(part, ["doc_id", "source", "lang", "n_chars", text])) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
             list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
             lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
               lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))"""
    ctes = [f"""
src AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS s FROM (SELECT DISTINCT source FROM documents)),
d AS (SELECT doc_id, source, {leaf("text")} AS leaf, coalesce({crc} % 5 = 0, false) AS hit, {leaf(lower)} AS other FROM documents),
d0 AS (SELECT d.doc_id, d.leaf, CASE WHEN d.hit THEN d.other ELSE d.leaf END AS now, src.s,
              row_number() OVER (PARTITION BY src.s ORDER BY d.doc_id NULLS FIRST, d.leaf) - 1 AS i, count(*) OVER (PARTITION BY src.s) AS n
       FROM d JOIN src ON d.source IS NOT DISTINCT FROM src.source),
n0 AS (SELECT s AS g, i, leaf AS h, n FROM d0)"""]

    def rise(node: str, run: str, up: str, k: int) -> None:
        ctes.append(f"""
{run} AS (SELECT g, i // 16 AS i, list(h ORDER BY i) AS hs, max(n) AS n FROM {node} GROUP BY g, i // 16),
{up} AS (SELECT g, i, CASE WHEN n > {16 ** k} THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h, n FROM {run})""")

    for k in range(levels):
        rise(f"n{k}", f"r{k}", f"n{k + 1}", k)
    ctes.append(f"""
m0 AS (SELECT 0 AS g, g AS i, h, (SELECT count(*) FROM src) AS n FROM n{levels})""")
    for k in range(source_levels):
        rise(f"m{k}", f"q{k}", f"m{k + 1}", k)
    ctes.append("""
w0 AS (SELECT doc_id, leaf, s, i, n, (SELECT count(*) FROM src) AS ns, now, '' AS proof FROM d0)""")

    def fold(step: int, run: str, group: str, at: str, size: str, k: int) -> None:
        off = f"({at} // {16 ** k}) % 16"
        left, right = f"array_to_string(hs[1:{off}], '')", f"array_to_string(hs[{off} + 2:], '')"
        ctes.append(f"""
w{step + 1} AS (SELECT doc_id, leaf, s, w.i, w.n, ns, CASE WHEN {size} > {16 ** k} THEN sha256({left} || now || {right}) ELSE now END AS now,
       CASE WHEN {size} > {16 ** k} THEN proof || {left} || {right} ELSE proof END AS proof
       FROM w{step} w JOIN {run} r ON r.g = {group} AND r.i = {at} // {16 ** (k + 1)})""")

    for k in range(levels):
        fold(k, f"r{k}", "w.s", "w.i", "w.n", k)
    for k in range(source_levels):
        fold(levels + k, f"q{k}", "0", "w.s", "w.ns", k)
    return "WITH " + ",".join(ctes) + f"""
SELECT w.doc_id, w.leaf, t.h AS subroot, m.h AS root, sha256(w.proof) AS proof_sha256, w.now AS folded_root, w.now = m.h AS verified
FROM w{levels + source_levels} w JOIN n{levels} t ON t.g = w.s CROSS JOIN m{source_levels} m"""


ORACLE = {
    "op12_block_max_search": RANKED_SEARCH,
    "op13_merkle_manifest": manifest_sql(),
    "op2_suffix_array_dedup": REMOVAL,
    "op8_minhash_near_dedup": NEAR_DUPLICATES,
}
