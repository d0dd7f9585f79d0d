"""SQL of the longer queries, as DuckDB runs it on the same tables."""

from __future__ import annotations

#: CRC-32 of the decimal doc_id, bit by bit.
CRC = (
    "xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: ord(ch)::BIGINT)), "
    "lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))))"
)


def _framed(column: str) -> str:
    return f"coalesce(CAST(strlen(CAST({column} AS VARCHAR)) AS VARCHAR) || ':' || CAST({column} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_framed(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


MERKLE = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, coalesce('s' || source, 'n') AS k, {_leaf('text')} AS leaf,
           CASE WHEN {CRC} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS shown FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, leaf) - 1 AS i, count(*) OVER (PARTITION BY k) AS n FROM d),
t AS (
    SELECT k, 0 AS lv, i, leaf AS h, n FROM l
    UNION ALL SELECT k, lv + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (max(n) + 2) // 3 FROM t WHERE n > 1 GROUP BY k, lv, i // 3),
s AS (SELECT k, h AS subroot, lv AS height, row_number() OVER (ORDER BY k) - 1 AS i, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (
    SELECT 0 AS lv, i, subroot AS h, n FROM s
    UNION ALL SELECT lv + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (max(n) + 2) // 3 FROM u WHERE n > 1 GROUP BY lv, i // 3),
p AS (
    SELECT l.doc_id, t.lv AS depth, t.i, t.h, sign(t.i - l.i // CAST(pow(3, t.lv) AS BIGINT)) AS side
    FROM l JOIN t ON t.k = l.k AND t.n > 1 AND t.i // 3 = l.i // CAST(pow(3, t.lv + 1) AS BIGINT)
    UNION ALL SELECT l.doc_id, s.height + u.lv, u.i, u.h, sign(u.i - s.i // CAST(pow(3, u.lv) AS BIGINT))
    FROM l JOIN s ON s.k = l.k JOIN u ON u.n > 1 AND u.i // 3 = s.i // CAST(pow(3, u.lv + 1) AS BIGINT)),
g AS (SELECT doc_id, depth, coalesce(string_agg(h, '' ORDER BY i) FILTER (side < 0), '') AS a, coalesce(string_agg(h, '' ORDER BY i) FILTER (side > 0), '') AS b
      FROM p GROUP BY doc_id, depth),
f AS (SELECT doc_id, 0 AS depth, shown AS h FROM l UNION ALL SELECT g.doc_id, g.depth + 1, sha256(g.a || f.h || g.b) FROM f JOIN g ON g.doc_id = f.doc_id AND g.depth = f.depth),
e AS (SELECT doc_id, arg_max(h, depth) AS folded_root FROM f GROUP BY doc_id),
q AS (SELECT doc_id, sha256(string_agg(a || b, '' ORDER BY depth)) AS proof FROM g GROUP BY doc_id)
SELECT l.doc_id, l.leaf, s.subroot, r.h AS root, coalesce(q.proof, sha256('')) AS proof_sha256, e.folded_root, e.folded_root = r.h AS verified
FROM l JOIN s ON s.k = l.k JOIN e ON e.doc_id = l.doc_id LEFT JOIN q ON q.doc_id = l.doc_id, (SELECT h FROM u WHERE n = 1) AS r
"""

RUNS = rf"""
WITH c AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w, {CRC} AS h FROM documents),
n AS (SELECT *, len(w) AS n, h // 10 AS g FROM c),
a AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a FROM n),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
d AS (SELECT doc_id, n, [CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END FOR i IN range(n)] AS w FROM p),
t AS (SELECT doc_id, n, unnest(range(n - 2)) AS i, unnest([array_to_string(w[i + 1:i + 3], ' ') FOR i IN range(n - 2)]) AS g FROM d WHERE n > 5),
m AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM t x JOIN t y ON x.doc_id = y.doc_id AND x.g = y.g AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
s AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM m),
e AS (SELECT doc_id, q, min(i) AS start, count(*) + 2 + q AS length FROM s GROUP BY doc_id, q, island HAVING count(*) + 2 + q >= greatest(6, 4 * q)),
r AS (SELECT doc_id, start, length, min(q) AS period FROM e GROUP BY doc_id, start, length),
b AS (SELECT doc_id, count(*) AS n_runs, arg_min([start, length, period], [-length, start, period]) AS best,
             string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS told FROM r GROUP BY doc_id),
x AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
v AS (SELECT doc_id, unnest(range(n)) AS i, unnest(w) AS word FROM d),
k AS (SELECT v.doc_id, string_agg(word, ' ' ORDER BY v.i) AS kept FROM v LEFT JOIN x ON x.doc_id = v.doc_id AND x.i = v.i WHERE x.i IS NULL GROUP BY v.doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best[1] AS start, best[2] AS length, best[3] AS period, 1000 * best[2] // best[3] AS exponent_milli,
       sha256(coalesce(told, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN k USING (doc_id)
"""
