"""SQL of the registered queries that SQL can express."""

from __future__ import annotations

OP5 = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept,
       text_sha256
FROM d
WINDOW w AS (PARTITION BY text_sha256)
"""

OP6 = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), n AS (
  SELECT conv_id, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n
  FROM t
), p AS (
  SELECT conv_id, n,
         string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '')
           OVER (PARTITION BY conv_id ORDER BY n) AS so_far,
         max(n) OVER (PARTITION BY conv_id) AS size
  FROM n
), whole AS (
  SELECT min(conv_id) AS conv_id, n, so_far FROM p WHERE n = size GROUP BY n, so_far
)
SELECT conv_id, n AS n_turns, so_far AS text
FROM whole
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.n < p.size AND p.n = whole.n AND p.so_far = whole.so_far)
"""

def _near(size: int, more: str = "") -> str:
    """Components of the documents whose sets of ``size`` words in a row are similar enough."""
    return f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^ \t-\r]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {size} THEN [array_to_string(ws, ' ')]
         ELSE list_transform(range(1, len(ws) - {size - 2}), lambda i: array_to_string(ws[i:i + {size - 1}], ' ')) END) AS g
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), e AS (
  SELECT x, y FROM i JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * k >= 85 * (p.n + q.n - k)
), r AS (
  SELECT doc_id AS node, doc_id AS reach FROM documents
  UNION
  SELECT e.y, r.reach FROM r JOIN e ON e.x = r.node
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id{more}
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT node AS doc_id, min(reach) AS component_id FROM r GROUP BY node) c USING (doc_id)
"""


OP10 = """
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+') AS ws FROM documents
), p AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h
  FROM w, unnest(range(1, len(ws) - 48)) AS t(i)
), f AS (SELECT h, min(doc_id) AS least FROM p GROUP BY h),
r AS (SELECT doc_id, i FROM p JOIN f USING (h) WHERE least < doc_id),
c AS (
  SELECT x.doc_id, x.k, x.word, r.i IS NOT NULL AND x.k - r.i < 50 AS gone
  FROM (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS k, unnest(ws) AS word FROM w) x
  ASOF LEFT JOIN r ON x.doc_id = r.doc_id AND x.k >= r.i
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
       CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(stays, '')) AS kept_sha256
FROM w LEFT JOIN (
  SELECT doc_id, count(*) FILTER (gone) AS n,
         string_agg(word, ' ' ORDER BY k) FILTER (NOT gone) AS stays
  FROM c GROUP BY doc_id
) USING (doc_id)
"""


OP11 = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\n-\r]')) AS piece
  FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS ws FROM p),
n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
c AS (
  SELECT lang, k, phrase, count(*) AS f
  FROM (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: ws[i:i + k - 1])) AS phrase
        FROM w, (VALUES (1), (2), (3)) s(k) WHERE len(ws) >= k)
  GROUP BY ALL HAVING count(*) >= 10
), s AS (
  SELECT c.lang, c.phrase, c.f AS a, l.f AS l, r.f AS r,
         CAST((1000000::HUGEINT * c.f * c.f) // (l.f::HUGEINT * r.f) AS BIGINT) AS score, j
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c WHERE k > 1) c
  JOIN c l ON l.lang = c.lang AND l.phrase = c.phrase[1:j]
  JOIN c r ON r.lang = c.lang AND r.phrase = c.phrase[j + 1:]
), t AS (
  SELECT * FROM s
  WHERE NOT EXISTS (
    SELECT 1 FROM c z WHERE z.k = 3 AND z.lang = s.lang AND len(s.phrase) = 2
      AND (z.phrase[1:2] = s.phrase OR z.phrase[2:3] = s.phrase) AND 100 * z.f >= 50 * s.a)
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(phrase, ' ')) AS rank,
       array_to_string(phrase, ' ') AS phrase, a, l, r, n, score
FROM t JOIN n USING (lang)
QUALIFY rank <= 2000
"""


def _rounds(n: int) -> str:
    """The rounds of the clustering one after the other: a{i} assigns, c{i + 1} moves the centroids."""
    assign = """
a{i} AS (
  SELECT r, any_value(vec_id) AS vec_id, any_value(v.v) AS v, first(c ORDER BY d, c) AS c, min(d) AS d
  FROM (SELECT v.*, c.c, list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
        FROM v, c{i} c) v
  GROUP BY r
)"""
    move = """
m{i} AS (
  SELECT c, list(CAST((s - ((s % n + n) % n)) // n AS BIGINT) ORDER BY j) AS v
  FROM (SELECT c, j, sum(x) AS s, count(*) AS n
        FROM (SELECT c, unnest(v) AS x, unnest(range(64)) AS j FROM a{i}) GROUP BY c, j)
  GROUP BY c
), c{k} AS (SELECT c, coalesce(m{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN m{i} USING (c))"""
    parts = [assign.format(i=i) + "," + move.format(i=i, k=i + 1) for i in range(n)]
    return ",".join([*parts, assign.format(i=n)])


OP13 = f"""
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r,
         list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) - 1 AS c, v FROM v
  QUALIFY c < 16
),{_rounds(3)}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(c3.v, lambda x: CAST(x AS VARCHAR)), ',')) AS centroid_sha256
FROM a3 a JOIN c3 ON c3.c = a.c
"""

SQL = {"op10_phrases": OP10, "op11_collocations": OP11, "op13_centroids": OP13, "op12_minhash": _near(3, ", d.doc_id = c.component_id AS kept"), "op2_jaccard": _near(4), "op5_exact_dedup": OP5, "op6_chat_format": OP6}
