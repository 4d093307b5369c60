"""Plain DuckDB SQL over the whole tables for the operators that SQL can express."""

from __future__ import annotations

EXACT_DEDUP = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""

#: A run of three worded lines, or of fewer with more than 50 words, is deleted where the same
#: run began earlier.
LINE_DEDUP = r"""
WITH numbered AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS ln
  FROM documents),
worded AS (
  SELECT doc_id, line, ln, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
         row_number() OVER (PARTITION BY doc_id ORDER BY ln) AS p
  FROM numbered WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
ahead AS (
  SELECT doc_id, p, n, md5(line) AS one, lead(md5(line), 1) OVER w AS two,
         lead(md5(line), 2) OVER w AS three, n + lead(n) OVER w AS n2
  FROM worded WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
runs AS (
  SELECT doc_id, p, 1 AS m, one AS run FROM ahead WHERE n > 50
  UNION ALL SELECT doc_id, p, 2, one || two FROM ahead WHERE n2 > 50
  UNION ALL SELECT doc_id, p, 3, one || two || three FROM ahead WHERE three IS NOT NULL),
later AS (
  SELECT doc_id, p, m FROM (
    SELECT doc_id, p, m, row_number() OVER (PARTITION BY run ORDER BY doc_id, p) AS nth
    FROM runs) WHERE nth > 1),
gone AS (
  SELECT DISTINCT l.doc_id, w.ln
  FROM later l JOIN worded w ON w.doc_id = l.doc_id AND w.p BETWEEN l.p AND l.p + l.m - 1)
SELECT n.doc_id, count(*) AS n_lines, count(g.ln) AS n_removed,
       sha256(coalesce(string_agg(n.line, chr(10) ORDER BY n.ln) FILTER (g.ln IS NULL), ''))
         AS kept_sha256
FROM numbered n LEFT JOIN gone g ON g.doc_id = n.doc_id AND g.ln = n.ln
GROUP BY n.doc_id
"""

#: Groups of documents whose sets of three-word shingles are 85 percent alike, by all pairs
#: that share a shingle.
NEAR_DEDUP = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) END) AS sh
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT r.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.other) AS component_id,
       r.doc_id = min(r.other) AS kept
FROM reach r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""

#: All windows of 200 bytes, as 400 hexadecimal digits, compared with each other.
SUFFIX_DEDUP = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n
  FROM documents),
wins AS (
  SELECT doc_id, p, md5(substr(h, 2 * p + 1, 400)) AS k
  FROM (SELECT doc_id, h, unnest(range(0, n - 199)) AS p FROM d)),
twice AS (
  SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY k) AS c FROM wins) WHERE c > 1),
runs AS (
  SELECT doc_id, min(p) AS s, max(p) + 200 AS e FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM (
      SELECT *, CAST(p > coalesce(lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 200, -1) AS INT)
        AS fresh FROM twice)) GROUP BY doc_id, g),
cuts AS (
  SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS a, s AS b FROM runs
  UNION ALL SELECT doc_id, max(e), NULL FROM runs GROUP BY doc_id),
kept AS (
  SELECT c.doc_id, string_agg(substr(d.h, 2 * a + 1, 2 * (coalesce(b, d.n) - a)), '' ORDER BY a) AS k
  FROM cuts c JOIN d ON d.doc_id = c.doc_id GROUP BY c.doc_id),
total AS (SELECT doc_id, sum(e - s) AS gone, count(*) AS spans FROM runs GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_bytes, CAST(coalesce(t.gone, 0) AS BIGINT) AS n_removed,
       coalesce(t.spans, 0) AS n_spans, sha256(unhex(coalesce(k.k, d.h))) AS kept_sha256
FROM d LEFT JOIN total t ON t.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

#: Phrases of two to four words in each language's first 2,000 places, by counting all of them.
COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
grams AS (
  SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2),
    lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS phrase
  FROM worded, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(ws) >= m),
f AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
candidates AS (
  SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1 AND f >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r,
         CAST((2000000::HUGEINT * c.a) // (x.f + y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[k + 1:], ' ')),
lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (
  SELECT DISTINCT s.lang, s.phrase FROM candidates s JOIN (
    SELECT lang, a, array_to_string(ws[i:i + w - 1], ' ') AS part
    FROM (SELECT *, unnest(range(1, m - w + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS w FROM candidates))) o
  ON o.lang = s.lang AND o.part = s.phrase AND 100 * o.a >= 80 * s.a),
ranked AS (
  SELECT l.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest l ANTI JOIN held h USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
