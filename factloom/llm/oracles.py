"""DuckDB SQL for those queries of this subpackage that SQL can express."""

from __future__ import annotations

from factloom.llm.fingerprints import ANCHORED, SPOT

# sets of 3-word shingles, links of 100 * both >= 90 * either, least doc_id reachable
JACCARD = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM w
), t AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS token FROM s
), p AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM t x JOIN t y ON x.token = y.token AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))
), r AS (
  SELECT doc_id, doc_id AS root FROM documents
  UNION SELECT p.b, r.root FROM r JOIN p ON p.a = r.doc_id
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, c.component_id
FROM s JOIN (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id) c USING (doc_id)
"""

# lines whose template recurs: masked lines of 3 documents (2, if longer than 50 tokens), or, within a leaf (count and first
# three tokens), lines of which at least 0.7 of the tokens stand at their place in so many documents, the rest left open
LINES = """
WITH d AS (
  SELECT row_number() OVER (ORDER BY doc_id, text) AS k, * FROM documents
), l AS (
  SELECT k, dense_rank() OVER (ORDER BY doc_id, text) AS doc, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no FROM d
), m AS (
  SELECT k, doc, no, regexp_replace(trim(regexp_replace(line, '[ \\t\\r\\f\\x0B]+', ' ', 'g')), '[^ ]*[0-9][^ ]*', '<*>', 'g') AS masked FROM l
), p AS (
  SELECT *, CASE WHEN masked = '' THEN [] ELSE string_split(masked, ' ') END AS w FROM m
), q AS (
  SELECT *, len(w) AS n, CASE WHEN len(w) > 50 THEN 2 ELSE 3 END AS needed, array_to_string(w[1:3], ' ') || ' ' || len(w) AS leaf FROM p WHERE len(w) >= 3
), exact AS (
  SELECT masked FROM q GROUP BY masked, needed HAVING count(DISTINCT doc) >= needed
), t AS (
  SELECT k, doc, no, n, leaf, needed, masked IN (SELECT masked FROM exact) AS known, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM q WHERE n > 3
), fixed AS (
  SELECT leaf, pos, token FROM t GROUP BY leaf, pos, token, needed HAVING count(DISTINCT doc) >= needed
), g AS (
  SELECT k, doc, no, leaf, needed, known, list(pos || ' ' || token ORDER BY pos) AS kept
  FROM t JOIN fixed USING (leaf, pos, token) GROUP BY k, doc, no, n, leaf, needed, known HAVING count(*) >= n * 0.7
), form AS (
  SELECT DISTINCT leaf, needed, kept FROM g WHERE NOT known
), wide AS (
  SELECT f.leaf, f.kept FROM form f JOIN g ON f.leaf = g.leaf AND list_has_all(g.kept, f.kept)
  GROUP BY f.leaf, f.kept, f.needed HAVING count(DISTINCT g.doc) >= f.needed
), gone AS (
  SELECT k, no FROM q WHERE masked IN (SELECT masked FROM exact)
  UNION SELECT g.k, g.no FROM g JOIN wide ON g.leaf = wide.leaf AND list_has_all(g.kept, wide.kept) WHERE NOT g.known
), kept AS (
  SELECT k, string_agg(line, chr(10) ORDER BY no) AS text FROM l ANTI JOIN gone USING (k, no) GROUP BY k
), o AS (
  SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(kept.text, '') END AS text, d.lang, d.source FROM d LEFT JOIN kept USING (k)
)
SELECT doc_id, text, lang, source, length(text)::BIGINT AS n_chars FROM o
"""

# spot signatures of texts and of edited texts, their likeness, and groups of fingerprints that reach 0.8 by steps
_SPOTS_OF = """list_sort(list_distinct(list_transform(
    CASE WHEN {text} = '' THEN [] WHEN len({spots}) = 0 THEN [{text}] ELSE {spots} END, lambda x: md5(x)[1:16])))"""
_MARKED = """regexp_extract_all(replace(regexp_replace(' ' || replace(trim(regexp_replace(lower({text}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ', '  ') || ' ',
    '{anchored}', ' @\\1 ', 'g'), '  ', ' '), '{spot}')"""


def _spots(text: str) -> str:
    return _SPOTS_OF.format(text=text, spots=_MARKED.format(text=text, anchored=ANCHORED, spot=SPOT))


def _near(a: str, b: str) -> str:
    return f"CASE WHEN len({a}) + len({b}) = 0 THEN 1.0 ELSE len(list_intersect({a}, {b}))::DOUBLE / (len({a}) + len({b}) - len(list_intersect({a}, {b}))) END"


SPOTS = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), n AS (
  SELECT doc_id, text, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS next FROM d
), e AS (
  SELECT doc_id, text, next, left(text, length(text) - length(text) // 4) || left(next, length(text) // 4) AS edited FROM n
), s AS (
  SELECT doc_id, length(text) AS n_chars, edited, {_spots("text")} AS own, {_spots("edited")} AS other, {_spots("next")} AS after FROM e
), t AS (
  SELECT doc_id, len(own) AS n, unnest(own) AS token FROM s
), p AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM t x JOIN t y ON x.token = y.token AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), r AS (
  SELECT doc_id, doc_id AS root FROM d
  UNION SELECT p.b, r.root FROM r JOIN p ON p.a = r.doc_id
), c AS (
  SELECT doc_id, min(root) AS alike_id FROM r GROUP BY doc_id
), f AS (
  SELECT own, min(doc_id) AS class_id FROM s WHERE len(own) > 0 GROUP BY own
)
SELECT s.doc_id, n_chars::BIGINT AS n_chars, sha256(edited) AS edited_sha256, array_to_string(s.own, '') AS fingerprint,
  array_to_string(other, '') AS edited_fingerprint, {_near("s.own", "other")} AS near_edited, {_near("s.own", "after")} AS near_next,
  coalesce(class_id, s.doc_id) AS class_id, alike_id
FROM s JOIN c USING (doc_id) LEFT JOIN f ON s.own = f.own
"""
