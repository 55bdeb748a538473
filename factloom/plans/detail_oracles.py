"""DuckDB SQL for the queries of ``details``."""

from __future__ import annotations

from factloom.config import GRAPH_NAMESPACE, NAMESPACE
from factloom.plans.oracles import FACTS, MEMBERS, SAID, STATUS, TIMES, VOTES, WALK, _patterns, _uuid5


def _node(kind: str, source: str) -> str:
    return _uuid5(f"'[\"node\",\"{kind}\",\"' || {source} || '\"]'", GRAPH_NAMESPACE)


HIT = """hit AS (
    SELECT 'EMAIL' AS kind, 'EMAIL' AS detector, 1 AS tier, regexp_extract(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}') AS surface, * FROM said WHERE text LIKE '%@%'
    UNION ALL SELECT 'URL', 'URL', 1, rtrim(regexp_extract(text, 'https?://[^ ]+'), '.,;:!?)>]'), * FROM said WHERE text LIKE '%http%'),
  found AS (SELECT *, kind || ':' || lower(surface) AS entity_id, strpos(text, surface) - 1 AS a, strpos(text, surface) - 1 + length(surface) AS b FROM hit)"""
TAKEN = """taken AS (
    SELECT *, 'full' AS what, 0.8 AS sure, regexp_extract(text, '(?i)\\b(?:Actually|Wait|No),?\\s+(?:that''s\\s+)?(?:not\\s+true|wrong|incorrect)\\b') AS surface FROM said WHERE role = 'user' AND regexp_matches(text, '(?i)\\b(?:Actually|Wait|No),?\\s+(?:that''s\\s+)?(?:not\\s+true|wrong|incorrect)\\b')
    UNION ALL SELECT *, 'temporal_bound', 0.8, regexp_extract(text, '(?i)\\bI\\s+(?:stopped|quit|no\\s+longer)\\s+(.+?)(?:\\.|$)') FROM said WHERE role = 'user' AND regexp_matches(text, '(?i)\\bI\\s+(?:stopped|quit|no\\s+longer)\\s+(.+?)(?:\\.|$)'))"""
NAMED = """names AS (SELECT * FROM (VALUES ('Alice', 'PERSON'), ('Bruno', 'PERSON'), ('Carla', 'PERSON'), ('Dario', 'PERSON'), ('Elena', 'PERSON'), ('Fabio', 'PERSON'), ('Paris', 'LOCATION'), ('Berlin', 'LOCATION'),
    ('Madrid', 'LOCATION'), ('Lisbon', 'LOCATION'), ('Acme', 'ORG'), ('Globex', 'ORG'), ('Initech', 'ORG'), ('Umbrella', 'ORG'), ('Hooli', 'ORG')) n(name, kind))"""
TERMS = """terms AS (SELECT * FROM (VALUES ('acme', 'acme'), ('acme', 'acme group'), ('hooli', 'hooli'), ('tea', 'tea'), ('3 weeks', '3 weeks')) t(term_key, form)),
  places AS (SELECT message_id, text, term_key, form, strpos(lower(text), form) - 1 AS a FROM said, terms WHERE regexp_matches(lower(text), '(^|[^a-z0-9])' || form || '($|[^a-z0-9])')),
  met AS (SELECT p.* FROM places p WHERE NOT (form = 'acme' AND EXISTS (SELECT 1 FROM places q WHERE q.message_id = p.message_id AND q.form = 'acme group')))"""
QUALIFIED = (
    """q AS (SELECT p.message_id || '-' || p.predicate AS assertion_id, p.message_id, nullif(regexp_extract(text, '[0-9]{4}-[0-9]{2}-[0-9]{2}|today|someday'), '') AS qualifier FROM ("""
    + _patterns()
    + """) p JOIN said USING (message_id)),
  linked AS (SELECT q.*, s.place::INT AS qualifier_start FROM q LEFT JOIN spoken s ON s.message_id = q.message_id AND s.surface = q.qualifier)"""
)
WALKED = f"""{FACTS}, {MEMBERS}, {VOTES}, first AS (SELECT subject_id FROM (SELECT DISTINCT subject_id FROM facts) ORDER BY {_node("TemporalProfile", "subject_id")} LIMIT 1),
  idx AS (SELECT subject_id, w, row_number() OVER (PARTITION BY subject_id ORDER BY w) - 1 AS window_index FROM win),
  placed_all AS (SELECT s.*, category, row_number() OVER (PARTITION BY s.subject_id, s.window_start, category ORDER BY salience DESC, member)::INT AS rank FROM scored s JOIN cats USING (subject_id, window_start, member))"""

ORACLES = {
    "fn06_ranges": "SELECT c_custkey, (c_custkey % 5 = 0)::INT AS ranges, CASE WHEN c_custkey % 5 = 0 THEN c_nationkey::INT END AS \"start\", CASE WHEN c_custkey % 5 = 0 THEN c_nationkey::INT + 5 END AS \"end\" FROM customer",
    "fn07_json_path": "SELECT c_custkey, c_mktsegment AS segment, c_nationkey::BIGINT AS nation, NULL::VARCHAR AS none FROM customer",
    "fn19_quotes": """WITH q AS (SELECT doc_id, text, CASE WHEN doc_id % 3 = 0 THEN substr(text, 3, 25) ELSE substr(substr(text, 5, 3), 1, (doc_id % 4)::INT) END AS quote FROM documents WHERE text IS NOT NULL),
      p AS (SELECT *, strpos(text, quote) AS a FROM q), o AS (SELECT *, length(quote) > 0 AND a > 0 AND strpos(substr(text, a + 1), quote) = 0 AS once FROM p)
      SELECT doc_id, CASE WHEN once THEN a::INT - 1 END AS "start", CASE WHEN once THEN a::INT - 1 + length(quote)::INT END AS "end" FROM o""",
    "fn27_literals": "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '\"' || p_name || '\"' WHEN 1 THEN p_size || '.0' WHEN 2 THEN CASE WHEN p_size % 2 = 0 THEN 'true' ELSE 'false' END WHEN 3 THEN '\"2024-03-' || lpad((p_size % 28 + 1)::VARCHAR, 2, '0') || 'T00:00:00.000Z\"' ELSE '{\"a\":[' || p_size || '],\"b\":1}' END AS literal FROM part",
    "fn33_salience_factor": "WITH k AS (SELECT c_custkey, CASE WHEN c_custkey % 6 <> 0 THEN c_acctbal::DOUBLE END AS own FROM customer) SELECT c_custkey AS subject_id, round(coalesce(1 + own / (SELECT greatest(1, max(own)) FROM k) * 0.1, 1), 9) AS factor FROM k",
    "fn33_factor_formula": "SELECT p_partkey, round(1 + p_size * 0.1, 9)::DOUBLE AS factor FROM part",
    "fn41_moments": """WITH s AS (SELECT l_orderkey, min(l_shipdate) FILTER (l_linenumber % 2 = 0)::TIMESTAMP AS shipped FROM lineitem GROUP BY 1),
      b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate::TIMESTAMP END AS ordered, shipped FROM orders LEFT JOIN s ON l_orderkey = o_orderkey)
      SELECT o_orderkey, CASE WHEN ordered IS NULL AND shipped IS NULL THEN 0 WHEN ordered IS NULL THEN 1 WHEN shipped IS NULL THEN -1 ELSE sign(epoch(ordered) - epoch(shipped)) END::INT AS sign, least(ordered, shipped) AS "first" FROM b""",
    "fn47_local_hours": """WITH e AS (SELECT ts, make_timestamp(year(ts)::BIGINT, 4, 1, 1, 0, 0) AS april, make_timestamp(year(ts)::BIGINT, 11, 1, 1, 0, 0) AS november FROM events)
      SELECT hour(ts + CASE WHEN ts >= april - to_days(CASE WHEN isodow(april) = 7 THEN 7 ELSE isodow(april) END::INT) AND ts < november - to_days(CASE WHEN isodow(november) = 7 THEN 7 ELSE isodow(november) END::INT) THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END)::INT AS hour, count(*) AS n FROM e GROUP BY 1""",
    "ag01_stage_counts": "SELECT count(DISTINCT conv_id) AS conversations, count(*) AS messages, coalesce(sum(length(coalesce(text, ''))), 0)::BIGINT AS chars FROM conversations",
    "ag09_greatest_salience": f"""WITH {SAID}, {HIT}, s AS (SELECT 0.3 * count(*) + 0.4 * count(DISTINCT conversation_id) + 0.2 * count(*) FILTER (role = 'user') / count(*) + 0.1 * exp(-ln(2) * epoch(TIMESTAMP '2024-01-01' - max(created_at)) / 86400 / 90) AS s FROM found GROUP BY entity_id)
      SELECT round(greatest(1, max(s)), 6) AS most FROM s""",
    "ag11_tier_histogram": f"""WITH {FACTS} SELECT 'subject' AS side, 1 AS tier, count(*) AS n, round(avg(confidence), 9) AS mean_grounding FROM facts WHERE subject_id % 2 = 0
      UNION ALL SELECT 'object', tier::INT, count(*), round(avg(confidence), 9) FROM facts GROUP BY tier""",
    "ag08_best_tiers": f"WITH {SAID}, {HIT} SELECT entity_id, min(tier)::INT AS best_tier FROM found GROUP BY 1",
    "jn03_context_mentions": f"WITH {SAID}, {HIT} SELECT s.message_id, f.entity_id, count(*) AS mentions FROM said s JOIN found f ON f.conversation_id = s.conversation_id AND f.order_index BETWEEN s.order_index - 5 AND s.order_index - 1 GROUP BY 1, 2",
    "jn09_entities_at_spans": f"""WITH {SAID}, {HIT}, spans AS (SELECT message_id, 0 AS x, length(text) // 2 AS y FROM said UNION ALL SELECT message_id, length(text) // 2, length(text) FROM said)
      SELECT s.message_id, s.x::INT AS "start", f.entity_id, f.tier::INT AS tier FROM spans s LEFT JOIN found f ON f.message_id = s.message_id AND s.x < f.b AND s.y > f.a""",
    "dt15_recognised": f"""WITH {SAID}, {NAMED} SELECT message_id, kind, (strpos(text, name) - 1)::INT AS "start", (strpos(text, name) - 1 + length(name))::INT AS "end", name AS surface FROM said, names WHERE regexp_matches(text, '\\b' || name || '\\b')""",
    "dt16_given_terms": f"WITH {SAID}, {TERMS} SELECT term_key, substr(text, a::INT + 1, length(form)) AS surface, count(*) AS n FROM met GROUP BY 1, 2",
    "dt22_lexicon_overlaps": f"""WITH {SAID}, {HIT}, {TERMS} SELECT message_id, term_key, a::INT AS "start", substr(text, a::INT + 1, length(form)) AS surface FROM met m
      WHERE NOT EXISTS (SELECT 1 FROM found f WHERE f.message_id = m.message_id AND m.a < f.b AND m.a + length(form) > f.a)""",
    "jn08_qualifiers": f"WITH {SAID}, {TIMES}, {QUALIFIED} SELECT assertion_id, qualifier, qualifier_start FROM linked",
    "ap27_superseded": f"""WITH {SAID}, made AS (SELECT p.message_id, p.predicate, s.conversation_id, s.order_index FROM ({_patterns()}) p JOIN said s USING (message_id) WHERE s.role = 'user' AND length(s.text) >= 10), {TAKEN},
      hit AS (SELECT DISTINCT arg_max(m.message_id, m.order_index) AS message_id FROM taken t JOIN made m ON m.conversation_id = t.conversation_id AND m.order_index < t.order_index AND m.order_index >= t.order_index - 20 WHERE t.what = 'full' GROUP BY t.message_id)
      SELECT message_id, predicate, 'retraction' AS supersession FROM made JOIN hit USING (message_id)""",
    "tr03_corrections": f"""WITH {STATUS}, c AS (SELECT j.*, j.assertion_id % 23 = 0 AND j.assertion_id % 3 <> 0 AND EXISTS (SELECT 1 FROM facts f WHERE f.assertion_id = j.assertion_id - 1) AS hit FROM judged j)
      SELECT assertion_id, CASE WHEN hit THEN 'superseded' ELSE status END AS status, CASE WHEN hit THEN assertion_id - 1 END AS corrected_by FROM c""",
    "gr07_retraction_nodes": f"""WITH {SAID}, {TAKEN}, r AS (SELECT *, {_uuid5("'[\"retraction\",\"' || message_id || '\",\"' || (strpos(text, surface) - 1) || '\",\"' || what || '\"]'", NAMESPACE)} AS rid FROM taken)
      SELECT {_node("Retraction", "rid")} AS node_id, 'Retraction' AS node_type, substr(surface, 1, 50) AS label, what AS kind FROM r""",
    "gr08_conflict_nodes": f"""WITH RECURSIVE {WALK}, c AS (
        SELECT CASE WHEN torn THEN 'OBJECT_DISAGREEMENT' ELSE 'SAME_TIME_DUPLICATES' END AS kind, n AS members FROM done WHERE torn OR n > 1
        UNION ALL SELECT CASE step WHEN 'blocked' THEN 'OBJ_TRANSITION_CONFLICT' WHEN 'close' THEN 'OBJ_CONFIDENCE_TOO_CLOSE' ELSE 'DETECTOR_TIER_TIEBREAK' END, 2 FROM done WHERE step IN ('blocked', 'close') OR (step = 'won' AND by_tier))
      SELECT 'ConflictGroup' AS node_type, kind || ' (' || members || ' members)' AS label, count(*) AS n FROM c GROUP BY 1, 2""",
    "gr09_lexicon_nodes": f"SELECT {_node('LexiconTerm', 'k')} AS node_id, 'LexiconTerm' AS node_type, k AS source_id, label FROM (VALUES ('acme', 'Acme'), ('hooli', 'Hooli'), ('tea', 'tea'), ('3 weeks', '3 weeks')) t(k, label)",
    "gr10_time_nodes": f"""WITH {SAID}, {TIMES}, s AS (SELECT *, message_id || '|' || place || '|' || surface AS source_id FROM spoken) SELECT {_node("TimeMention", "source_id")} AS node_id, 'TimeMention' AS node_type, source_id, substr(surface, 1, 30) AS label FROM s""",
    "gr21_hints": f"WITH {FACTS} SELECT 'Until ' || strftime(asserted_at, '%Y-%m-%d') AS label, count(*) AS edges FROM facts WHERE valid_from IS NULL AND assertion_id % 2 = 1 GROUP BY 1",
    "gr22_qualifier_edges": f"""WITH {SAID}, {TIMES}, {QUALIFIED}, l AS (SELECT *, message_id || '|' || qualifier_start || '|' || qualifier AS source FROM linked WHERE qualifier_start IS NOT NULL)
      SELECT 'QUALIFIED_BY_TIME' AS edge_type, {_node("Assertion", "assertion_id")} AS src_id, {_node("TimeMention", "source")} AS dst_id FROM l""",
    "gr24_lifecycle_edges": f"""WITH {FACTS}, e AS (SELECT 'SUPERSEDES' AS edge_type, assertion_id - 1 AS s, assertion_id AS d FROM facts WHERE assertion_id % 7 = 0 UNION ALL SELECT 'NEGATED_BY', assertion_id, assertion_id - 2 FROM facts WHERE assertion_id % 9 = 0
      UNION ALL SELECT 'NEGATES', assertion_id - 2, assertion_id FROM facts WHERE assertion_id % 9 = 0 UNION ALL SELECT 'RETRACTED_BY', assertion_id, assertion_id - 3 FROM facts WHERE assertion_id % 11 = 0 UNION ALL SELECT 'RETRACTS', assertion_id - 3, assertion_id FROM facts WHERE assertion_id % 11 = 0)
      SELECT edge_type, count(*) AS n, count(DISTINCT s) AS sources, count(DISTINCT d) AS targets FROM e GROUP BY 1""",
    "wf12_evidence": f"""WITH {FACTS}, r AS (SELECT subject_id, date_trunc('month', coalesce(valid_from, asserted_at))::TIMESTAMP AS window_start, object_signature AS member, assertion_id FROM facts),
      k AS (SELECT *, row_number() OVER (PARTITION BY subject_id, window_start, member ORDER BY assertion_id) - 1 AS r, count(*) OVER (PARTITION BY subject_id, window_start, member) AS total FROM r)
      SELECT subject_id, window_start, member, assertion_id, r::INT AS evidence_rank, total, total > 50 AS capped FROM k WHERE r < 50""",
    "qry04_profile": f"WITH {FACTS} SELECT min({_node('TemporalProfile', 'subject_id')}) AS node_id FROM (SELECT DISTINCT subject_id FROM facts)",
    "qry05_edges_from": f"""WITH {FACTS}, w AS (SELECT DISTINCT subject_id, date_trunc('month', coalesce(valid_from, asserted_at)) AS w FROM facts WHERE subject_id = 1)
      SELECT {_node("TemporalProfile", "subject_id")} AS src_id, {_node("TemporalWindow", "subject_id || '|' || strftime(w, '%Y-%m-%d')")} AS dst_id, (row_number() OVER (ORDER BY w) - 1)::INT AS window_index FROM w""",
    "vz01_profile_walk": f"""WITH {WALKED} SELECT window_index::INT AS window_index, monthname(window_start) || ' ' || year(window_start) AS window, category, member, rank, round(salience, 6) AS salience
      FROM placed_all p JOIN idx ON idx.subject_id = p.subject_id AND idx.w = p.window_start JOIN first ON first.subject_id = p.subject_id WHERE window_index < 36 AND rank <= 20""",
    "vz02_entities_between": f"""WITH {SAID}, {HIT} SELECT kind, lower(surface) AS key, count(*) AS mentions FROM found GROUP BY 1, 2 HAVING min(created_at) >= TIMESTAMP '1995-01-01' AND min(created_at) < TIMESTAMP '1996-01-01'""",
    "vz03_links": f"WITH {STATUS} SELECT subject_id, assertion_id % 150 AS object_id, confidence FROM judged WHERE status = 'active' AND assertion_id % 4 <> 0 AND confidence > 0.8 AND subject_id < 100 AND assertion_id % 150 IN (SELECT subject_id FROM facts WHERE subject_id < 100)",
}
