"""DuckDB SQL for the engine's queries, written from their meaning rather than their plans."""

from __future__ import annotations

from factloom.config import GRAPH_NAMESPACE, NAMESPACE
from factloom.sources import tables

CHAT = f"chat AS ({tables.CHAT})"
DOCS = f"docs AS ({tables.DOCUMENT_MESSAGES})"
SAID = f"said AS ({tables.UTTERANCES})"
FACTS = f"facts AS ({tables.FACTS})"
STATUS = (
    FACTS
    + """, judged AS (
  SELECT *, CASE WHEN confidence >= 0.7 AND polarity = 'positive' AND modality NOT IN ('question', 'intention') AND valid_from IS NOT NULL AND role = 'user' THEN 'active' ELSE 'ineligible' END AS status
  FROM facts)"""
)
# the functional walk, moment after moment
WALK = (
    STATUS
    + """, ready AS (SELECT * FROM judged WHERE status = 'active' AND valid_from IS NOT NULL AND predicate IN ('click', 'purchase')),
  moments AS (
    SELECT subject_id, predicate, valid_from, count(*) AS n, count(DISTINCT object_signature) > 1 AS torn,
           arg_min(struct_pack(id := assertion_id, obj := object_signature, conf := confidence, tier := tier), struct_pack(c := -confidence, t := tier, i := assertion_id)) AS rep,
           row_number() OVER (PARTITION BY subject_id, predicate ORDER BY valid_from) AS k
    FROM ready GROUP BY subject_id, predicate, valid_from),
  walk AS (
    SELECT *, NULL::VARCHAR AS step, false AS by_tier, torn AS held, NULL::BIGINT AS before FROM moments WHERE k = 1
    UNION ALL
    SELECT subject_id, predicate, valid_from, n, torn, rep, k, step, by_tier, torn OR coalesce(step = 'close', false) AS held, before FROM (
      SELECT m.*, w.rep.id AS before, coalesce(abs(m.rep.conf - w.rep.conf) < 0.01 AND m.rep.tier < w.rep.tier, false) AS by_tier,
             CASE WHEN m.rep.obj = w.rep.obj THEN NULL WHEN w.held OR m.torn THEN 'blocked'
                  WHEN m.rep.conf - w.rep.conf >= 0.01 OR (abs(m.rep.conf - w.rep.conf) < 0.01 AND m.rep.tier < w.rep.tier) THEN 'won' ELSE 'close' END AS step
      FROM walk w JOIN moments m ON m.subject_id = w.subject_id AND m.predicate = w.predicate AND m.k = w.k + 1)),
  done AS (SELECT *, lead(step) OVER (PARTITION BY subject_id, predicate ORDER BY k) AS next FROM walk)"""
)

GRAPH = STATUS + ", dated AS (SELECT *, CASE WHEN assertion_id % 2 = 0 THEN valid_from + INTERVAL 1 DAY END AS valid_to FROM judged)"
MONTHS = """placed AS (SELECT *, date_trunc('month', coalesce(valid_from, asserted_at)) AS w, coalesce(valid_from, asserted_at) AS seen FROM facts),
  win AS (SELECT subject_id, w, count(*) AS total FROM placed GROUP BY 1, 2)"""
MEMBERS = (
    MONTHS
    + """, per AS (
    SELECT p.subject_id, p.w, object_signature AS member, count(*) AS mentions, any_value(total) AS total, avg(confidence) AS conf,
           max(1 / (1 + 0.1 * greatest(0, floor(epoch(w2 - seen) / 86400)))) AS recency
    FROM (SELECT *, w + INTERVAL 1 MONTH AS w2 FROM placed) p JOIN win USING (subject_id, w) GROUP BY 1, 2, 3),
  spread AS (SELECT subject_id, member, count(*) AS mine FROM per GROUP BY 1, 2), alls AS (SELECT subject_id, count(*) AS windows FROM win GROUP BY 1),
  scored AS (
    SELECT subject_id, w AS window_start, member, mentions,
           (0.4 * mentions / total + 0.2 * recency + 0.4 * conf) * CASE WHEN windows > 1 THEN 0.7 + 0.3 * ln((1.0 + windows) / (1.0 + mine)) / ln(1.0 + windows) ELSE 1 END AS salience
    FROM per JOIN spread USING (subject_id, member) JOIN alls USING (subject_id))"""
)
VOTES = """votes AS (
    SELECT subject_id, w AS window_start, object_signature AS member, c.category,
           sum(CASE c.category WHEN 'interest' THEN (lower(predicate) LIKE '%like%')::int + (lower(predicate) LIKE '%interest%')::int + (lower(predicate) LIKE '%view%')::int + (modality = 'preference')::int
               WHEN 'task' THEN (lower(predicate) LIKE '%task%')::int + (lower(predicate) LIKE '%todo%')::int + (lower(predicate) LIKE '%click%')::int
               WHEN 'desire' THEN (lower(predicate) LIKE '%want%')::int + (lower(predicate) LIKE '%wish%')::int + (lower(predicate) LIKE '%purchase%')::int
               WHEN 'problem' THEN (lower(predicate) LIKE '%problem%')::int + (lower(predicate) LIKE '%error%')::int + (lower(predicate) LIKE '%issue%')::int + (modality = 'question')::int
               WHEN 'plan' THEN (lower(predicate) LIKE '%plan%')::int + (lower(predicate) LIKE '%intend%')::int + (lower(predicate) LIKE '%signup%')::int + (modality = 'intention')::int
               ELSE (lower(predicate) LIKE '%project%')::int + (lower(predicate) LIKE '%build%')::int + (lower(predicate) LIKE '%launch%')::int + (modality = 'fact')::int END) AS votes
    FROM placed, (VALUES ('project'), ('interest'), ('problem'), ('task'), ('desire'), ('plan')) c(category) GROUP BY 1, 2, 3, 4),
  cats AS (SELECT subject_id, window_start, member, CASE WHEN max(votes) > 0 THEN arg_min(category, struct_pack(v := -votes, c := category)) ELSE 'unclassified' END AS category FROM votes GROUP BY 1, 2, 3)"""


def _uuid5(name: str, namespace: str) -> str:
    """SQL of UUIDv5 of a name."""
    digest = f"sha1(unhex('{namespace.replace('-', '')}') || encode({name}))"
    return f"(SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab89ab89ab89ab', strpos('0123456789abcdef', substr(h, 17, 1)), 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) FROM (SELECT {digest} AS h))"


def _patterns() -> str:
    kin = "mother|father|sister|brother|wife|husband|friend|colleague|boss|partner|child|son|daughter"
    rows = [
        ("'works_at'", "state", 0.85, r"\bI\s+work\s+(?:at|for)\s+([A-Z][A-Za-z\s&.,''-]{1,50}?)\b"),
        ("'lives_in'", "state", 0.85, r"\bI\s+live\s+in\s+([A-Z][A-Za-z\s,''-]{1,50}?)\b"),
        ("'has_name'", "fact", 0.90, r"\bMy\s+name\s+is\s+([A-Z][A-Za-z\s''-]{1,40}?)\b"),
        ("'likes'", "preference", 0.70, r"\bI\s+(?:like|love|prefer|enjoy)\s+([A-Za-z][A-Za-z\s]{1,40}?)\b"),
        ("'dislikes'", "preference", 0.70, r"\bI\s+(?:don''t\s+like|hate|dislike)\s+([A-Za-z][A-Za-z\s]{1,40}?)\b"),
        ("'has'", "state", 0.70, r"\bI\s+have\s+(?:a\s+)?([A-Za-z][A-Za-z\s]{1,40}?)\b"),
        ("'has_' || lower(regexp_extract(text, '(?i)is\\s+my\\s+([a-z]+)', 1))", "fact", 0.85, rf"\b([A-Z][A-Za-z]+)\s+is\s+my\s+(?:{kin})\b"),
        ("'has_' || lower(regexp_extract(text, '(?i)\\bMy\\s+([a-z]+)\\s+is', 1))", "fact", 0.85, rf"\bMy\s+(?:{kin})\s+is\s+([A-Z][A-Za-z]+)\b"),
    ]
    return " UNION ALL ".join(
        f"SELECT message_id, {p} AS predicate, trim(regexp_extract(text, '(?i){x}', 1)) AS object, '{m}' AS modality, {c}::DOUBLE AS confidence, strpos(text, regexp_extract(text, '(?i){x}')) - 1 AS \"start\" FROM said WHERE role IN ('user', 'assistant') AND length(text) >= 10 AND regexp_matches(text, '(?i){x}')" for p, m, c, x in rows
    )


#: The time mentions that statements can hold, by what is said in them.
TIMES = """times AS (
    SELECT message_id, 'ISO_DATE' AS pattern, regexp_extract(text, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AS surface, regexp_extract(text, '[0-9]{4}-[0-9]{2}-[0-9]{2}')::TIMESTAMP AS a, regexp_extract(text, '[0-9]{4}-[0-9]{2}-[0-9]{2}')::TIMESTAMP + INTERVAL 1 DAY AS b, 1 AS less FROM said WHERE regexp_matches(text, '[0-9]{4}-[0-9]{2}-[0-9]{2}')
    UNION ALL SELECT message_id, 'RELATIVE_DAY', 'today', date_trunc('day', created_at), date_trunc('day', created_at) + INTERVAL 1 DAY, 1 FROM said WHERE text LIKE '% today'
    UNION ALL SELECT message_id, 'RELATIVE_AGO', '3 weeks ago', date_trunc('day', created_at) - INTERVAL 21 DAY, date_trunc('day', created_at) - INTERVAL 20 DAY, 1 FROM said WHERE text LIKE '%3 weeks ago'
    UNION ALL SELECT message_id, 'RELATIVE_PERIOD', 'last month', date_trunc('month', created_at) - INTERVAL 1 MONTH, date_trunc('month', created_at), 1 FROM said WHERE text LIKE '%last month'
    UNION ALL SELECT message_id, 'YEAR_ONLY', substr(text, 19, 4), make_timestamp(substr(text, 19, 4)::BIGINT, 1, 1, 0, 0, 0), make_timestamp(substr(text, 19, 4)::BIGINT + 1, 1, 1, 0, 0, 0), 1000 FROM said WHERE text LIKE 'Nothing to say in %'),
  spoken AS (SELECT t.*, strpos(text, surface) - 1 AS place, strftime(a, '%Y-%m-%dT%H:%M:%S.%gZ') AS valid_from, strftime(b - to_milliseconds(less), '%Y-%m-%dT%H:%M:%S.%gZ') AS valid_to FROM times t JOIN said USING (message_id))"""

ORACLES = {
    "prj02_role_normalize": f"WITH {CHAT} SELECT message_id, CASE WHEN lower(role) IN ('user', 'assistant', 'system', 'tool') THEN lower(role) ELSE 'unknown' END AS role FROM chat",
    "flt02_eligible_messages": f"WITH {CHAT} SELECT message_id, conversation_id, role FROM chat WHERE role IN ('user', 'assistant') AND length(text) >= 10",
    "wf01_order_index": f"WITH {CHAT} SELECT message_id, order_index::INT AS order_index FROM chat",
    "tree01_tree_path": f"WITH {CHAT} SELECT message_id, '000001' || repeat('.000001', order_index::INT) AS tree_path FROM chat",
    "jn05_context_window": f"WITH {CHAT} SELECT a.message_id, coalesce((SELECT string_agg(b.message_id::VARCHAR, ',' ORDER BY b.order_index) FROM chat b WHERE b.conversation_id = a.conversation_id AND b.order_index BETWEEN a.order_index - 5 AND a.order_index - 1), '') AS context FROM chat a",
    "fn01_uuid5": "SELECT c_custkey, " + _uuid5("'[\"entity\",\"' || c_name || '\"]'", NAMESPACE) + " AS id FROM customer",
    "fn04_surface_hash": "SELECT c_custkey, sha256(CASE WHEN c_custkey % 5 <> 0 THEN c_name ELSE '__NO_SURFACE__' END) AS hash FROM customer",
    "fn10_entity_key": "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN lower(trim(p_name || ' (1)-2 ')) WHEN 1 THEN lower(trim(regexp_replace(p_name || ' (1)-2', '\\s+', ' ', 'g'))) WHEN 2 THEN replace(p_name, ' ', '') || '12' ELSE trim(p_name || ' (1)-2') END AS key FROM part",
    "fn15_inferred_type": "SELECT s_suppkey, CASE WHEN s_suppkey % 3 < 2 THEN 'ORG' WHEN s_suppkey % 7 = 0 THEN 'PERSON' ELSE 'CUSTOM_TERM' END AS kind FROM supplier",
    "fn18_trimmed_url": "SELECT page_id, rtrim(url, '.,;:!?)>]') AS url FROM pages",
    "fn43_window_labels": "SELECT DISTINCT date_trunc('month', o_orderdate)::TIMESTAMP AS month, (date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH)::TIMESTAMP AS quarter_end, 'Q' || quarter(o_orderdate) || ' ' || year(o_orderdate) AS quarter, year(o_orderdate)::VARCHAR AS year FROM orders",
    "fn44_last_ms": "SELECT o_orderkey, strftime(last_day(o_orderdate), '%Y-%m-%d') || 'T23:59:59.999Z' AS ends_at FROM orders",
    "ag21_overview": f"WITH {CHAT}, per AS (SELECT conversation_id, count(*) AS n FROM chat GROUP BY 1) SELECT sum(n)::BIGINT AS messages, count(*) AS conversations, avg(n) AS mean_messages, median(n) AS median_messages FROM per",
    "ag22_resample_week": "WITH c AS (SELECT date_trunc('week', ts)::TIMESTAMP AS bucket, count(*) AS n FROM events GROUP BY 1), every AS (SELECT unnest(generate_series((SELECT min(bucket) FROM c), (SELECT max(bucket) FROM c), INTERVAL 7 DAY)) AS bucket) SELECT bucket, coalesce(n, 0) AS n FROM every LEFT JOIN c USING (bucket)",
    "ag23_day_hour": "WITH c AS (SELECT isodow(ts) - 1 AS weekday, hour(ts) AS hour, count(*) AS n FROM events GROUP BY 1, 2) SELECT d.x::INT AS weekday, h.x::INT AS hour, coalesce(n, 0) AS n FROM range(7) d(x), range(24) h(x) LEFT JOIN c ON c.weekday = d.x AND c.hour = h.x",
    "ag25_project_table": "WITH t AS (SELECT c_mktsegment AS project, c_custkey AS id, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rank, count(*) OVER (PARTITION BY c_mktsegment) AS items, min(c_custkey) OVER (PARTITION BY c_mktsegment) AS first_at, max(c_custkey) OVER (PARTITION BY c_mktsegment) AS last_at FROM customer) SELECT project, id, rank::INT AS rank, items, first_at, last_at FROM t WHERE rank <= 3",
    "ag27_by_role": f"WITH {CHAT} SELECT role, count(*) AS messages FROM chat GROUP BY 1",
    "ag28_message_histogram": f"WITH {CHAT}, per AS (SELECT conversation_id, count(*) AS n FROM chat GROUP BY 1) SELECT (n // 2 * 2)::BIGINT AS bin, count(*) AS conversations FROM per GROUP BY 1",
    "fn24_word_counts": f"WITH {CHAT} SELECT message_id, length(text)::INT AS chars, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))::INT AS words FROM chat",
    "qry06_shares": "SELECT event_type, count(*) AS n, count(*) / (SELECT count(*) FROM events)::DOUBLE AS share FROM events GROUP BY 1",
    "dt_candidates": f"""WITH {DOCS}, found AS (
      SELECT 'EMAIL' AS detector, unnest(regexp_extract_all(text, '\\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}\\b')) AS surface FROM docs
      UNION ALL SELECT 'IP_ADDRESS', unnest(regexp_extract_all(text, '\\b(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\\.){{3}}(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\\b')) FROM docs
      UNION ALL SELECT 'HASH_HEX', unnest(regexp_extract_all(text, '\\b(?:[0-9a-fA-F]{{32}}|[0-9a-fA-F]{{40}}|[0-9a-fA-F]{{64}}|[0-9a-fA-F]{{128}})\\b')) FROM docs)
      SELECT detector, count(*) AS n, count(DISTINCT surface) AS surfaces FROM found GROUP BY 1""",
    "ap_extracted": f"WITH {SAID} SELECT message_id, predicate, object, modality, confidence, \"start\"::INT AS \"start\" FROM ({_patterns()})",
    "rp_retractions": f"""WITH {SAID} SELECT message_id, 'full' AS kind, 0.8::DOUBLE AS confidence, regexp_extract(text, '(?i)\\b(?:Actually|Wait|No),?\\s+(?:that''s\\s+)?(?:not\\s+true|wrong|incorrect)\\b') AS surface FROM said WHERE role = 'user' AND regexp_matches(text, '(?i)\\b(?:Actually|Wait|No),?\\s+(?:that''s\\s+)?(?:not\\s+true|wrong|incorrect)\\b')
      UNION ALL SELECT message_id, 'temporal_bound', 0.8, regexp_extract(text, '(?i)\\bI\\s+(?:stopped|quit|no\\s+longer)\\s+(.+?)(?:\\.|$)') FROM said WHERE role = 'user' AND regexp_matches(text, '(?i)\\bI\\s+(?:stopped|quit|no\\s+longer)\\s+(.+?)(?:\\.|$)')""",
    "jn06_corroboration": f"""WITH {FACTS}, o AS (SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY asserted_at, assertion_id) AS i FROM facts)
      SELECT a.assertion_id, EXISTS (SELECT 1 FROM o b WHERE b.subject_id = a.subject_id AND b.role = 'user' AND b.object_signature = a.object_signature AND b.i >= a.i - 10 AND b.i < a.i AND (b.predicate = a.predicate OR jaro_winkler_similarity(a.predicate, b.predicate) >= 0.9)) AS corroborated FROM o a WHERE a.role = 'assistant'""",
    "flt10_eligibility": f"""WITH {STATUS} SELECT assertion_id, concat_ws(',', CASE WHEN confidence < 0.7 THEN 'LOW_CONFIDENCE' END, CASE WHEN polarity <> 'positive' THEN 'NEGATIVE_POLARITY' END, CASE WHEN modality IN ('question', 'intention') THEN 'MODALITY' END, CASE WHEN valid_from IS NULL THEN 'NO_VALID_FROM' END, CASE WHEN valid_from IS NULL THEN 'NO_EXPLICIT_TIME' END, CASE WHEN role <> 'user' THEN 'NOT_USER_GROUNDED' END) AS reasons, status FROM judged""",
    "jn18_rules": f"""WITH {FACTS} SELECT DISTINCT predicate, CASE WHEN subject_id % 2 = 0 THEN 'even' ELSE 'odd' END AS subject_type,
      CASE WHEN predicate = 'purchase' AND subject_id % 2 = 0 THEN 3 WHEN predicate = 'click' THEN 1 WHEN subject_id % 2 = 1 THEN 4 ELSE 2 END AS rule_id,
      NOT (predicate <> 'click' AND subject_id % 2 = 0 AND predicate <> 'purchase') AS functional FROM facts""",
    "tr05_negations": f"""WITH {STATUS}, marked AS (SELECT *, polarity = 'negative' AND role = 'user' AND confidence >= 0.7 AND valid_from IS NOT NULL AS may FROM judged),
      g AS (SELECT subject_id, predicate, object_signature, count(*) FILTER (polarity = 'positive' AND status = 'active') AS targets, bool_or(may) AS denied FROM marked GROUP BY 1, 2, 3)
      SELECT CASE WHEN polarity = 'positive' AND status = 'active' AND targets = 1 AND denied THEN 'negated' ELSE status END AS status, may AND targets > 1 AS ambiguous, count(*) AS n
      FROM marked JOIN g USING (subject_id, predicate, object_signature) GROUP BY 1, 2""",
    "tr06_functional": f"""WITH RECURSIVE {WALK}, judged2 AS (
        SELECT j.predicate, CASE WHEN d.torn IS NULL THEN j.status WHEN d.torn OR (d.rep.id = j.assertion_id AND (coalesce(d.step = 'close', false) OR coalesce(d.next = 'close', false))) THEN 'conflicted'
          WHEN d.rep.id = j.assertion_id AND d.next = 'won' THEN 'superseded' ELSE j.status END AS status
        FROM judged j LEFT JOIN done d ON j.status = 'active' AND d.subject_id = j.subject_id AND d.predicate = j.predicate AND d.valid_from = j.valid_from)
      SELECT predicate, status, count(*) AS n, count(*) FILTER (status = 'superseded') AS superseded FROM judged2 GROUP BY 1, 2""",
    "tr07_conflicts": f"""WITH RECURSIVE {WALK}, found AS (
        SELECT CASE WHEN torn THEN 'OBJECT_DISAGREEMENT' ELSE 'SAME_TIME_DUPLICATES' END AS kind, n AS members FROM done WHERE torn OR n > 1
        UNION ALL SELECT CASE step WHEN 'blocked' THEN 'OBJ_TRANSITION_CONFLICT' WHEN 'close' THEN 'OBJ_CONFIDENCE_TOO_CLOSE' ELSE 'DETECTOR_TIER_TIEBREAK' END, 2 FROM done WHERE step IN ('blocked', 'close') OR (step = 'won' AND by_tier))
      SELECT kind, count(*) AS n, sum(members)::BIGINT AS members FROM found GROUP BY 1""",
    "qry03_month_items": f"""WITH {FACTS}, {MEMBERS}, {VOTES} SELECT subject_id, monthname(window_start) || ' ' || year(window_start) AS label, member, category, round(salience, 6) AS salience
      FROM scored JOIN cats USING (subject_id, window_start, member) WHERE strftime(window_start, '%Y-%m') = '2024-01' OR monthname(window_start) = 'January' ORDER BY round(salience, 6) DESC, subject_id, member LIMIT 20""",
    "jn07_retraction_targets": f"""WITH {SAID}, made AS (SELECT p.message_id, s.conversation_id, s.order_index FROM ({_patterns()}) p JOIN said s USING (message_id) WHERE s.role = 'user' AND length(s.text) >= 10),
      taken AS (SELECT *, 'full' AS kind FROM said WHERE role = 'user' AND regexp_matches(text, '(?i)\\b(?:Actually|Wait|No),?\\s+(?:that''s\\s+)?(?:not\\s+true|wrong|incorrect)\\b')
        UNION ALL SELECT *, 'temporal_bound' FROM said WHERE role = 'user' AND regexp_matches(text, '(?i)\\bI\\s+(?:stopped|quit|no\\s+longer)\\s+(.+?)(?:\\.|$)'))
      SELECT t.message_id, t.kind, arg_max(m.message_id, m.order_index) AS target_message FROM taken t LEFT JOIN made m ON m.conversation_id = t.conversation_id AND m.order_index < t.order_index AND m.order_index >= t.order_index - 20 GROUP BY 1, 2""",
    "tr04_retracted": f"WITH {STATUS} SELECT CASE WHEN assertion_id % 19 = 0 AND confidence >= 0.7 AND role = 'user' THEN 'retracted' ELSE status END AS status, count(*) AS n FROM judged GROUP BY 1",
    "ag12_status_counts": f"WITH {STATUS} SELECT status, count(*) AS n FROM judged GROUP BY 1",
    "dq01_quality": f"WITH {STATUS} SELECT count(*) AS facts, count(valid_from) AS dated, count(*) FILTER (status = 'active') AS active, min(valid_from) AS first_at, max(valid_from) AS last_at, count(DISTINCT subject_id) AS subjects, round(avg(confidence), 9) AS mean_confidence FROM judged",
    "gr_nodes": f"""WITH {GRAPH}, n AS (SELECT 'Assertion' AS node_type, assertion_id::VARCHAR AS source, substr(subject_id || ' ' || predicate || ' ' || object_signature, 1, 100) AS label FROM dated
      UNION SELECT 'Entity', subject_id::VARCHAR, subject_id::VARCHAR FROM dated UNION SELECT 'Predicate', predicate, predicate FROM dated UNION SELECT 'Value', object_signature, object_signature FROM dated
      UNION SELECT 'TimeInterval', valid_from::VARCHAR || '|' || coalesce(valid_to::VARCHAR, '-'), CASE WHEN valid_to IS NULL THEN 'Since ' || strftime(valid_from, '%Y-%m-%d') ELSE strftime(valid_from, '%Y-%m-%d') || ' to ' || strftime(valid_to, '%Y-%m-%d') END FROM dated WHERE valid_from IS NOT NULL)
      SELECT node_type, count(*) AS n, count(DISTINCT label) AS labels FROM n GROUP BY 1""",
    "gr20_edges": f"""WITH {GRAPH} SELECT 'HAS_SUBJECT' AS edge_type, count(*) AS n, count(DISTINCT subject_id) AS targets FROM dated UNION ALL SELECT 'HAS_PREDICATE', count(*), count(DISTINCT predicate) FROM dated UNION ALL SELECT 'HAS_OBJECT', count(*), count(DISTINCT object_signature) FROM dated
      UNION ALL SELECT 'VALID_IN', count(*), count(DISTINCT valid_from::VARCHAR || '|' || coalesce(valid_to::VARCHAR, '-')) FROM dated WHERE valid_from IS NOT NULL""",
    "gr30_node_ids": f"WITH {FACTS} SELECT DISTINCT predicate, " + _uuid5("'[\"node\",\"Predicate\",\"' || predicate || '\"]'", GRAPH_NAMESPACE) + " AS node_id FROM facts",
    "jn23_conflict_pairs": f"""WITH {FACTS}, g AS (SELECT subject_id, count(*) AS n FROM facts GROUP BY 1) SELECT 'HAS_CONFLICT_MEMBER' AS edge_type, sum(n)::BIGINT AS n FROM g UNION ALL SELECT 'CONFLICTS_WITH', sum(n * (n - 1) // 2)::BIGINT FROM g WHERE n BETWEEN 2 AND 10 HAVING count(*) > 0""",
    "gr12_topics": f"""WITH {FACTS} SELECT sha256(predicate || '|' || object_signature || '|' || modality || '|' || polarity) AS topic_id, count(*) AS "count", min(coalesce(valid_from, asserted_at)) AS first_at, round(avg(confidence), 9) AS mean_confidence, arg_min(assertion_id, struct_pack(a := coalesce(valid_from, asserted_at), i := assertion_id)) AS first_member FROM facts GROUP BY predicate, object_signature, modality, polarity""",
    "snk02_upsert": f"WITH {FACTS} SELECT subject_id || '|' || predicate AS pk, max(assertion_id) AS assertion_id, arg_max(object_signature, assertion_id) AS object_signature FROM facts GROUP BY subject_id, predicate",
    "snk04_insert_ignore": f"WITH {FACTS} SELECT subject_id || '|' || predicate AS pk, min(assertion_id) AS assertion_id, arg_min(object_signature, assertion_id) AS object_signature FROM facts GROUP BY subject_id, predicate",
    "tp00_focal": f"WITH {FACTS} SELECT subject_id FROM facts GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1",
    "tp01_windows": f"""WITH {FACTS}, {MONTHS} SELECT subject_id, w::TIMESTAMP AS window_start, monthname(w) || ' ' || year(w) AS label, (row_number() OVER (PARTITION BY subject_id ORDER BY w) - 1)::INT AS window_index, (lag(w) OVER (PARTITION BY subject_id ORDER BY w))::TIMESTAMP AS previous, total AS facts FROM win""",
    "jn22_overlap_windows": f"""WITH {GRAPH}, {MONTHS.replace('FROM facts', 'FROM dated')} SELECT w::TIMESTAMP AS window_start, count(*) AS n FROM dated d JOIN win USING (subject_id) WHERE d.valid_from < w + INTERVAL 1 MONTH AND (d.valid_to IS NULL OR d.valid_to >= w) GROUP BY 1""",
    "tp02_salience": f"WITH {FACTS}, {MEMBERS} SELECT subject_id, window_start::TIMESTAMP AS window_start, member, mentions, round(salience, 6) AS salience FROM scored",
    "tp03_categories": f"WITH {FACTS}, {MONTHS}, {VOTES} SELECT subject_id, window_start::TIMESTAMP AS window_start, member, category FROM cats",
    "st_daily_counts": "SELECT date_trunc('day', ts)::TIMESTAMP AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "dt20_overlap_winners": f"""WITH {SAID}, c AS (
      SELECT message_id, 'EMAIL' AS detector, regexp_extract(text, '\\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}\\b') AS surface, true AS kept, text FROM said WHERE text LIKE '%@%'
      UNION ALL SELECT message_id, 'URL', rtrim(regexp_extract(text, 'https?://[^ ]+'), '.,;:!?)>]'), true, text FROM said WHERE text LIKE '%http%'
      UNION ALL SELECT message_id, 'BARE_DOMAIN', regexp_extract(text, 'https?://([a-z.]+)', 1), false, text FROM said WHERE text LIKE '%http%')
      SELECT message_id, detector, (strpos(text, surface) - 1)::INT AS "start", (strpos(text, surface) - 1 + length(surface))::INT AS "end", surface, kept FROM c""",
    "ag04_entities": f"""WITH {SAID}, hit AS (
      SELECT 'EMAIL' AS kind, lower(regexp_extract(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}')) AS key, * FROM said WHERE text LIKE '%@%'
      UNION ALL SELECT 'URL', lower(rtrim(regexp_extract(text, 'https?://[^ ]+'), '.,;:!?)>]')), * FROM said WHERE text LIKE '%http%'),
      per AS (SELECT kind, key, count(*) AS mentions, count(DISTINCT conversation_id) AS conversations, count(*) FILTER (role = 'user') AS user_mentions, max(created_at) AS last_seen FROM hit GROUP BY 1, 2)
      SELECT kind, key, key AS name, mentions, conversations, user_mentions,
             round(0.3 * mentions + 0.4 * conversations + 0.2 * user_mentions / mentions + 0.1 * exp(-ln(2) * epoch(TIMESTAMP '2024-01-01' - last_seen) / 86400 / 90), 6) AS salience FROM per""",
    "ap22_predicates": f"""WITH {SAID} SELECT predicate AS label, min(created_at) AS first_seen, count(*) AS assertions FROM ({_patterns()}) JOIN said USING (message_id) GROUP BY 1""",
    "tm_time_mentions": f"""WITH {SAID}, {TIMES} SELECT message_id, pattern, place::INT AS "start", surface, 'interval' AS resolved_type, valid_from, valid_to FROM spoken""",
    "tr01_valid_time": f"""WITH {SAID}, {TIMES} SELECT message_id || '-' || predicate AS assertion_id, coalesce(valid_from, strftime(created_at, '%Y-%m-%dT%H:%M:%S.%gZ')) AS valid_from, valid_to,
      CASE WHEN valid_from IS NULL THEN 'asserted_at' ELSE 'explicit' END AS valid_source FROM ({_patterns()}) JOIN said USING (message_id) LEFT JOIN spoken USING (message_id)""",
    "fn52_exclusions": f"""WITH {SAID} SELECT message_id, (message_id % 3 = 0)::INT AS fences, (message_id % 3 = 1)::INT AS quotes,
      CASE message_id % 3 WHEN 0 THEN length(text) + 1 WHEN 1 THEN 0 END::INT AS "start", CASE message_id % 3 WHEN 0 THEN length(text) + 14 WHEN 1 THEN 8 END::INT AS "end" FROM said""",
    "wf10_cluster_rank": f"""WITH {FACTS}, {MEMBERS}, {VOTES}, j AS (SELECT *, row_number() OVER (PARTITION BY subject_id, window_start, category ORDER BY salience DESC, member)::INT AS cluster_rank,
      row_number() OVER (PARTITION BY subject_id, window_start ORDER BY salience DESC, member)::INT AS window_rank FROM scored JOIN cats USING (subject_id, window_start, member))
      SELECT subject_id, window_start::TIMESTAMP AS window_start, member, category, cluster_rank, window_rank FROM j WHERE cluster_rank <= 50""",
    "wf09_cluster_evolves": f"""WITH {FACTS}, {MONTHS}, {VOTES}, c AS (SELECT subject_id, window_start, category, count(*) AS size FROM cats GROUP BY 1, 2, 3), p AS (SELECT subject_id, w, lag(w) OVER (PARTITION BY subject_id ORDER BY w) AS prev FROM win)
      SELECT c.subject_id, c.window_start::TIMESTAMP AS window_start, c.category, c.size, EXISTS (SELECT 1 FROM c o WHERE o.subject_id = c.subject_id AND o.category = c.category AND o.window_start = p.prev) AS evolves FROM c JOIN p ON p.subject_id = c.subject_id AND p.w = c.window_start""",
    "wf13_topic_support": f"""WITH {FACTS} SELECT sha256(predicate || '|' || object_signature || '|' || modality || '|' || polarity) AS topic_id, (row_number() OVER (PARTITION BY predicate, object_signature, modality, polarity ORDER BY coalesce(valid_from, asserted_at), assertion_id) - 1)::INT AS rank, assertion_id FROM facts""",
    "gr23_message_anchors": f"WITH {SAID}, a AS (SELECT DISTINCT message_id, predicate FROM ({_patterns()})) SELECT 'ASSERTED_IN' AS edge_type, count(*) AS n, count(DISTINCT message_id) AS messages FROM a",
    "ag26_surface_distribution": f"""WITH {SAID}, hit AS (SELECT regexp_extract(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}') AS s FROM said WHERE text LIKE '%@%' UNION ALL SELECT rtrim(regexp_extract(text, 'https?://[^ ]+'), '.,;:!?)>]') FROM said WHERE text LIKE '%http%')
      SELECT surfaces::INT AS surfaces, count(*) AS entities FROM (SELECT lower(s), count(DISTINCT s) AS surfaces FROM hit GROUP BY 1) GROUP BY 1""",
    "qry01_user_entities": f"""WITH {SAID}, hit AS (
      SELECT 'EMAIL' AS kind, lower(regexp_extract(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}')) AS key, * FROM said WHERE text LIKE '%@%'
      UNION ALL SELECT 'URL', lower(rtrim(regexp_extract(text, 'https?://[^ ]+'), '.,;:!?)>]')), * FROM said WHERE text LIKE '%http%')
      SELECT kind, key, round(0.3 * count(*) + 0.4 * count(DISTINCT conversation_id) + 0.2 * count(*) FILTER (role = 'user') / count(*) + 0.1 * exp(-ln(2) * epoch(TIMESTAMP '2024-01-01' - max(created_at)) / 86400 / 90), 6) AS salience
      FROM hit GROUP BY 1, 2 HAVING count(*) FILTER (role = 'user') > 0 ORDER BY salience DESC, kind, key LIMIT 50""",
    "ag24_top_words": f"""WITH {CHAT}, w AS (SELECT regexp_replace(unnest(regexp_split_to_array(lower(text), '\\s+')), '[^\\p{{L}}\\p{{N}}_-]', '', 'g') AS word FROM chat) SELECT word, count(*) AS n FROM w WHERE length(word) >= 3 GROUP BY 1 ORDER BY n DESC, word LIMIT 50""",
    "fn30_lexicon_score": "SELECT p_partkey, round(p_size + 2.0 * (p_partkey % 7) + 0.5 * (p_retailprice / 1000.0) - 0.5, 6) AS score FROM part",
}
