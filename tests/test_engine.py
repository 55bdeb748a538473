"""Engine operators on small fixtures with values worked out by hand."""

import datetime as dt
import json
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from factloom.config import NAMESPACE, DetectConfig, ProfileConfig, TemporalConfig
from factloom.functions import ids, scores, spans, text, times
from factloom.operators import assertions, detect, entities, graph, lexicon, markup, profile, recognize, temporal, threads, timex, views
from factloom.sources import export

ANCHOR = dt.datetime(2024, 3, 13, 10)


def messages(spark, *texts, role="user"):
    return spark.createDataFrame([(i, i % 2, role, t, ANCHOR, i) for i, t in enumerate(texts)], "message_id long, conversation_id long, role string, text string, created_at timestamp, order_index int")


def test_uuid5_equals_the_library(spark):
    for value in ('a"é😀', "", None, "tab\tand\nline", "back\\slash"):
        got = spark.createDataFrame([(value,)], "x string").select(ids.entity_id("message", F.col("x"))).first()[0]
        name = json.dumps(["message", "__NULL__" if value is None else value or "__EMPTY__"], ensure_ascii=False, separators=(",", ":"))
        assert got == str(uuid.uuid5(uuid.UUID(NAMESPACE), name))


@pytest.mark.parametrize(("a", "b", "want"), [("martha", "marhta", 0.9611), ("abcd", "abxy", 0.7333), ("", "x", 0.0), ("same", "same", 1.0)])
def test_jaro_winkler(a, b, want):
    assert text.jaro_winkler_of(a, b) == pytest.approx(want, abs=1e-4)


def test_times_from_anything(spark):
    rows = spark.createDataFrame([("1700000000.1239",), ("2024-01-05T10:00:00+02:00",), ("nonsense",), (None,)], "x string")
    assert [r[0] for r in rows.select(times.iso_ms(times.from_any(F.col("x")))).collect()] == ["2023-11-14T22:13:20.123Z", "2024-01-05T08:00:00.000Z", None, None]


def test_ranges_merge_when_they_touch(spark):
    one = spark.range(1).select(spans.merged(F.expr("array(named_struct('start',5,'end',9),named_struct('start',0,'end',2),named_struct('start',2,'end',4),named_struct('start',6,'end',7))")).alias("m")).first().m
    assert [(r.start, r.end) for r in one] == [(0, 4), (5, 9)]


def test_scores(spark):
    row = spark.range(1).select(
        scores.grounding(F.lit(1.0), F.lit(1), F.lit(None).cast("double"), F.lit(None).cast("int")).alias("literal"),
        scores.grounding(F.lit(1.0), F.lit(1), F.lit(0.5), F.lit(4)).alias("new"),
        scores.salience(F.lit(2), F.lit(1), F.lit(1), F.to_timestamp(F.lit("2024-01-01")), F.to_timestamp(F.lit("2024-03-31"))).alias("salience"),
        scores.alignment(F.lit(0), F.lit(14), F.lit(18), F.lit(28)).alias("near"),
    ).first()
    assert (row.literal, row.new) == (1.0, pytest.approx(0.825)) and row.salience == pytest.approx(1.15) and row.near == pytest.approx(0.2)


@pytest.mark.parametrize(
    ("said", "want"),
    [
        ("mail a.b@c.io now", [("EMAIL", 5, 13)]),
        ("see https://x.org/p).", [("URL", 4, 19)]),
        ("0000-0002-1825-0097 is", [("ORCID", 0, 19)]),
        ("0000-0002-1825-0098 is", []),
        ("cve-2024-12345", []),
        ("😀 a@b.io", [("EMAIL", 2, 8)]),
    ],
)
def test_detectors(spark, said, want):
    found = detect.resolved(detect.candidates(messages(spark, said), DetectConfig())).where("kept").orderBy("start").collect()
    assert [(r.detector, r.start, r.end) for r in found if r.detector != "PHONE"] == want


def test_winners_are_disjoint_and_losers_name_one(spark):
    rows = detect.resolved(detect.candidates(messages(spark, "see https://a.com/x and b@c.com or 10.0.0.1 at www.c.com"))).collect()
    kept = [(r.start, r.end) for r in rows if r.kept]
    assert all(a == b or a[1] <= b[0] or b[1] <= a[0] for a in kept for b in kept)
    assert all((r.winner_start, r.winner_end) in kept for r in rows)


@pytest.mark.parametrize(
    ("said", "start", "end", "grain"),
    [
        ("on 2024-01-05", "2024-01-05T00:00:00.000Z", "2024-01-05T23:59:59.999Z", "day"),
        ("in January 2024", "2024-01-01T00:00:00.000Z", "2024-01-31T23:59:59.999Z", "month"),
        ("on January 15, 2024", "2024-01-15T00:00:00.000Z", "2024-01-15T23:59:59.999Z", "day"),
        ("of 2023", "2023-01-01T00:00:00.000Z", "2023-12-31T23:59:59.000Z", "year"),
        ("yesterday", "2024-03-12T00:00:00.000Z", "2024-03-12T23:59:59.999Z", "day"),
        ("last month", "2024-02-01T00:00:00.000Z", "2024-02-29T23:59:59.999Z", "month"),
        ("3 weeks ago", "2024-02-21T00:00:00.000Z", "2024-02-21T23:59:59.999Z", "day"),
        ("Wednesday", "2024-03-06T00:00:00.000Z", "2024-03-06T23:59:59.999Z", "day"),
        ("Monday", "2024-03-11T00:00:00.000Z", "2024-03-11T23:59:59.999Z", "day"),
    ],
)
def test_time_mentions(spark, said, start, end, grain):
    (r,) = timex.time_mentions(messages(spark, said)).select("granularity", times.iso_ms(F.col("valid_from")).alias("a"), times.iso_ms(F.col("valid_to")).alias("b")).collect()
    assert (r.a, r.b, r.granularity) == (start, end, grain)


def test_relative_times_need_an_anchor(spark):
    rows = messages(spark, "yesterday").withColumn("timestamp_quality", F.lit("imputed_prior"))
    (r,) = timex.time_mentions(rows).collect()
    assert r.resolved_type == "unresolved" and r.confidence == 0 and r.valid_from is None


def test_tree_paths_roots_and_cycles(spark):
    rows = spark.createDataFrame([("c", "a", None), ("c", "b", "a"), ("c", "d", "a"), ("c", "x", "gone"), ("c", "p", "q"), ("c", "q", "p")], "conversation_id string, message_id string, parent_id string")
    got = {r.message_id: r.tree_path for r in threads.tree_paths(rows).collect()}
    assert got == {"a": "000001", "b": "000001.000001", "d": "000001.000002", "x": "000002", "p": "000003", "q": "000004"}


def test_deep_threads(spark):
    rows = spark.range(150).select(F.lit(1).alias("conversation_id"), F.col("id").alias("message_id"), F.when(F.col("id") > 0, F.col("id") - 1).alias("parent_id"))
    got = threads.ordered(threads.tree_paths(rows)).where("message_id = 149").first()
    assert got.order_index == 149 and got.tree_path.count(".") == 149


def test_export_to_messages(spark, tmp_path):
    value = {"conversation_id": "c1", "title": "t", "create_time": 1700000000.1239, "mapping": {"r": {"id": "r", "parent": None, "message": None}, "a": {"id": "a", "parent": "r", "message": {"author": {"role": "user"}, "create_time": None, "content": {"content_type": "text", "parts": ["I work at Acme on 2024-01-05"]}}}, "b": {"id": "b", "parent": "a", "message": {"author": {"role": "ASSISTANT"}, "create_time": 5, "content": {"content_type": "text", "parts": ["Noted", "Second part"]}}}}}
    for shape in (value, [value], {"conversations": [value]}):
        path = tmp_path / f"{len(json.dumps(shape))}.json"
        path.write_text(json.dumps(shape))
        convs = export.conversations(export.read_export(spark, str(path)))
        assert convs.select(times.iso_ms(F.col("created_at"))).first()[0] == "2023-11-14T22:13:20.123Z"
        found = export.messages(convs)
        whole = {r.node_id: r for r in threads.tree_paths(export.assembled(found, export.parts(found))).collect()}
        assert set(whole) == {"a", "b"}
        assert (whole["a"].text, whole["a"].content_type, whole["a"].timestamp_quality) == ("I work at Acme on 2024-01-05", "text", "imputed_prior")
        assert (whole["b"].text, whole["b"].content_type, whole["b"].role) == ("Noted\n\nSecond part", "mixed", "assistant")
        assert [(s.start, s.end) for s in whole["b"].text_map] == [(0, 5), (7, 18)]
        assert whole["a"].tree_path == "000001" and whole["b"].tree_path == "000001.000001"
        assert whole["a"].message_id == str(uuid.uuid5(uuid.UUID(NAMESPACE), '["message","c1","a"]'))


@pytest.mark.parametrize(("said", "predicate", "thing"), [("I am a software engineer", "is_a", "software"), ("I live in New York", "lives_in", "New"), ("I work for AT&T", "works_at", "AT"), ("Bob is my brother", "has_brother", "Bob"), ("I don't like tea", "dislikes", "tea")])
def test_assertions(spark, said, predicate, thing):
    (r,) = assertions.extracted(messages(spark, said)).collect()
    assert (r.predicate, r.object) == (predicate, thing)


def test_grounding_makes_an_entity_once(spark):
    said = messages(spark, "I work at Acme on x", "I work at Acme on y", "I work at Known now")
    known = spark.createDataFrame([("e1", "ORG", "known", "Known", ["Known", "KN"], 1.0)], "entity_id string, kind string, key string, name string, aliases array<string>, salience double")
    got = assertions.grounded(said, assertions.extracted(said), known).orderBy("message_id").collect()
    assert [r.object_conf for r in got] == [0.5, 0.95, 0.95] and got[2].object_entity == "e1" and got[0].object_entity == got[1].object_entity
    assert got[0].final == pytest.approx(0.70125) and got[1].final == pytest.approx(0.85)


def test_retractions_point_to_the_latest_statement(spark):
    said = spark.createDataFrame([(1, 7, "user", "I like tea", ANCHOR, 0), (2, 7, "user", "I like jam", ANCHOR, 1), (3, 7, "user", "Actually, that's not true", ANCHOR, 2)], "message_id long, conversation_id long, role string, text string, created_at timestamp, order_index int")
    none = spark.createDataFrame([], "entity_id string, kind string, key string, name string, aliases array<string>, salience double")
    made = assertions.grounded(said, assertions.extracted(said), none)
    (r,) = assertions.retraction_targets(assertions.retractions(said), said, made).collect()
    assert r.kind == "full" and r.target_id == made.where("message_id = 2").first().assertion_id


def walk(rows, config):
    """The walk of one functional (subject, predicate), moment by moment: what the windows must come to."""
    rows = rows.sort_values(["valid_from", "assertion_id"], kind="stable").reset_index(drop=True)
    rows["superseded_by"] = pd.Series([None] * len(rows), dtype="object")
    conflicts: list[tuple[str, str, list]] = []
    previous = None
    for when, some in rows.groupby("valid_from", sort=True):
        ids = some.sort_values("assertion_id").index.tolist()
        tags = [rows.at[i, "assertion_id"] for i in ids]
        if some["object_signature"].nunique() > 1:
            rows.loc[ids, "status"] = "conflicted"
            conflicts.append(("OBJECT_DISAGREEMENT", str(when), tags))
        elif len(ids) > 1:
            conflicts.append(("SAME_TIME_DUPLICATES", str(when), tags))
        now = min(ids, key=lambda i: (-rows.at[i, "confidence"], rows.at[i, "tier"], rows.at[i, "assertion_id"]))
        if previous is not None:
            pair = [rows.at[previous, "assertion_id"], rows.at[now, "assertion_id"]]
            if rows.at[previous, "object_signature"] == rows.at[now, "object_signature"]:
                pass
            elif "conflicted" in (rows.at[previous, "status"], rows.at[now, "status"]):
                conflicts.append(("OBJ_TRANSITION_CONFLICT", str(when), pair))
            else:
                gain = rows.at[now, "confidence"] - rows.at[previous, "confidence"]
                better_tier = config.tier_tiebreak and abs(gain) < config.margin and rows.at[now, "tier"] < rows.at[previous, "tier"]
                if gain >= config.margin or better_tier:
                    rows.at[previous, "status"] = "superseded"
                    rows.at[previous, "superseded_by"] = str(rows.at[now, "assertion_id"])
                    end = rows.at[previous, "valid_to"]
                    rows.at[previous, "valid_to"] = when if pd.isna(end) else min(end, when)
                    if better_tier:
                        conflicts.append(("DETECTOR_TIER_TIEBREAK", str(when), pair))
                else:
                    rows.loc[[previous, now], "status"] = "conflicted"
                    conflicts.append(("OBJ_CONFIDENCE_TOO_CLOSE", str(when), pair))
        previous = now
    return rows, conflicts


def walked(*rows):
    frame = pd.DataFrame([dict(assertion_id=i, valid_from=pd.Timestamp(t), object_signature=o, confidence=c, tier=tier, status="active", valid_to=pd.NaT) for i, (t, o, c, tier) in enumerate(rows)])
    done, conflicts = walk(frame, TemporalConfig())
    return done.sort_values("assertion_id").status.tolist(), [k for k, _, _ in conflicts], done


T = ["2024-01-01", "2024-02-01", "2024-03-01"]


@pytest.mark.parametrize(
    ("rows", "statuses", "kinds"),
    [
        ([(T[0], "A", 0.85, 4), (T[1], "B", 0.90, 4)], ["superseded", "active"], []),
        ([(T[0], "A", 0.85, 4), (T[1], "B", 0.85, 4)], ["conflicted", "conflicted"], ["OBJ_CONFIDENCE_TOO_CLOSE"]),
        ([(T[0], "A", 0.90, 4), (T[1], "B", 0.80, 4)], ["conflicted", "conflicted"], ["OBJ_CONFIDENCE_TOO_CLOSE"]),
        ([(T[0], "A", 0.85, 2), (T[1], "B", 0.855, 1)], ["superseded", "active"], ["DETECTOR_TIER_TIEBREAK"]),
        ([(T[0], "A", 0.85, 4), (T[0], "B", 0.85, 4)], ["conflicted", "conflicted"], ["OBJECT_DISAGREEMENT"]),
        ([(T[0], "A", 0.80, 4), (T[0], "A", 0.85, 4), (T[1], "B", 0.90, 4)], ["active", "superseded", "active"], ["SAME_TIME_DUPLICATES"]),
        ([(T[0], "A", 0.85, 4), (T[1], "A", 0.85, 4)], ["active", "active"], []),
        ([(T[0], "A", 0.85, 4), (T[1], "B", 0.85, 4), (T[2], "C", 0.95, 4)], ["conflicted", "conflicted", "active"], ["OBJ_CONFIDENCE_TOO_CLOSE", "OBJ_TRANSITION_CONFLICT"]),
    ],
)
def test_functional_walk(rows, statuses, kinds):
    got, conflicts, _ = walked(*rows)
    assert (got, conflicts) == (statuses, kinds)


def test_superseded_facts_are_closed():
    _, _, done = walked((T[0], "A", 0.85, 4), (T[1], "B", 0.90, 4))
    assert done.valid_to[0] == pd.Timestamp(T[1])


def test_status_never_falls(spark):
    pairs = [(a, b) for a in temporal.PRECEDENCE for b in temporal.PRECEDENCE]
    rows = spark.createDataFrame(pairs, "a string, b string").withColumn("c", temporal.raised(F.col("a"), F.col("b"))).collect()
    assert all(temporal.PRECEDENCE[r.c] == max(temporal.PRECEDENCE[r.a], temporal.PRECEDENCE[r.b]) for r in rows)


def test_negation_closes_one_target_only(spark):
    schema = "assertion_id long, subject_id long, predicate string, object_signature string, asserted_at timestamp, valid_from timestamp, valid_to timestamp, polarity string, role string, confidence double, status string"
    at = [dt.datetime(2024, 1, d) for d in range(1, 6)]
    rows = [(1, 1, "likes", "A", at[0], at[0], None, "positive", "user", 0.9, "active"), (2, 1, "likes", "A", at[1], at[1], None, "negative", "user", 0.9, "ineligible"), (3, 1, "likes", "A", at[2], at[2], None, "negative", "user", 0.9, "ineligible"), (4, 2, "likes", "A", at[0], at[0], None, "positive", "user", 0.9, "active"), (5, 2, "likes", "A", at[1], at[1], None, "positive", "user", 0.9, "active"), (6, 2, "likes", "A", at[2], at[2], None, "negative", "user", 0.9, "ineligible")]
    got = {r.assertion_id: r for r in temporal.apply_negations(spark.createDataFrame(rows, schema)).collect()}
    assert got[1].status == "negated" and got[1].valid_to == at[1] and got[1].negated_by == "2"
    assert got[4].status == got[5].status == "active" and got[6].ambiguous and not got[3].ambiguous


def test_lexicon_selects_terms_of_several_conversations(spark):
    said = messages(spark, "the Apollo Group met", "the Apollo Group met", "an Apollo Group talk", "one Apollo Group more", "Only Once here")
    picked = {r.term_key: r for r in lexicon.selected(lexicon.candidate_stats(lexicon.occurrences(said))).collect() if r.generator == "TITLE_CASE"}
    assert picked["apollo group"].reason is None and picked["only once"].reason == "BELOW_MIN_COUNT"
    terms = lexicon.selected(lexicon.candidate_stats(lexicon.occurrences(said))).where("reason is null")
    found = lexicon.matches(messages(spark, "APOLLO group, xApollo Group"), terms).collect()
    assert [(r.term_key, r.start, r.end) for r in found] == [("apollo group", 0, 12)]


def test_entities_by_key(spark):
    rows = spark.createDataFrame([("EMAIL", "A@b.io", 1, "user", ANCHOR), ("EMAIL", "a@b.io", 2, "assistant", ANCHOR), ("EMAIL", "a@b.io", 2, "user", None)], "kind string, surface string, conversation_id long, role string, created_at timestamp")
    (r,) = entities.consolidated(rows, F.lit(ANCHOR)).collect()
    assert (r.key, r.name, r.mentions, r.conversations, r.aliases) == ("a@b.io", "a@b.io", 3, 2, ["A@b.io", "a@b.io"])
    assert entities.with_self(entities.consolidated(rows, F.lit(ANCHOR))).where("key = '__SELF__'").count() == 1


def test_conflict_pairs_of_small_groups_only(spark):
    groups = spark.createDataFrame([("a", ["1", "2", "3"]), ("b", [str(i) for i in range(11)])], "conflict_id string, members array<string>")
    got = {r.edge_type: r["count"] for r in graph.conflict_edges(groups).groupBy("edge_type").count().collect()}
    assert got == {"HAS_CONFLICT_MEMBER": 14, "CONFLICTS_WITH": 3}


def test_windows_skip_empty_months(spark):
    rows = spark.createDataFrame([(1, 1, dt.datetime(2024, m, 5)) for m in (1, 1, 3)], "assertion_id long, subject_id long, valid_from timestamp").withColumn("asserted_at", F.col("valid_from"))
    got = profile.windows(rows).orderBy("window_start").collect()
    assert [(r.label, r.window_index, r.facts) for r in got] == [("January 2024", 0, 2), ("March 2024", 1, 1)] and got[1].previous == got[0].window_start


def test_entry_and_queries(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).limit(5).count() == 5


def test_tree_paths_of_branches_under_cycles_and_many_roots(spark):
    from factloom.operators import threads

    branches = [("c", "a", None), ("c", "b", "a"), ("c", "c", "a"), ("c", "d", "c"), ("c", "x", "y"), ("c", "y", "x"), ("c", "z", "y"), ("k", "only", "gone")]
    frame = spark.createDataFrame(branches, "conversation_id string, message_id string, parent_id string")
    got = {r.message_id: r.tree_path for r in threads.tree_paths(frame).collect()}
    assert got == {"a": "000001", "b": "000001.000001", "c": "000001.000002", "d": "000001.000002.000001", "x": "000002", "y": "000003", "z": "000004", "only": "000001"}


def test_fuzzy_lengths_keep_all_that_can_match():
    from factloom.functions.text import jaro_winkler_of
    from factloom.operators.assertions import least_share

    assert least_share(0.85) == pytest.approx(0.25)
    assert jaro_winkler_of("abcd", "abcdefghijklmno") >= 0.85 and 4 / 15 >= least_share(0.85)
    for n in range(5, 40):
        assert jaro_winkler_of("abcd", "abcd" + "x" * (n - 4)) < 0.85 or 4 / n >= least_share(0.85) - 1e-9


def test_retractions_take_the_latest_statement_before(spark):
    from factloom.operators import assertions

    said = spark.createDataFrame([("c", i, "user" if i % 2 else "assistant", f"a{i}", f"f{i}") for i in range(1, 8)], "conversation_id string, order_index int, role string, assertion_id string, fact_key string")
    messages = spark.createDataFrame([(10, "c", 6), (11, "c", 1), (12, "d", 3)], "message_id int, conversation_id string, order_index int")
    found = spark.createDataFrame([(10, 0, "full"), (10, 5, "full"), (11, 0, "full"), (12, 0, "full")], "message_id int, start int, kind string")
    got = {(r.message_id, r.start): r.target_id for r in assertions.retraction_targets(found, messages, said).collect()}
    assert got == {(10, 0): "a5", (10, 5): "a5", (11, 0): None, (12, 0): None}


def test_functional_windows_against_the_walk(spark):
    import numpy as np

    rng, rows = np.random.default_rng(9), []
    for subject in range(60):
        for i in range(int(rng.integers(1, 12))):
            rows.append((f"s{subject}", "p", f"a{subject}-{i:02d}", str(rng.choice(["A", "B", "C"])), dt.datetime(2024, 1, 1 + int(rng.integers(0, 9))), None if rng.random() < 0.5 else dt.datetime(2024, 1, 5), float(rng.choice([0.8, 0.805, 0.9, 0.95])), int(rng.integers(1, 3)), "active"))
    names = ["subject_id", "predicate", "assertion_id", "object_signature", "valid_from", "valid_to", "confidence", "tier", "status"]
    schema = "subject_id string, predicate string, assertion_id string, object_signature string, valid_from timestamp, valid_to timestamp, confidence double, tier int, status string"
    facts = spark.createDataFrame(rows, schema).withColumns({"functional": F.lit(True), "explicit": F.lit(True)})
    got = {r.assertion_id: (r.status, r.superseded_by, r.valid_to and r.valid_to.day) for r in temporal.apply_functional(facts).collect()}
    kinds = {(r.kind, tuple(r.members)) for r in temporal.functional_conflicts(facts).collect()}
    want, wanted = {}, set()
    for _, some in pd.DataFrame(rows, columns=names).groupby("subject_id"):
        some["valid_to"] = pd.to_datetime(some["valid_to"])
        done, conflicts = walk(some, TemporalConfig())
        want |= {r.assertion_id: (r.status, r.superseded_by, None if pd.isna(r.valid_to) else r.valid_to.day) for r in done.itertuples()}
        wanted |= {(k, tuple(sorted(m))) for k, _, m in conflicts}
    assert got == want and {s for s, *_ in want.values()} == {"active", "conflicted", "superseded"}
    assert kinds == wanted and len({k for k, _ in kinds}) == 5


def test_new_column_functions(spark):
    rows = spark.createDataFrame([(1, "ab", "xabx"), (2, "a", "aba"), (3, "aa", "aaa"), (4, "z", "ab"), (5, "", "ab"), (6, None, "ab"), (7, "é😀", "x😀é😀")], "id int, q string, t string")
    got = {r.id: r.s and (r.s.start, r.s.end) for r in rows.select("id", spans.quote_span(F.col("q"), F.col("t")).alias("s")).collect()}
    assert got == {1: (1, 3), 2: None, 3: None, 4: None, 5: None, 6: None, 7: (2, 4)}
    rows = spark.createDataFrame([(1, '[{"char_start":1,"char_end":4}]'), (2, "oops"), (3, None), (4, '[{"char_start":1}]'), (5, "[]")], "id int, j string")
    assert {r.id: [tuple(x) for x in r.s] for r in rows.select("id", spans.parsed(F.col("j")).alias("s")).collect()} == {1: [(1, 4)], 2: [], 3: [], 4: [], 5: []}
    assert [text.canonical_json_of(*x) for x in (("number", "12"), ("number", "x"), ("number", "nan"), ("json", '{"b":[1, 2.5],"a":"é"}'), ("json", "{"))] == ["12.0", '"x"', '"nan"', '{"a":"é","b":[1,2.5]}', '"{"']
    rows = spark.createDataFrame([("boolean", "TRUE"), ("boolean", "nay"), ("date", "2024-03-01"), ("date", "soon"), ("string", 'a"b'), ("number", "7")], "k string, v string")
    assert [r.l for r in rows.select(text.literal_json(F.col("k"), F.col("v")).alias("l")).collect()] == ["true", "false", '"2024-03-01T00:00:00.000Z"', '"soon"', '"a\\"b"', "7.0"]
    rows = spark.sql("SELECT * FROM VALUES (1, timestamp'2024-01-01', timestamp'2024-01-02'), (2, timestamp'2024-01-02', timestamp'2024-01-02'), (3, null, timestamp'2024-01-02'), (4, timestamp'2024-01-02', null), (5, null, null) t(id, a, b)")
    assert [r.c for r in rows.orderBy("id").select(times.compared(F.col("a"), F.col("b")).alias("c")).collect()] == [-1, 0, 1, -1, 0]


def test_recogniser_chunks_and_labels(spark):
    assert list(recognize.chunks_of("abcdefghij", 6, 2)) == [(0, "abcdef"), (4, "efghij")]
    assert list(recognize.chunks_of("abc", 6, 2)) == [(0, "abc")] and list(recognize.chunks_of("", 6, 2)) == [(0, "")]
    said = spark.createDataFrame([(1, "Ann met Bob in Rome, Rome!"), (2, None), (3, "x" * 40 + " Ann")], "message_id int, text string")
    names = {"Ann": "PERSON", "Bob": "DATE", "Rome": "GPE"}
    found = recognize.recognised(said, lambda: recognize.gazetteer(names), size=12, stride=6)
    got = sorted((r.message_id, r.kind, r.start, r.end, r.surface) for r in found.collect())
    assert got == [(1, "LOCATION", 15, 19, "Rome"), (1, "LOCATION", 21, 25, "Rome"), (1, "PERSON", 0, 3, "Ann"), (3, "PERSON", 41, 44, "Ann")]
    terms = spark.createDataFrame([("k", 1, "k", 0, 3), ("k", 1, "k", 8, 11)], "term_key string, message_id int, surface string, start int, end int")
    taken = spark.createDataFrame([(1, "NER:X", 0, 3), (1, "EMAIL", 10, 20)], "message_id int, detector string, start int, end int")
    assert [r.start for r in lexicon.without_overlaps(terms, taken).collect()] == [0]


def test_lexicon_leaves_code_alone(spark):
    said = spark.createDataFrame([(1, 1, "user", "NASA says\n```\nESA code\n```\nJAXA")], "message_id int, conversation_id int, role string, text string")
    found = lexicon.occurrences(markup.with_exclusions(said)).where("generator = 'ALLCAPS'")
    assert sorted(r.surface for r in found.collect()) == ["JAXA", "NASA"]


def test_spans_contexts_and_salience_of_entities(spark):
    mentions = spark.createDataFrame([(1, "e2", "EMAIL", 0, 5, 0.9), (1, "e1", "EMAIL", 3, 8, 0.9), (1, "e0", "FILEPATH", 0, 9, 1.0), (2, "e3", "URL", 0, 4, 0.9)], "message_id int, entity_id string, detector string, start int, end int, confidence double")
    spans = spark.createDataFrame([(1, 0, 3), (1, 4, 6), (1, 8, 9), (2, 4, 9), (3, 0, 1)], "message_id int, start int, end int")
    got = {(r.message_id, r.start): (r.entity_id, r.tier) for r in entities.at_spans(spans, mentions).collect()}
    assert got == {(1, 0): ("e2", 1), (1, 4): ("e1", 1), (1, 8): ("e0", 2), (2, 4): (None, None), (3, 0): (None, None)}
    said = spark.createDataFrame([(i, 1, i) for i in range(1, 5)] + [(9, 2, 3)], "message_id int, conversation_id int, order_index int")
    near = entities.context_mentions(said, mentions.select("message_id", "entity_id"), 2)
    assert sorted((r.message_id, r.entity_id) for r in near.collect()) == [(2, "e0"), (2, "e1"), (2, "e2"), (3, "e0"), (3, "e1"), (3, "e2"), (3, "e3"), (4, "e3")]
    known = spark.createDataFrame([("a", 4.0), ("b", None)], "entity_id string, salience double")
    facts = spark.createDataFrame([("a",), ("b",), ("c",)], "subject_id string")
    assert {r.subject_id: r.salience_factor for r in entities.with_salience(facts, known).collect()} == {"a": 1.1, "b": 1.0, "c": 1.0}
    assert entities.greatest_salience(known.where("false")).collect()[0].most == 1.0


def test_corrections_and_full_retractions(spark):
    facts = spark.createDataFrame([(1, "active"), (2, "active"), (3, "retracted"), (4, "ineligible"), (5, "active")], "assertion_id int, status string")
    named = spark.createDataFrame([(1, 5), (1, 2), (2, 99), (3, 5), (4, 5)], "assertion_id int, replacement int")
    got = {r.assertion_id: (r.status, r.corrected_by) for r in temporal.apply_corrections(facts, named).collect()}
    assert got == {1: ("superseded", 2), 2: ("active", None), 3: ("retracted", None), 4: ("superseded", 5), 5: ("active", None)}
    targets = spark.createDataFrame([("full", 1), ("full", 1), ("correction", 2), ("full", None)], "kind string, target_id int")
    got = {r.assertion_id: r.supersession for r in assertions.supersede_retracted(facts, targets).collect()}
    assert got == {1: "retraction", 2: None, 3: None, 4: None, 5: None}


def test_evidence_cap_and_graph_reads(spark):
    facts = spark.sql("SELECT id AS assertion_id, 1 AS subject_id, 'V' AS object_signature, timestamp'2024-03-05' AS valid_from, timestamp'2024-03-06' AS asserted_at FROM range(5)")
    got = sorted((r.assertion_id, r.evidence_rank, r.total, r.capped) for r in profile.evidence(facts, ProfileConfig(evidence_cap=3)).collect())
    assert got == [(0, 0, 5, True), (1, 1, 5, True), (2, 2, 5, True)]
    assert graph.evidence_edges(profile.evidence(facts)).count() == 5
    nodes = spark.createDataFrame([("n1", "Value", '{"a":1}'), ("n2", "Value", None)], "node_id string, node_type string, metadata_json string")
    edges = spark.createDataFrame([("n1", "p9", "HAS_PROFILE", "{}"), ("n2", "p3", "HAS_PROFILE", None)], "src_id string, dst_id string, edge_type string, metadata_json string")
    assert [r.node_id for r in views.profile_id(nodes, edges).collect()] == ["p3"]
    assert [r.metadata for r in views.node(nodes, "n1").collect()] == [{"a": "1"}] and [r.metadata for r in views.node(nodes, "n2").collect()] == [{}]
    assert [r.dst_id for r in views.edges_from(edges, "n2", "HAS_PROFILE").collect()] == ["p3"]
    ends = spark.createDataFrame([(1, 2, 3, 4)], "assertion_id int, superseded_by int, negated_by int, retracted_by int")
    kinds = sorted(r.edge_type for r in graph.lifecycle_edges(ends, inverse=True).collect())
    assert kinds == ["NEGATED_BY", "NEGATES", "RETRACTED_BY", "RETRACTS", "SUPERSEDES"]
    assert sorted(r.edge_type for r in graph.lifecycle_edges(ends).collect()) == ["NEGATED_BY", "RETRACTED_BY", "SUPERSEDES"]


def built_from_messages(rows):
    """Lines of the first plan that broadcast anything but terms."""
    plan = rows._jdf.queryExecution().sparkPlan().toString()
    return [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "BuildLeft" in line or "LeftOuter, BuildRight" in line]


def test_words_of_texts_are_never_broadcast(spark):
    said = spark.range(100).selectExpr("id AS message_id", "'tea for Acme group no ' || id AS text")
    terms = spark.createDataFrame([("acme", "Acme", ["Acme Group"]), ("tea", "tea", [])], "term_key string, canonical string, aliases array<string>")
    found = lexicon.matches(said, terms)
    assert built_from_messages(found) == [] and found.count() == 200


def test_mentions_are_never_broadcast(spark):
    found = spark.range(10).selectExpr("id AS message_id", "'k' AS term_key", "0 AS start", "3 AS end", "'tea' AS surface")
    taken = spark.range(5).selectExpr("id AS message_id", "'URL' AS detector", "2 AS start", "9 AS end")
    left = lexicon.without_overlaps(found, taken)
    assert built_from_messages(left) == [] and left.count() == 5


def test_many_terms_meet_words_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(lexicon, "FEW_FORMS", 1)
    terms = spark.createDataFrame([("acme", "Acme", ["Acme Group"]), ("tea", "tea", [])], "term_key string, canonical string, aliases array<string>")
    found = lexicon.matches(messages(spark, "tea at ACME Group", "steam", None), terms)
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().sparkPlan().toString()
    assert sorted((r.message_id, r.term_key, r.start, r.end) for r in found.collect()) == [(0, "acme", 7, 17), (0, "tea", 0, 3)]


def test_long_terms_meet_words_without_broadcast(spark):
    terms = spark.createDataFrame([("acme", "Acme", ["Acme Group"]), ("tea", "tea", ["word " + "x" * (1 << 23), "other " + "y" * (1 << 23)])], "term_key string, canonical string, aliases array<string>")
    found = lexicon.matches(messages(spark, "tea at ACME Group", "steam", "no other word", None), terms)
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().sparkPlan().toString()
    assert sorted((r.message_id, r.term_key, r.start, r.end) for r in found.collect()) == [(0, "acme", 7, 17), (0, "tea", 0, 3)]


def test_salience_adds_up_in_the_order_of_assertions(spark):
    assert len({(0.61 + 0.72) + 0.6, (0.61 + 0.6) + 0.72, (0.72 + 0.6) + 0.61}) > 1
    at = dt.datetime(2024, 3, 5)
    schema = "assertion_id long, subject_id long, object_signature string, valid_from timestamp, asserted_at timestamp, confidence double"
    for order in ((0.61, 0.72, 0.6), (0.72, 0.6, 0.61), (0.6, 0.61, 0.72)):
        facts = spark.createDataFrame([(i, 1, "V", at, at, c) for i, c in enumerate(order)][::-1], schema).repartition(3, "assertion_id")
        (r,) = profile.members(facts, profile.windows(facts)).collect()
        assert r.mentions == 3 and r.salience == 1.2 / 3 + 0.2 * (1 / (1 + 0.1 * 27)) + 0.4 * (((order[0] + order[1]) + order[2]) / 3)
    unsure = spark.createDataFrame([(1, 1, "V", at, at, None), (2, 1, "V", at, at, 0.5), (3, 2, "V", at, at, None)], schema)
    got = {r.subject_id: r.salience for r in profile.members(unsure, profile.windows(unsure)).collect()}
    assert got[1] == 0.4 + 0.2 * (1 / (1 + 0.1 * 27)) + 0.2 and got[2] is None


def test_intervals_within_a_millisecond_are_told_apart(spark):
    rows = spark.sql("SELECT id AS assertion_id, 1 AS subject_id, 'p' AS predicate, 'V' AS object_signature, 0.5D AS confidence, 'active' AS status, timestamp_micros(1700000000123000 + id * 400) AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to FROM range(3)")
    assert graph.fact_nodes(rows).where("node_type = 'TimeInterval'").count() == 3


def test_ends_of_facts_meet_intervals_within_a_millisecond(spark):
    rows = spark.sql("SELECT id AS assertion_id, 1 AS subject_id, 'p' AS predicate, 'V' AS object_signature, 0.5D AS confidence, 'active' AS status, timestamp_micros(1700000000123000 + id * 400) AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to FROM range(3)")
    kept = graph.without_dangling(graph.fact_edges(rows), graph.fact_nodes(rows)).where("edge_type = 'VALID_IN'")
    assert kept.select("dst_id").distinct().count() == kept.count() == 3
    # moments of whole milliseconds keep the ids they have in milliseconds
    whole = rows.where("assertion_id = 0").select(graph.interval_key(F.col("valid_from"), F.col("valid_to"))).first()[0]
    assert whole == "2023-11-14T22:13:20.123Z|-"


def test_nodes_equal_their_sql_within_a_millisecond(spark, tmp_path):
    import __spark_entry__ as e

    duckdb = pytest.importorskip("duckdb")
    at = "timestamp_ntz'2024-01-15 13:13:28.641150' + make_dt_interval(0, 0, 0, id * 0.000373)"
    spark.sql(f"SELECT id AS event_id, {at} AS ts, id % 3 AS user_id, 'view' AS event_type, CAST(id AS DOUBLE) AS value FROM range(1, 40)").write.parquet(f"{tmp_path}/events.parquet")
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
        want = db.execute(f"SELECT node_type, n, labels FROM ({e.oracle_sql()['gr_nodes']})").fetchall()
    got = e.queries()["gr_nodes"](spark, str(tmp_path)).select("node_type", "n", "labels").collect()
    assert sorted(map(tuple, got)) == sorted(want) and ("TimeInterval", 36, 2) in want


def test_entities_of_a_span_are_all_read(spark):
    found = spark.range(10_050).selectExpr("CAST(id AS STRING) AS entity_id", "timestamp_seconds(id) AS first_seen")
    assert views.entities_between(found).count() == 10_050
    assert [r.entity_id for r in views.entities_between(found, F.timestamp_seconds(F.lit(5)), F.timestamp_seconds(F.lit(20)), most=2).orderBy("first_seen").collect()] == ["5", "6"]
