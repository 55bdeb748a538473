"""Queries over the driver's tables for single functions, graph parts and reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import scores, spans, times
from factloom.functions.text import entity_key, json_path, literal_json
from factloom.operators import analytics, assertions, entities, graph, lexicon, profile, recognize, temporal, threads, timex, views
from factloom.plans.queries import AS_OF, _facts, _graph_facts, _grounded, _mentions, _ranked, _table, _walked
from factloom.sources import tables

NAMES = {
    **dict.fromkeys(("Alice", "Bruno", "Carla", "Dario", "Elena", "Fabio"), "PERSON"),
    **dict.fromkeys(("Paris", "Berlin", "Madrid", "Lisbon"), "GPE"),
    **dict.fromkeys(("Acme", "Globex", "Initech", "Umbrella", "Hooli"), "ORG"),
    **dict.fromkeys(("Nothing", "See"), "MISC"),
}
TERMS = [("acme", "Acme", ["Acme Group"]), ("hooli", "Hooli", []), ("tea", "tea", []), ("3 weeks", "3 weeks", [])]


def _at(key: str, *cases: str):
    """The case of a key by its remainder; null where a case is None."""
    return F.element_at(F.array(*[F.lit(c) for c in cases]), (F.col(key) % len(cases) + 1).cast("int"))


# --- column functions -----------------------------------------------------------------------------------------------


def fn06_ranges(spark, sf_dir):
    """Ranges read from JSON, broken ones among them."""
    json = F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit('[{"char_start":'), "c_nationkey", F.lit(',"char_end":'), F.col("c_nationkey") + 5, F.lit("}]"))).otherwise(_at("c_custkey", "oops", "[]", None, '[{"char_start": 1}]'))
    found = _table(spark, sf_dir, "customer").select("c_custkey", spans.parsed(json).alias("r"))
    return found.select("c_custkey", F.size("r").alias("ranges"), F.get("r", F.lit(0))["start"].alias("start"), F.get("r", F.lit(0))["end"].alias("end"))


def fn07_json_path(spark, sf_dir):
    """A field of a JSON text."""
    json = F.to_json(F.struct(F.struct(F.col("c_mktsegment").alias("key")).alias("of"), F.col("c_nationkey")))
    return _table(spark, sf_dir, "customer").select("c_custkey", json_path(json, "$.of.key").alias("segment"), json_path(json, "$.c_nationkey").cast("long").alias("nation"), json_path(json, "$.none").alias("none"))


def fn19_quotes(spark, sf_dir):
    """Where documents hold a part of themselves, if but once."""
    quote = F.substring("text", 5, 3).substr(F.lit(1), (F.col("doc_id") % 4).cast("int"))
    found = _table(spark, sf_dir, "documents").where("text is not null").select("doc_id", spans.quote_span(F.when(F.col("doc_id") % 3 == 0, F.substring("text", 3, 25)).otherwise(quote), F.col("text")).alias("s"))
    return found.select("doc_id", F.col("s.start").alias("start"), F.col("s.end").alias("end"))


def fn27_literals(spark, sf_dir):
    """Literals of parts as canonical JSON."""
    p = _table(spark, sf_dir, "part")
    kind = _at("p_partkey", "string", "number", "boolean", "date", "json")
    size = F.col("p_size").cast("string")
    value = F.element_at(F.array(F.col("p_name"), size, F.when(F.col("p_size") % 2 == 0, "Yes").otherwise("no"), F.concat(F.lit("2024-03-"), F.lpad((F.col("p_size") % 28 + 1).cast("string"), 2, "0")), F.concat(F.lit('{"b": 1, "a": ['), size, F.lit("]}"))), (F.col("p_partkey") % 5 + 1).cast("int"))
    return p.select("p_partkey", literal_json(kind, value).alias("literal"))


def fn33_salience_factor(spark, sf_dir):
    """Balances of customers as a factor of the greatest."""
    c = _table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 6 != 0, F.col("c_acctbal").cast("double")).alias("own"))
    known = c.select(F.col("c_custkey").alias("entity_id"), F.col("own").alias("salience"))
    return entities.with_salience(c.select(F.col("c_custkey").alias("subject_id")), known).select("subject_id", F.round("salience_factor", 9).alias("factor"))


def fn41_moments(spark, sf_dir):
    """Orders' dates against their first shipment's."""
    o, i = _table(spark, sf_dir, "orders"), _table(spark, sf_dir, "lineitem")
    shipped = i.groupBy("l_orderkey").agg(F.min(F.when(F.col("l_linenumber") % 2 == 0, F.col("l_shipdate"))).cast("timestamp").alias("shipped"))
    both = o.join(shipped, o["o_orderkey"] == shipped["l_orderkey"], "left").select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate").cast("timestamp")).alias("ordered"), "shipped")
    return both.select("o_orderkey", times.compared(F.col("ordered"), F.col("shipped")).alias("sign"), times.earlier(F.col("ordered"), F.col("shipped")).alias("first"))


def fn47_local_hours(spark, sf_dir):
    """Events by the hour of Berlin's clocks."""
    return _table(spark, sf_dir, "events").groupBy(F.hour(times.localised(F.col("ts"))).alias("hour")).agg(F.count(F.lit(1)).alias("n"))


# --- counts ---------------------------------------------------------------------------------------------------------


def ag01_stage_counts(spark, sf_dir):
    """Conversations, messages and characters."""
    return analytics.stage_counts(tables.chat(spark, sf_dir))


def ag09_greatest_salience(spark, sf_dir):
    """The greatest salience of statements' entities."""
    found = entities.greatest_salience(entities.consolidated(_mentions(spark, sf_dir), F.to_timestamp(F.lit(AS_OF))))
    return found.select(F.round("most", 6).alias("most"))


def ag11_tier_histogram(spark, sf_dir):
    """Facts by detector tier of subject and object."""
    rows = tables.facts(spark, sf_dir).withColumns({"grounding": F.col("confidence"), "subject_tier": F.when(F.col("subject_id") % 2 == 0, 1)})
    return analytics.tier_histogram(rows, {"subject": "subject_tier", "object": "tier"}).select("side", "tier", "n", F.round("mean_grounding", 9).alias("mean_grounding"))


# --- mentions -------------------------------------------------------------------------------------------------------


def _named_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mentions(spark, sf_dir).withColumn("entity_id", F.concat_ws(":", "kind", entity_key(F.col("kind"), F.col("surface"))))


def ag08_best_tiers(spark, sf_dir):
    """The best detector tier of statements' entities."""
    return entities.best_tiers(_named_mentions(spark, sf_dir))


def jn03_context_mentions(spark, sf_dir):
    """Entities mentioned in the five statements before each."""
    return entities.context_mentions(tables.utterances(spark, sf_dir), _named_mentions(spark, sf_dir))


def jn09_entities_at_spans(spark, sf_dir):
    """The entity that the first and the second half of statements meet."""
    said = tables.utterances(spark, sf_dir)
    half = (F.length("text") / 2).cast("int")
    both = F.explode(F.array(F.struct(F.lit(0).alias("start"), half.alias("end")), F.struct(half.alias("start"), F.length("text").alias("end")))).alias("s")
    return entities.at_spans(said.select("message_id", both).select("message_id", "s.*"), _named_mentions(spark, sf_dir)).select("message_id", "start", "entity_id", "tier")


def dt15_recognised(spark, sf_dir):
    """Names found by a recogniser, in chunks of 24 characters that share 16."""
    return recognize.recognised(tables.utterances(spark, sf_dir), lambda: recognize.gazetteer(NAMES), "NER:NAMES", 24, 16).select("message_id", "kind", "start", "end", "surface")


def dt22_lexicon_overlaps(spark, sf_dir):
    """Terms found in statements beside what detectors and recognisers found there."""
    said = tables.utterances(spark, sf_dir)
    terms = spark.createDataFrame(TERMS, "term_key string, canonical string, aliases array<string>")
    named = recognize.recognised(said, lambda: recognize.gazetteer(NAMES))
    known = _mentions(spark, sf_dir).select("message_id", "detector", "start", "end").unionByName(named.select("message_id", "detector", "start", "end"))
    return lexicon.without_overlaps(lexicon.matches(said, terms), known).select("message_id", "term_key", "start", "surface")


def dt16_given_terms(spark, sf_dir):
    """Given terms found in statements."""
    terms = spark.createDataFrame(TERMS, "term_key string, canonical string, aliases array<string>")
    return lexicon.matches(tables.utterances(spark, sf_dir), terms).groupBy("term_key", "surface").agg(F.count(F.lit(1)).alias("n"))


# --- statements and their lifecycle ---------------------------------------------------------------------------------


def _qualified(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = threads.eligible(tables.utterances(spark, sf_dir))
    day = F.regexp_extract("text", r"(\d{4}-\d{2}-\d{2}|today|someday)", 1)
    made = assertions.extracted(said).join(said.select("message_id", F.nullif(day, F.lit("")).alias("qualifier")), "message_id")
    return assertions.qualified(made, timex.time_mentions(said)).withColumn("assertion_id", F.concat_ws("-", F.col("message_id").cast("string"), "predicate"))


def jn08_qualifiers(spark, sf_dir):
    """The time mentions that qualify statements."""
    return _qualified(spark, sf_dir).select("assertion_id", "qualifier", "qualifier_start")


def ap27_superseded(spark, sf_dir):
    """Statements that a full retraction takes back."""
    made = _grounded(spark, sf_dir)
    said = tables.utterances(spark, sf_dir)
    targets = assertions.retraction_targets(assertions.retractions(said), said, made)
    return assertions.supersede_retracted(made, targets).where("supersession is not null").select("message_id", "predicate", "supersession")


def tr03_corrections(spark, sf_dir):
    """Facts that a correction supersedes, a third of the replacements unknown."""
    rows = _facts(spark, sf_dir)
    named = rows.where("assertion_id % 23 = 0").select("assertion_id", F.when(F.col("assertion_id") % 3 == 0, -F.col("assertion_id") - 1).otherwise(F.col("assertion_id") - 1).alias("replacement"))
    return temporal.apply_corrections(rows, named).select("assertion_id", "status", "corrected_by")


# --- graph ----------------------------------------------------------------------------------------------------------


def gr07_retraction_nodes(spark, sf_dir):
    """Nodes of retractions."""
    made = _grounded(spark, sf_dir)
    said = tables.utterances(spark, sf_dir)
    return graph.retraction_nodes(assertions.retraction_targets(assertions.retractions(said), said, made)).select("node_id", "node_type", "label", F.get_json_object("metadata_json", "$.retraction_type").alias("kind"))


def gr08_conflict_nodes(spark, sf_dir):
    """Nodes of conflict groups by label."""
    found = graph.conflict_nodes(temporal.functional_conflicts(_walked(spark, sf_dir)))
    return found.groupBy("node_type", "label").agg(F.count(F.lit(1)).alias("n"))


def gr09_lexicon_nodes(spark, sf_dir):
    """Nodes of given terms."""
    terms = spark.createDataFrame(TERMS, "term_key string, canonical string, aliases array<string>").withColumn("score", F.lit(1.0))
    return graph.lexicon_nodes(terms).select("node_id", "node_type", "source_id", "label")


def gr10_time_nodes(spark, sf_dir):
    """Nodes of time mentions."""
    return graph.time_nodes(timex.time_mentions(tables.utterances(spark, sf_dir))).select("node_id", "node_type", "source_id", "label")


def gr21_hints(spark, sf_dir):
    """Intervals that hold an end alone, and the edges that lead to them."""
    rows = _graph_facts(spark, sf_dir).withColumn("valid_until_hint", F.when(F.col("assertion_id") % 2 == 1, F.date_trunc("day", "asserted_at")))
    some, found = graph.hint_graph(rows)
    kept = graph.without_dangling(found, some.select("node_id").unionByName(graph.fact_nodes(rows).select("node_id")))
    return some.select("label", "node_id").join(kept.select(F.col("dst_id").alias("node_id")), "node_id").groupBy("label").agg(F.count(F.lit(1)).alias("edges"))


def gr22_qualifier_edges(spark, sf_dir):
    """Edges from statements to the time mentions that qualify them, none dangling."""
    found = _qualified(spark, sf_dir)
    said = threads.eligible(tables.utterances(spark, sf_dir))
    own = graph.nodes(found, "Assertion", F.col("assertion_id"), F.col("surface"))
    kept = graph.without_dangling(graph.qualifier_edges(found), own.unionByName(graph.time_nodes(timex.time_mentions(said))))
    return kept.select("edge_type", "src_id", "dst_id")


def gr24_lifecycle_edges(spark, sf_dir):
    """Edges of facts' ends, both ways, by type and target."""
    rows = _facts(spark, sf_dir).select("assertion_id", "subject_id", "status").withColumns({
        "superseded_by": F.when(F.col("assertion_id") % 7 == 0, F.col("assertion_id") - 1),
        "negated_by": F.when(F.col("assertion_id") % 9 == 0, F.col("assertion_id") - 2),
        "retracted_by": F.when(F.col("assertion_id") % 11 == 0, F.col("assertion_id") - 3),
    })
    return graph.lifecycle_edges(rows, inverse=True).groupBy("edge_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("src_id").alias("sources"), F.count_distinct("dst_id").alias("targets"))


def wf12_evidence(spark, sf_dir):
    """The assertions that speak of members in windows."""
    return profile.evidence(tables.facts(spark, sf_dir)).select("subject_id", "window_start", "member", "assertion_id", "evidence_rank", "total", "capped")


def _profile_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    # both are read many times further on; kept, and made again where an executor is lost
    rows, found = (x.persist() for x in _ranked(spark, sf_dir))
    some_nodes, some_edges = graph.profile_graph(found, rows, profile.clusters(rows, found).persist())
    return some_nodes.persist(), some_edges.persist()


def qry04_profile(spark, sf_dir):
    """The profile that reads begin with."""
    some_nodes, some_edges = _profile_graph(spark, sf_dir)
    return views.profile_id(some_nodes, some_edges)


def qry05_edges_from(spark, sf_dir):
    """Where the windows of subject 1 lead from its profile."""
    some_nodes, some_edges = _profile_graph(spark, sf_dir)
    found = views.edges_from(some_edges, graph.node_id("TemporalProfile", F.lit("1")), "HAS_WINDOW")
    return found.select("src_id", "dst_id", F.col("metadata")["window_index"].cast("int").alias("window_index"))


def vz01_profile_walk(spark, sf_dir):
    """Windows, clusters and members along the first profile."""
    some_nodes, some_edges = _profile_graph(spark, sf_dir)
    walk = views.profile_walk(some_nodes, some_edges)
    return walk.select("window_index", "window", "category", "member", "rank", F.round("salience", 6).alias("salience"))


def vz02_entities_between(spark, sf_dir):
    """Statements' entities first seen in 1995."""
    found = entities.consolidated(_mentions(spark, sf_dir), F.to_timestamp(F.lit(AS_OF)))
    return views.entities_between(found, F.to_timestamp(F.lit("1995-01-01")), F.to_timestamp(F.lit("1996-01-01"))).select("kind", "key", "mentions")


def vz03_links(spark, sf_dir):
    """Active facts between subjects of less than a hundred."""
    rows = _facts(spark, sf_dir).withColumn("object_id", F.when(F.col("assertion_id") % 4 != 0, F.col("assertion_id") % 150))
    known = rows.select(F.col("subject_id").alias("entity_id")).where("entity_id < 100").distinct()
    return views.links_between(views.active_links(rows, 0.8), known)


def fn33_factor_formula(spark, sf_dir):
    """The factor of salience over parts' sizes."""
    return _table(spark, sf_dir, "part").select("p_partkey", F.round(scores.salience_factor(F.col("p_size").cast("double"), F.lit(0.5)), 9).alias("factor"))
