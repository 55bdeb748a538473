"""Queries over the driver's tables, one for each group of operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import ids, scores, times
from factloom.functions.text import entity_key, inferred_type, jaro_winkler, project_of, trimmed_url
from factloom.operators import analytics, assertions, detect, entities, graph, lexicon, markup, profile, temporal, threads, timex
from factloom.sources import tables

AS_OF = "2024-01-01 00:00:00"
RULES = [(1, "click", "*", True, "close"), (2, None, "*", False, "none"), (3, "purchase", "even", True, "close"), (4, None, "odd", True, "close")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts with eligibility: explicit if dated, not corroborated."""
    rows = tables.facts(spark, sf_dir).withColumns({"explicit": F.col("valid_from").isNotNull(), "corroborated": F.lit(False)})
    return temporal.eligibility(rows)


def _rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, "rule_id int, predicate string, subject_type string, functional boolean, policy string")


# --- messages and their order -------------------------------------------------------------------------------------


def prj02_role_normalize(spark, sf_dir):
    """Roles as the export reader names them."""
    from factloom.sources.export import normal_role

    return tables.chat(spark, sf_dir).select("message_id", normal_role(F.upper("role")).alias("role"))


def flt02_eligible_messages(spark, sf_dir):
    """User and assistant messages of ten characters or more."""
    return threads.eligible(tables.chat(spark, sf_dir)).select("message_id", "conversation_id", "role")


def wf01_order_index(spark, sf_dir):
    """Order within each conversation by tree path."""
    return threads.ordered(threads.tree_paths(tables.chat(spark, sf_dir).drop("order_index"))).select("message_id", "order_index")


def tree01_tree_path(spark, sf_dir):
    """Tree paths of conversations."""
    return threads.tree_paths(tables.chat(spark, sf_dir)).select("message_id", "tree_path")


def jn05_context_window(spark, sf_dir):
    """The five messages before each."""
    return threads.with_context(tables.chat(spark, sf_dir)).select("message_id", F.array_join(F.transform("context", lambda x: x.cast("string")), ",").alias("context"))


def fn01_uuid5(spark, sf_dir):
    """Deterministic ids of customers."""
    return _table(spark, sf_dir, "customer").select("c_custkey", ids.entity_id("entity", F.col("c_name")).alias("id"))


def fn04_surface_hash(spark, sf_dir):
    """Hashes of names, one in five missing."""
    return _table(spark, sf_dir, "customer").select("c_custkey", ids.surface_hash(F.when(F.col("c_custkey") % 5 != 0, F.col("c_name"))).alias("hash"))


def fn10_entity_key(spark, sf_dir):
    """Entity keys of part names by kind."""
    kind = F.element_at(F.array(*[F.lit(k) for k in ("EMAIL", "PERSON", "PHONE", "FILEPATH")]), (F.col("p_partkey") % 4 + 1).cast("int"))
    return _table(spark, sf_dir, "part").select("p_partkey", entity_key(kind, F.concat(F.lit(" "), "p_name", F.lit(" (1)-2 "))).alias("key"))


def fn12_jaro_winkler(spark, sf_dir):
    """Pairs of a nation's and a region's names that are alike at 0.6 or more (boosted)."""
    n, r = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    pairs = n.join(r, n["n_regionkey"] == r["r_regionkey"]).select("n_nationkey", jaro_winkler("n_name", "r_name").alias("score"))
    return pairs.select("n_nationkey", F.round("score", 6).alias("score"))


def fn15_inferred_type(spark, sf_dir):
    """Kinds of terms by their surface."""
    ending = F.element_at(F.array(F.lit(" Inc."), F.lit(" LLC"), F.lit("")), (F.col("s_suppkey") % 3 + 1).cast("int"))
    start = F.when(F.col("s_suppkey") % 7 == 0, F.lit("@")).otherwise(F.lit(""))
    return _table(spark, sf_dir, "supplier").select("s_suppkey", inferred_type(F.concat(start, "s_name", ending)).alias("kind"))


def fn18_trimmed_url(spark, sf_dir):
    """Page addresses in running text, without the sentence's end."""
    return _table(spark, sf_dir, "pages").select("page_id", trimmed_url(F.concat("url", F.lit(").,"))).alias("url"))


def fn43_window_labels(spark, sf_dir):
    """Months, quarters and years of orders."""
    o = _table(spark, sf_dir, "orders")
    at = F.col("o_orderdate")
    return o.select(F.date_trunc("month", at).alias("month"), times.window_end("quarter", F.date_trunc("quarter", at)).alias("quarter_end"), times.window_label("quarter", at).alias("quarter"), times.window_label("year", at).alias("year")).distinct()


def fn44_last_ms(spark, sf_dir):
    """Inclusive ends of the month of each order."""
    return _table(spark, sf_dir, "orders").select("o_orderkey", times.iso_ms(times.last_ms("month", F.col("o_orderdate"))).alias("ends_at"))


# --- overviews -----------------------------------------------------------------------------------------------------


def ag21_overview(spark, sf_dir):
    """Messages and conversations, mean and median."""
    return analytics.overview(tables.chat(spark, sf_dir))


def ag22_resample_week(spark, sf_dir):
    """Events a week, zeros included."""
    return analytics.resampled(_table(spark, sf_dir, "events"), "ts", "week")


def ag23_day_hour(spark, sf_dir):
    """Events by weekday and hour."""
    return analytics.day_by_hour(_table(spark, sf_dir, "events"), "ts")


def ag24_top_words(spark, sf_dir):
    """The most frequent words of conversations."""
    return analytics.top_words(tables.chat(spark, sf_dir), 50)


def ag25_project_table(spark, sf_dir):
    """Customers by the prefix of their name as a title."""
    c = _table(spark, sf_dir, "customer")
    rows = c.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("size"), F.concat("c_mktsegment", F.lit(": "), "c_name").alias("title"), F.col("c_custkey").alias("at"))
    return analytics.grouped_titles(rows, project_of(F.col("title")), "at", 3).select("project", "id", "rank", "items", "first_at", "last_at")


def ag27_by_role(spark, sf_dir):
    """Messages by role."""
    return analytics.by_role(tables.chat(spark, sf_dir))


def ag28_message_histogram(spark, sf_dir):
    """Conversations by their number of messages."""
    return analytics.message_histogram(tables.chat(spark, sf_dir))


def fn24_word_counts(spark, sf_dir):
    """Characters and words of messages."""
    return analytics.word_counts(tables.chat(spark, sf_dir))


def qry06_shares(spark, sf_dir):
    """Shares of event types."""
    return analytics.shares(_table(spark, sf_dir, "events"), "event_type")


# --- detection -----------------------------------------------------------------------------------------------------


def dt_candidates(spark, sf_dir):
    """Candidates by detector over documents."""
    found = detect.candidates(tables.document_messages(spark, sf_dir)).where(F.col("detector").isin("EMAIL", "HASH_HEX", "IP_ADDRESS"))
    return found.groupBy("detector").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("surface").alias("surfaces"))


def dt20_overlap_winners(spark, sf_dir):
    """Winners among overlapping candidates of statements."""
    found = detect.resolved(detect.candidates(tables.utterances(spark, sf_dir)))
    return found.select("message_id", "detector", "start", "end", "surface", "kept")


def ag02_suppression_stats(spark, sf_dir):
    """Candidates of documents by reason for suppression."""
    found = detect.candidates(tables.document_messages(spark, sf_dir))
    return found.groupBy(F.coalesce("reason", F.lit("none")).alias("reason"), "detector").agg(F.count(F.lit(1)).alias("n"))


def tm_time_mentions(spark, sf_dir):
    """Time mentions of statements, resolved."""
    found = timex.time_mentions(tables.utterances(spark, sf_dir))
    return found.select("message_id", "pattern", "start", "surface", "resolved_type", times.iso_ms(F.col("valid_from")).alias("valid_from"), times.iso_ms(F.col("valid_to")).alias("valid_to"))


def lx_occurrences(spark, sf_dir):
    """Capitalised terms of documents by generator."""
    found = lexicon.occurrences(tables.document_messages(spark, sf_dir)).where(F.col("generator").isin("ALLCAPS", "HANDLE"))
    return found.groupBy("generator", "term_key").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("conversation_id").alias("conversations"))


def lx10_selection(spark, sf_dir):
    """Lexicon candidates of statements with score and fate."""
    picked = lexicon.selected(lexicon.candidate_stats(lexicon.occurrences(tables.utterances(spark, sf_dir))))
    return picked.select("generator", "term_key", "total", "canonical", F.round("score", 6).alias("score"), F.coalesce("reason", F.lit("SELECTED")).alias("fate"))


def dt16_lexicon_matches(spark, sf_dir):
    """Selected terms found in statements again."""
    said = tables.utterances(spark, sf_dir)
    terms = lexicon.selected(lexicon.candidate_stats(lexicon.occurrences(said))).where("reason is null")
    return lexicon.matches(said, terms).groupBy("term_key").agg(F.count(F.lit(1)).alias("n"))


# --- entities ------------------------------------------------------------------------------------------------------


def _mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = tables.utterances(spark, sf_dir)
    kept = detect.resolved(detect.candidates(said)).where("kept")
    return kept.join(said.select("message_id", "conversation_id", "role", "created_at"), "message_id")


def ag04_entities(spark, sf_dir):
    """Entities of statements with salience."""
    found = entities.consolidated(_mentions(spark, sf_dir), F.to_timestamp(F.lit(AS_OF)))
    return found.select("kind", "key", "name", "mentions", "conversations", "user_mentions", F.round("salience", 6).alias("salience"))


def ag06_canonical_names(spark, sf_dir):
    """Names chosen for entities by trust, detector and confidence."""
    rows = _mentions(spark, sf_dir).withColumn("entity_id", F.concat_ws(":", "kind", entity_key(F.col("kind"), F.col("surface"))))
    names = entities.canonical_names(entities.surface_scores(rows))
    return names.select("entity_id", "name", F.round("confidence", 6).alias("confidence"))


# --- assertions ----------------------------------------------------------------------------------------------------


def ap_extracted(spark, sf_dir):
    """Assertions read from statements."""
    found = assertions.extracted(threads.eligible(tables.utterances(spark, sf_dir)))
    return found.select("message_id", "predicate", "object", "modality", "confidence", "start")


def rp_retractions(spark, sf_dir):
    """Retractions read from users' statements."""
    return assertions.retractions(tables.utterances(spark, sf_dir)).select("message_id", "kind", "confidence", "surface")


def _grounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = threads.eligible(tables.utterances(spark, sf_dir))
    # each is read many times further on; kept, and made again where an executor is lost
    known = entities.consolidated(_mentions(spark, sf_dir).persist(), F.to_timestamp(F.lit(AS_OF))).persist()
    return assertions.grounded(said, assertions.extracted(said).persist(), known, "conversation_id").persist()


def fn31_grounded(spark, sf_dir):
    """Confidences of grounded assertions."""
    return _grounded(spark, sf_dir).select("message_id", "predicate", "object", F.round("object_conf", 6).alias("object_conf"), F.round("grounding", 6).alias("grounding"), "corroborated", F.round("final", 6).alias("final"))


def jn06_corroboration(spark, sf_dir):
    """Assistant facts that a user stated just before."""
    rows = tables.facts(spark, sf_dir)
    order = F.row_number().over(_by("subject_id", "asserted_at", "assertion_id")).alias("order_index")
    ready = rows.select("assertion_id", F.lit(1).alias("subject"), F.col("subject_id").alias("conversation_id"), "predicate", "object_signature", "role", order)
    return assertions.corroborated(ready).where("role = 'assistant'").select("assertion_id", "corroborated")


def _by(key: str, *order: str):
    from pyspark.sql import Window

    return Window.partitionBy(key).orderBy(*order)


def jn07_retraction_targets(spark, sf_dir):
    """What users' retractions take back."""
    said = tables.utterances(spark, sf_dir)
    made = _grounded(spark, sf_dir)
    found = assertions.retraction_targets(assertions.retractions(said), said, made)
    return found.join(made.select(F.col("assertion_id").alias("target_id"), F.col("message_id").alias("target_message")), "target_id", "left").groupBy("message_id", "kind").agg(F.max("target_message").alias("target_message"))


def ap22_predicates(spark, sf_dir):
    """Predicates with first sight and count."""
    return assertions.predicates(_grounded(spark, sf_dir)).select("label", "first_seen", "assertions")


# --- lifecycle -----------------------------------------------------------------------------------------------------


def tr01_valid_time(spark, sf_dir):
    """Valid time of statements by the nearest time mention, else the moment of saying."""
    said = threads.eligible(tables.utterances(spark, sf_dir))
    made = assertions.extracted(said).join(said.select("message_id", "created_at"), "message_id").withColumn("assertion_id", F.concat_ws("-", "message_id", "predicate"))
    found = temporal.with_valid_time(made, timex.time_mentions(said))
    return found.select("assertion_id", times.iso_ms(F.col("valid_from")).alias("valid_from"), times.iso_ms(F.col("valid_to")).alias("valid_to"), "valid_source")


def flt10_eligibility(spark, sf_dir):
    """Facts with status and reasons."""
    return _facts(spark, sf_dir).select("assertion_id", F.array_join("reasons", ",").alias("reasons"), "status")


def jn18_rules(spark, sf_dir):
    """The rule of each kind of fact."""
    rows = tables.facts(spark, sf_dir).select("predicate", F.when(F.col("subject_id") % 2 == 0, "even").otherwise("odd").alias("subject_type")).distinct()
    return temporal.rules_for(rows, _rules(spark)).select("predicate", "subject_type", "rule_id", "functional")


def tr04_retracted(spark, sf_dir):
    """Facts that a retraction names."""
    rows = _facts(spark, sf_dir).withColumn("fact_key", F.concat_ws("|", F.col("subject_id").cast("string"), "predicate", "object_signature", F.col("assertion_id").cast("string")))
    taken = rows.where("assertion_id % 19 = 0").select(F.concat(F.lit("r"), F.col("assertion_id").cast("string")).alias("retraction_id"), F.col("assertion_id").alias("message_id"), F.lit(0).alias("start"), "confidence", "role", F.col("fact_key").alias("target_fact"))
    return temporal.apply_retractions(rows, taken).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def tr05_negations(spark, sf_dir):
    """Statuses after negations."""
    rows = _facts(spark, sf_dir).withColumn("valid_to", F.lit(None).cast("timestamp")).drop("reasons")
    return temporal.apply_negations(rows).groupBy("status", "ambiguous").agg(F.count(F.lit(1)).alias("n"))


def _walked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _facts(spark, sf_dir).withColumns({"valid_to": F.lit(None).cast("timestamp"), "functional": F.col("predicate").isin("click", "purchase")}).drop("reasons")
    return rows


def tr06_functional(spark, sf_dir):
    """Statuses after functional facts are walked."""
    return temporal.apply_functional(_walked(spark, sf_dir)).groupBy("predicate", "status").agg(F.count(F.lit(1)).alias("n"), F.count("superseded_by").alias("superseded"))


def tr07_conflicts(spark, sf_dir):
    """Conflicts met on the walk, by kind."""
    return temporal.functional_conflicts(_walked(spark, sf_dir)).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("members")).alias("members"))


def ag12_status_counts(spark, sf_dir):
    """Facts by status."""
    return _facts(spark, sf_dir).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def dq01_quality(spark, sf_dir):
    """Quality of facts in one row."""
    report = analytics.quality_report(_facts(spark, sf_dir))
    return report.select("facts", "dated", "active", "first_at", "last_at", "subjects", F.round("mean_confidence", 9).alias("mean_confidence"))


# --- graph ---------------------------------------------------------------------------------------------------------


def _graph_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _facts(spark, sf_dir).withColumn("valid_to", F.when(F.col("assertion_id") % 2 == 0, F.col("valid_from") + F.expr("interval 1 day")))


def gr_nodes(spark, sf_dir):
    """Nodes by type."""
    return graph.fact_nodes(_graph_facts(spark, sf_dir)).groupBy("node_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("label").alias("labels"))


def gr20_edges(spark, sf_dir):
    """Edges by type, none dangling."""
    rows = _graph_facts(spark, sf_dir)
    kept = graph.without_dangling(graph.fact_edges(rows), graph.fact_nodes(rows))
    return kept.groupBy("edge_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("dst_id").alias("targets"))


def gr30_node_ids(spark, sf_dir):
    """Ids of predicate nodes."""
    rows = _facts(spark, sf_dir).select("predicate").distinct()
    return rows.select("predicate", graph.node_id("Predicate", F.col("predicate")).alias("node_id"))


def jn23_conflict_pairs(spark, sf_dir):
    """Pairs within small conflict groups."""
    groups = _facts(spark, sf_dir).groupBy(F.col("subject_id").cast("string").alias("conflict_id")).agg(F.array_sort(F.collect_list(F.col("assertion_id").cast("string"))).alias("members"))
    return graph.conflict_edges(groups).groupBy("edge_type").agg(F.count(F.lit(1)).alias("n"))


def gr12_topics(spark, sf_dir):
    """Topics of facts."""
    found = graph.topics(_facts(spark, sf_dir))
    return found.select("topic_id", "count", "first_at", F.round("mean_confidence", 9).alias("mean_confidence"), F.get("members", F.lit(0)).alias("first_member"))


def snk02_upsert(spark, sf_dir):
    """Last fact of each subject and predicate, as an upsert leaves it."""
    rows = tables.facts(spark, sf_dir).withColumn("pk", F.concat_ws("|", F.col("subject_id").cast("string"), "predicate"))
    return graph.last_wins(rows, "pk", "assertion_id").select("pk", "assertion_id", "object_signature")


def snk04_insert_ignore(spark, sf_dir):
    """First fact of each subject and predicate, as insert-or-ignore leaves it."""
    rows = tables.facts(spark, sf_dir).withColumn("pk", F.concat_ws("|", F.col("subject_id").cast("string"), "predicate"))
    return graph.first_wins(rows, "pk", "assertion_id").select("pk", "assertion_id", "object_signature")


# --- profiles ------------------------------------------------------------------------------------------------------


def tp00_focal(spark, sf_dir):
    """The subject of most facts."""
    return profile.focal(tables.facts(spark, sf_dir))


def tp01_windows(spark, sf_dir):
    """Months of each subject that hold facts."""
    found = profile.windows(tables.facts(spark, sf_dir))
    return found.select("subject_id", "window_start", "label", "window_index", "previous", "facts")


def jn22_overlap_windows(spark, sf_dir):
    """Windows that facts' valid time meets."""
    rows = _graph_facts(spark, sf_dir)
    return profile.overlapping(rows, profile.windows(rows)).groupBy("window_start").agg(F.count(F.lit(1)).alias("n"))


def tp02_salience(spark, sf_dir):
    """Salience of members in windows."""
    rows = tables.facts(spark, sf_dir)
    found = profile.members(rows, profile.windows(rows))
    return found.select("subject_id", "window_start", "member", "mentions", F.round("salience", 6).alias("salience"))


def tp03_categories(spark, sf_dir):
    """Categories of members in windows."""
    return profile.classified(tables.facts(spark, sf_dir))


def _ranked(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = tables.facts(spark, sf_dir)
    found = profile.windows(rows)
    return profile.ranked(profile.members(rows, found), profile.classified(rows)), found


def wf10_cluster_rank(spark, sf_dir):
    """Members by rank in their cluster."""
    return _ranked(spark, sf_dir)[0].select("subject_id", "window_start", "member", "category", "cluster_rank", "window_rank")


def wf09_cluster_evolves(spark, sf_dir):
    """Clusters and whether they go on from the window before."""
    rows, found = _ranked(spark, sf_dir)
    return profile.clusters(rows, found).select("subject_id", "window_start", "category", "size", "evolves")


def vz04_layout(spark, sf_dir):
    """Places of members around their axis."""
    return profile.layout(_ranked(spark, sf_dir)[0]).select("subject_id", "window_start", "member", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "z")


def st_daily_counts(spark, sf_dir):
    """Events a day and type, counted by a stream run to its end."""
    from factloom.streaming import windows

    found = windows.daily(windows.table_stream(spark, sf_dir, "events"), "ts", "event_type")
    return windows.run_once(found, "factloom_daily_counts")


def fn30_lexicon_score(spark, sf_dir):
    """The lexicon score over part columns."""
    p = _table(spark, sf_dir, "part")
    return p.select("p_partkey", F.round(scores.lexicon_score(F.col("p_size").cast("double"), F.col("p_partkey") % 7, F.col("p_retailprice") / 1000.0, F.lit(0.5)), 6).alias("score"))


def qry02_active_facts(spark, sf_dir):
    """Active statements by the speakers, newest first: message to fact to lifecycle."""
    said = threads.eligible(tables.utterances(spark, sf_dir))
    made = _grounded(spark, sf_dir)
    dated = temporal.with_valid_time(made, timex.time_mentions(said))
    rows = dated.select("assertion_id", F.col("subject").alias("subject_id"), "predicate", "object", "object_signature", "valid_from", "valid_to", F.col("final").alias("confidence"), F.least(F.lit(1), F.coalesce("object_tier", F.lit(5))).alias("tier"), "polarity", "modality", "role", "corroborated", (F.col("valid_source") == "explicit").alias("explicit"))
    ready = temporal.eligibility(rows).drop("reasons").withColumn("functional", F.col("predicate").isin("works_at", "lives_in", "has_name"))
    done = temporal.apply_functional(ready)
    return done.where("status = 'active'").select("subject_id", "predicate", "object", "valid_from", "valid_to", F.round("confidence", 6).alias("confidence")).orderBy(F.desc("valid_from"), "subject_id", "predicate", "object")


def fn52_exclusions(spark, sf_dir):
    """Fences and quotes around statements, and what is left outside."""
    said = tables.utterances(spark, sf_dir)
    text = F.when(F.col("message_id") % 3 == 0, F.concat("text", F.lit("\n```py\nx=1\n```\nend"))).when(F.col("message_id") % 3 == 1, F.concat(F.lit("> quoted\n"), "text")).otherwise(F.col("text"))
    rows = markup.with_exclusions(said.withColumn("text", text), quotes=True)
    return rows.select("message_id", F.size("fences").alias("fences"), F.size("blockquotes").alias("quotes"), F.get("excluded", F.lit(0))["start"].alias("start"), F.get("excluded", F.lit(0))["end"].alias("end"))


def tp04_profile_graph(spark, sf_dir):
    """Nodes and edges of profiles, by type."""
    rows, found = (x.persist() for x in _ranked(spark, sf_dir))
    some_nodes, some_edges = graph.profile_graph(found, rows, profile.clusters(rows, found).persist())
    kept = graph.without_dangling(some_edges, some_nodes)
    return some_nodes.groupBy(F.col("node_type").alias("kind")).agg(F.count(F.lit(1)).alias("n")).unionByName(kept.groupBy(F.col("edge_type").alias("kind")).agg(F.count(F.lit(1)).alias("n")))


def qry01_user_entities(spark, sf_dir):
    """The fifty most salient entities that users mentioned."""
    rows = _mentions(spark, sf_dir).persist()
    found = entities.consolidated(rows, F.to_timestamp(F.lit(AS_OF)))
    named = rows.where("role = 'user'").select("kind", entity_key(F.col("kind"), F.col("surface")).alias("key")).distinct()
    return found.join(named, ["kind", "key"], "left_semi").select("kind", "key", F.round("salience", 6).alias("salience")).orderBy(F.desc("salience"), "kind", "key").limit(50)


def qry03_month_items(spark, sf_dir):
    """Members of windows of one month with category and salience, twenty at most."""
    rows, found = _ranked(spark, sf_dir)
    months = found.where(F.date_format("window_start", "yyyy-MM").startswith("2024-01") | F.col("label").startswith("January"))
    return rows.join(months.select("subject_id", "window_start", "label"), ["subject_id", "window_start"]).select("subject_id", "label", "member", "category", F.round("salience", 6).alias("salience")).orderBy(F.desc("salience"), "subject_id", "member").limit(20)


def wf13_topic_support(spark, sf_dir):
    """Topics' statements in order of time."""
    found = graph.topics(_facts(spark, sf_dir))
    return found.select("topic_id", F.posexplode("members").alias("rank", "assertion_id"))


def gr23_message_anchors(spark, sf_dir):
    """Edges from assertions to their messages, none dangling."""
    said = threads.eligible(tables.utterances(spark, sf_dir))
    made = assertions.extracted(said).withColumn("assertion_id", F.concat_ws("-", F.col("message_id").cast("string"), "predicate"))
    own = graph.nodes(made, "Assertion", F.col("assertion_id"), F.col("surface"))
    kept = graph.without_dangling(graph.asserted_in(made), graph.message_nodes(said).unionByName(own))
    return kept.groupBy("edge_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("dst_id").alias("messages"))


def ag26_surface_distribution(spark, sf_dir):
    """How many entities have how many surfaces."""
    found = entities.consolidated(_mentions(spark, sf_dir), F.to_timestamp(F.lit(AS_OF)))
    return found.groupBy(F.size("aliases").alias("surfaces")).agg(F.count(F.lit(1)).alias("entities"))


def so06_sample(spark, sf_dir):
    """A tenth of events, the least hashes of their ids."""
    return _table(spark, sf_dir, "events").where(F.pmod(F.crc32(F.col("event_id").cast("string").cast("binary")), F.lit(10)) == 0).select("event_id", "event_type")
