"""Graph tables: nodes and edges of everything known, without dangling ends."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.config import GRAPH_NAMESPACE
from factloom.functions.ids import entity_id
from factloom.functions.times import iso_ms

EMPTY = "struct<schema_version:string>"


def node_id(kind: str | Column, source: Column) -> Column:
    """Id of a node."""
    return entity_id("node", kind, source, namespace=GRAPH_NAMESPACE)


def edge_id(kind: str | Column, src: Column, dst: Column) -> Column:
    """Id of an edge."""
    return entity_id("edge", kind, src, dst, namespace=GRAPH_NAMESPACE)


def nodes(rows: DataFrame, kind: str, source: Column, label: Column, **metadata: Column) -> DataFrame:
    """node_id, node_type, source_id, label and metadata_json of rows, one a source."""
    data = F.to_json(F.struct(F.lit("1.0").alias("schema_version"), *[c.alias(k) for k, c in sorted(metadata.items())]))
    text = source.cast("string")
    return rows.select(node_id(kind, text).alias("node_id"), F.lit(kind).alias("node_type"), text.alias("source_id"), label.alias("label"), data.alias("metadata_json")).dropDuplicates(["node_id"])


def edges(rows: DataFrame, kind: str, src_kind: str, src: Column, dst_kind: str, dst: Column, **metadata: Column) -> DataFrame:
    """edge_id, edge_type, src_id, dst_id and metadata_json of rows, one a pair of ends; null ends make none."""
    data = F.to_json(F.struct(*[c.alias(k) for k, c in sorted(metadata.items())])) if metadata else F.lit("{}")
    ends = rows.where(src.isNotNull() & dst.isNotNull()).select(node_id(src_kind, src.cast("string")).alias("src_id"), node_id(dst_kind, dst.cast("string")).alias("dst_id"), data.alias("metadata_json"))
    return ends.select(edge_id(kind, F.col("src_id"), F.col("dst_id")).alias("edge_id"), F.lit(kind).alias("edge_type"), "src_id", "dst_id", "metadata_json").dropDuplicates(["edge_id"])


def without_dangling(all_edges: DataFrame, all_nodes: DataFrame) -> DataFrame:
    """Edges whose two ends are nodes."""
    ids = all_nodes.select("node_id")
    return all_edges.join(ids.withColumnRenamed("node_id", "src_id"), "src_id", "left_semi").join(ids.withColumnRenamed("node_id", "dst_id"), "dst_id", "left_semi").select(*all_edges.columns)


def interval_key(start: Column, end: Column) -> Column:
    """Source of a time interval's node: moments to the millisecond, or to the microsecond where they are no whole milliseconds."""

    def moment(at: Column) -> Column:
        whole = F.unix_micros(at) % 1000 == 0
        return F.when(whole, iso_ms(at)).otherwise(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))

    return F.concat_ws("|", *[F.coalesce(moment(at.cast("timestamp")), F.lit("-")) for at in (start, end)])


def interval_label(start: Column, end: Column) -> Column:
    """X to Y, or Since X."""
    day = "yyyy-MM-dd"
    return F.when(end.isNotNull(), F.concat(F.date_format(start, day), F.lit(" to "), F.date_format(end, day))).otherwise(F.concat(F.lit("Since "), F.date_format(start, day)))


def fact_nodes(facts: DataFrame) -> DataFrame:
    """Assertion, subject, predicate, value and interval nodes of facts."""
    text = F.concat_ws(" ", F.col("subject_id").cast("string"), "predicate", "object_signature")
    dated = facts.where("valid_from is not null")
    return (
        nodes(facts, "Assertion", F.col("assertion_id"), F.substring(text, 1, 100), confidence=F.col("confidence"), status=F.col("status"))
        .unionByName(nodes(facts.select("subject_id").distinct(), "Entity", F.col("subject_id"), F.col("subject_id").cast("string")))
        .unionByName(nodes(facts.select("predicate").distinct(), "Predicate", F.col("predicate"), F.col("predicate")))
        .unionByName(nodes(facts.select("object_signature").distinct(), "Value", F.col("object_signature"), F.substring("object_signature", 1, 50)))
        .unionByName(nodes(dated.select("valid_from", "valid_to").distinct(), "TimeInterval", interval_key(F.col("valid_from"), F.col("valid_to")), interval_label(F.col("valid_from"), F.col("valid_to"))))
    )


def fact_edges(facts: DataFrame) -> DataFrame:
    """HAS_SUBJECT, HAS_PREDICATE, HAS_OBJECT and VALID_IN edges of facts."""
    own = F.col("assertion_id")
    return (
        edges(facts, "HAS_SUBJECT", "Assertion", own, "Entity", F.col("subject_id"))
        .unionByName(edges(facts, "HAS_PREDICATE", "Assertion", own, "Predicate", F.col("predicate")))
        .unionByName(edges(facts, "HAS_OBJECT", "Assertion", own, "Value", F.col("object_signature")))
        .unionByName(edges(facts.where("valid_from is not null"), "VALID_IN", "Assertion", own, "TimeInterval", interval_key(F.col("valid_from"), F.col("valid_to"))))
    )


def lifecycle_edges(facts: DataFrame, inverse: bool = False) -> DataFrame:
    """SUPERSEDES (newer to older), NEGATED_BY and RETRACTED_BY edges of facts by those of superseded_by, negated_by and retracted_by they have; with NEGATES and RETRACTS the other way if asked for."""
    own = ("Assertion", F.col("assertion_id"))
    ways = []
    if "superseded_by" in facts.columns:
        ways.append(("SUPERSEDES", ("Assertion", F.col("superseded_by")), own))
    for column, kind, there, back in (("negated_by", "Assertion", "NEGATED_BY", "NEGATES"), ("retracted_by", "Retraction", "RETRACTED_BY", "RETRACTS")):
        if column in facts.columns:
            other = (kind, F.col(column))
            ways += [(there, own, other), *([(back, other, own)] if inverse else [])]
    found = [edges(facts, name, *src, *dst) for name, src, dst in ways]
    return reduce(DataFrame.unionByName, found)


def conflict_edges(conflicts: DataFrame, limit: int = 10) -> DataFrame:
    """HAS_CONFLICT_MEMBER of conflicts (conflict_id, members), and CONFLICTS_WITH between all pairs of groups of up to ``limit``."""
    members = conflicts.select("conflict_id", F.size("members").alias("n"), F.explode("members").alias("member"))
    small = members.where(F.col("n") <= limit).select("conflict_id", "member")
    pairs = small.withColumnRenamed("member", "a").join(small.withColumnRenamed("member", "b"), "conflict_id").where("a < b")
    return edges(members, "HAS_CONFLICT_MEMBER", "ConflictGroup", F.col("conflict_id"), "Assertion", F.col("member")).unionByName(edges(pairs, "CONFLICTS_WITH", "Assertion", F.col("a"), "Assertion", F.col("b"), conflict_id=F.col("conflict_id")))


def last_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row a key: that of the greatest order value (an upsert's outcome)."""
    packed = F.struct(*[F.col(c) for c in rows.columns])
    return rows.groupBy(key).agg(F.max_by(packed, order).alias("row")).select("row.*")


def first_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row a key: that of the least order value (insert-or-ignore's outcome)."""
    packed = F.struct(*[F.col(c) for c in rows.columns])
    return rows.groupBy(key).agg(F.min_by(packed, order).alias("row")).select("row.*")


def topics(facts: DataFrame) -> DataFrame:
    """topic_id, predicate, object_signature, modality, polarity, count, first_at, mean_confidence and members of equal statements."""
    key = F.sha2(F.concat_ws("|", "predicate", "object_signature", "modality", "polarity"), 256)
    at = F.coalesce("valid_from", "asserted_at")
    return facts.groupBy(key.alias("topic_id"), "predicate", "object_signature", "modality", "polarity").agg(F.count(F.lit(1)).alias("count"), F.min(at).alias("first_at"), F.avg("confidence").alias("mean_confidence"), F.transform(F.array_sort(F.collect_list(F.struct(at.alias("at"), F.col("assertion_id")))), lambda m: m["assertion_id"]).alias("members"))


def message_nodes(messages: DataFrame) -> DataFrame:
    """Nodes of messages."""
    return nodes(messages, "Message", F.col("message_id"), F.substring(F.coalesce("text", F.lit("")), 1, 100), role=F.col("role"))


def asserted_in(assertions: DataFrame) -> DataFrame:
    """ASSERTED_IN edges from assertions to their messages."""
    return edges(assertions, "ASSERTED_IN", "Assertion", F.col("assertion_id"), "Message", F.col("message_id"))


def lexicon_edges(mentions: DataFrame) -> DataFrame:
    """DERIVED_FROM_LEXICON edges of mentions (entity_id, term_key): by their own term, not by all terms."""
    return edges(mentions, "DERIVED_FROM_LEXICON", "Entity", F.col("entity_id"), "LexiconTerm", F.col("term_key"))


def topic_edges(found: DataFrame) -> DataFrame:
    """TOPIC_SUPPORTED_BY edges of topics, ranked by time."""
    support = found.select("topic_id", F.posexplode("members").alias("rank", "member"))
    return edges(support, "TOPIC_SUPPORTED_BY", "Topic", F.col("topic_id"), "Assertion", F.col("member"), rank=F.col("rank"))


def profile_graph(windows: DataFrame, ranked: DataFrame, clusters: DataFrame, top_members: int = 10, top_clusters: int = 6) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of profiles: profile, windows, clusters, members, in order and by rank."""
    subject, start = F.col("subject_id").cast("string"), F.date_format("window_start", "yyyy-MM-dd")
    window, cluster = F.concat_ws("|", subject, start), F.concat_ws("|", subject, start, F.col("category"))
    before = F.when(F.col("previous").isNotNull(), F.concat_ws("|", subject, F.date_format("previous", "yyyy-MM-dd")))
    all_nodes = (
        nodes(windows.select("subject_id").distinct(), "TemporalProfile", subject, F.concat(F.lit("Profile of "), subject))
        .unionByName(nodes(windows, "TemporalWindow", window, F.col("label"), window_index=F.col("window_index")))
        .unionByName(nodes(clusters, "SemanticCluster", cluster, F.initcap(F.replace("category", F.lit("_"), F.lit(" "))), category_key=F.col("category"), size=F.col("size"), mean_salience=F.col("mean_salience")))
        .unionByName(nodes(clusters.select("category").distinct(), "SemanticCategory", F.col("category"), F.initcap(F.replace("category", F.lit("_"), F.lit(" ")))))
        .unionByName(nodes(ranked.select("member").distinct(), "Value", F.col("member"), F.substring("member", 1, 50)))
    )
    all_edges = (
        edges(windows, "HAS_WINDOW", "TemporalProfile", subject, "TemporalWindow", window, window_index=F.col("window_index"))
        .unionByName(edges(windows, "WINDOW_PRECEDES", "TemporalWindow", before, "TemporalWindow", window))
        .unionByName(edges(clusters, "HAS_CLUSTER", "TemporalWindow", window, "SemanticCluster", cluster))
        .unionByName(edges(clusters, "CLUSTER_OF_CATEGORY", "SemanticCluster", cluster, "SemanticCategory", F.col("category")))
        .unionByName(edges(ranked, "CLUSTER_CONTAINS", "SemanticCluster", cluster, "Value", F.col("member"), salience=F.col("salience"), rank=F.col("cluster_rank")))
        .unionByName(edges(ranked.where(F.col("window_rank") <= top_members), "WINDOW_TOP_MEMBER", "TemporalWindow", window, "Value", F.col("member"), rank=F.col("window_rank")))
        .unionByName(edges(clusters.where("evolves").join(windows.select("subject_id", "window_start", "previous"), ["subject_id", "window_start"]), "CLUSTER_EVOLVES", "SemanticCluster", F.concat_ws("|", subject, F.date_format("previous", "yyyy-MM-dd"), F.col("category")), "SemanticCluster", cluster))
        .unionByName(edges(clusters.where(F.col("cluster_rank") <= top_clusters), "WINDOW_TOP_CLUSTER", "TemporalWindow", window, "SemanticCluster", cluster, rank=F.col("cluster_rank")))
    )
    return all_nodes, all_edges


def evidence_edges(found: DataFrame) -> DataFrame:
    """MEMBER_EVIDENCED_BY edges of profile.evidence(): the rank, window and number of what speaks of a member.

    An assertion that speaks of a member in several windows keeps one edge, as all edges are one a pair of ends.
    """
    return edges(found, "MEMBER_EVIDENCED_BY", "Value", F.col("member"), "Assertion", F.col("assertion_id"), evidence_rank=F.col("evidence_rank"), window_start=F.date_format("window_start", "yyyy-MM-dd"), total_evidence_count=F.col("total"), capped=F.col("capped"))


def retraction_nodes(found: DataFrame) -> DataFrame:
    """Nodes of retractions (retraction_id, message_id, kind, confidence, surface, target_id, target_fact)."""
    label = F.coalesce(F.nullif(F.substring("surface", 1, 50), F.lit("")), F.concat(F.lit("Retraction ("), "kind", F.lit(")")))
    return nodes(found, "Retraction", F.col("retraction_id"), label, retraction_message_id=F.col("message_id"), retraction_type=F.col("kind"), confidence=F.col("confidence"), target_assertion_id=F.col("target_id"), target_fact_key=F.col("target_fact"))


def conflict_nodes(found: DataFrame) -> DataFrame:
    """Nodes of conflict groups (conflict_id, kind, key, members)."""
    label = F.concat("kind", F.lit(" ("), F.size("members").cast("string"), F.lit(" members)"))
    return nodes(found, "ConflictGroup", F.col("conflict_id"), label, conflict_type=F.col("kind"), conflict_key=F.col("key"), member_count=F.size("members"))


def lexicon_nodes(terms: DataFrame) -> DataFrame:
    """Nodes of selected terms (term_key, canonical, score)."""
    return nodes(terms, "LexiconTerm", F.col("term_key"), F.col("canonical"), term_key=F.col("term_key"), canonical_surface=F.col("canonical"), score=F.col("score"))


def time_source(message: Column, start: Column, surface: Column) -> Column:
    """Source of a time mention's node."""
    return F.concat_ws("|", message.cast("string"), start.cast("string"), surface)


def time_nodes(times: DataFrame) -> DataFrame:
    """Nodes of time mentions."""
    source = time_source(F.col("message_id"), F.col("start"), F.col("surface"))
    return nodes(times, "TimeMention", source, F.coalesce(F.nullif(F.substring("surface", 1, 30), F.lit("")), F.lit("Time")), message_id=F.col("message_id"), surface_text=F.col("surface"), pattern_id=F.col("pattern"), resolved_type=F.col("resolved_type"), valid_from=F.col("valid_from"), valid_to=F.col("valid_to"), resolution_granularity=F.col("granularity"), confidence=F.col("confidence"))


def qualifier_edges(found: DataFrame) -> DataFrame:
    """QUALIFIED_BY_TIME edges of assertions (assertion_id, message_id, qualifier, qualifier_start) to their time mentions."""
    linked = found.where("qualifier_start is not null")
    return edges(linked, "QUALIFIED_BY_TIME", "Assertion", F.col("assertion_id"), "TimeMention", time_source(F.col("message_id"), F.col("qualifier_start"), F.col("qualifier")), temporal_qualifier_type=F.lit("at"))


def hint_graph(facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Interval nodes and VALID_UNTIL_HINT edges of facts whose end alone is hinted (valid_until_hint, no valid_from)."""
    none = F.lit(None).cast("timestamp")
    hinted = facts.where("valid_from is null and valid_until_hint is not null")
    source = interval_key(none, F.col("valid_until_hint"))
    some = nodes(hinted.select("valid_until_hint").distinct(), "TimeInterval", source, F.concat(F.lit("Until "), F.date_format("valid_until_hint", "yyyy-MM-dd")))
    return some, edges(hinted, "VALID_UNTIL_HINT", "Assertion", F.col("assertion_id"), "TimeInterval", source)
