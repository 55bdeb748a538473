"""Reads of the graph and of entities for pictures: by id, by type, along a profile, within a span of time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

METADATA = "map<string,string>"


def _decoded(rows: DataFrame) -> DataFrame:
    empty = F.create_map().cast(METADATA)
    return rows.withColumn("metadata", F.coalesce(F.from_json("metadata_json", METADATA), empty))


def node(nodes: DataFrame, node_id: str | Column) -> DataFrame:
    """The node of an id, its metadata decoded."""
    return _decoded(nodes.where(F.col("node_id") == node_id))


def edges_from(edges: DataFrame, src_id: str | Column, edge_type: str) -> DataFrame:
    """The edges of a type that leave a node, their metadata decoded."""
    return _decoded(edges.where((F.col("src_id") == src_id) & (F.col("edge_type") == edge_type)))


def profile_id(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node_id of the profile with the least id, else of the least target of a HAS_PROFILE edge: one row or none."""
    own = nodes.where("node_type = 'TemporalProfile'").select("node_id", F.lit(0).alias("way"))
    led_to = edges.where("edge_type = 'HAS_PROFILE'").select(F.col("dst_id").alias("node_id"), F.lit(1).alias("way"))
    return own.unionByName(led_to).orderBy("way", "node_id").limit(1).select("node_id")


def profile_walk(nodes: DataFrame, edges: DataFrame, start: DataFrame | None = None, max_windows: int = 36, max_members: int = 20, min_salience: float = 0.0) -> DataFrame:
    """window_index, window, category, member, rank and salience along a profile: its first windows, their clusters, each one's first members.

    start holds the profile's node_id; without it, profile_id().
    """
    start = profile_id(nodes, edges) if start is None else start
    at = lambda key, kind: F.col("metadata")[key].cast(kind)
    labels = _decoded(nodes).select("node_id", "label", "metadata")
    led = _decoded(edges.where(F.col("edge_type").isin("HAS_WINDOW", "HAS_CLUSTER", "CLUSTER_CONTAINS"))).select("edge_type", "src_id", "dst_id", "metadata")
    first = led.where("edge_type = 'HAS_WINDOW'").join(start.select(F.col("node_id").alias("src_id")), "src_id", "left_semi")
    first = first.select(F.col("dst_id").alias("window_id"), F.coalesce(at("window_index", "int"), F.lit(0)).alias("window_index")).orderBy("window_index", "window_id").limit(max_windows)
    named = first.join(labels.select(F.col("node_id").alias("window_id"), F.col("label").alias("window")), "window_id")
    inside = led.where("edge_type = 'HAS_CLUSTER'").select(F.col("src_id").alias("window_id"), F.col("dst_id").alias("cluster_id"))
    groups = named.join(inside, "window_id").join(labels.select(F.col("node_id").alias("cluster_id"), F.coalesce(at("category_key", "string"), F.lit("unclassified")).alias("category")), "cluster_id")
    held = led.where("edge_type = 'CLUSTER_CONTAINS'").select(F.col("src_id").alias("cluster_id"), F.col("dst_id").alias("member_id"), F.coalesce(at("rank", "int"), F.lit(999)).alias("rank"), F.coalesce(at("salience", "double"), F.lit(0.0)).alias("salience"))
    order = Window.partitionBy("cluster_id").orderBy("rank", "member_id")
    top = groups.join(held, "cluster_id").withColumn("place", F.row_number().over(order)).where((F.col("place") <= max_members) & (F.col("salience") >= min_salience))
    return top.join(labels.select(F.col("node_id").alias("member_id"), F.substring("label", 1, 50).alias("member")), "member_id").select("window_index", "window", "category", "member", "rank", "salience")


def entities_between(entities: DataFrame, begin: Column | None = None, end: Column | None = None, most: int | None = None) -> DataFrame:
    """Entities first seen within [begin, end); without a span, of all time. All of them, or where ``most`` is given the first by first_seen (ties by id)."""
    kept = entities
    if begin is not None:
        kept = kept.where(F.col("first_seen") >= begin)
    if end is not None:
        kept = kept.where(F.col("first_seen") < end)
    return kept if most is None else kept.orderBy("first_seen", "entity_id").limit(most)


def active_links(facts: DataFrame, min_confidence: float = 0.3) -> DataFrame:
    """subject_id, object_id and confidence of active facts about an entity, surer than the least."""
    return facts.where(F.col("object_id").isNotNull() & (F.col("status") == "active") & (F.col("confidence") > min_confidence)).select("subject_id", "object_id", "confidence")


def links_between(links: DataFrame, entities: DataFrame) -> DataFrame:
    """Links whose two ends are among the entities."""
    ids = entities.select("entity_id")
    return links.join(ids.withColumnRenamed("entity_id", "subject_id"), "subject_id", "left_semi").join(ids.withColumnRenamed("entity_id", "object_id"), "object_id", "left_semi").select(*links.columns)
