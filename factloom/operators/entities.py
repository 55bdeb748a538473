"""Entities from mentions: consolidation, salience and canonical names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.ids import entity_id
from factloom.functions.scores import clamp, salience, salience_factor
from factloom.functions.text import entity_key


def consolidated(mentions: DataFrame, as_of: Column, half_life: float = 90.0) -> DataFrame:
    """One row a (kind, key) of mentions (kind, surface, conversation_id, role, created_at): counts, span of time, aliases, name, salience."""
    rows = mentions.withColumn("key", entity_key(F.col("kind"), F.col("surface")))
    keys = ["kind", "key"]
    surfaces = rows.groupBy(*keys, "surface").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("role") == "user").alias("by_user"))
    names = surfaces.groupBy(*keys).agg(F.max_by("surface", F.struct("n", "by_user", "surface")).alias("name"), F.array_sort(F.collect_set("surface")).alias("aliases"))
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("mentions"), F.count_distinct("conversation_id").alias("conversations"), F.count_if(F.col("role") == "user").alias("user_mentions"), F.min("created_at").alias("first_seen"), F.max("created_at").alias("last_seen"))
    score = salience(F.col("mentions"), F.col("conversations"), F.col("user_mentions"), F.col("last_seen"), as_of, half_life)
    return counts.join(names, keys).select(entity_id("entity", F.col("kind"), F.col("key")).alias("entity_id"), "kind", "key", "name", "aliases", "mentions", "conversations", "user_mentions", "first_seen", "last_seen", score.alias("salience"))


def with_self(entities: DataFrame) -> DataFrame:
    """entities and, unless there, the speaker's own."""
    spark = entities.sparkSession
    own = spark.range(1).select(entity_id("entity", "PERSON", "__SELF__").alias("entity_id"), F.lit("PERSON").alias("kind"), F.lit("__SELF__").alias("key"), F.lit("SELF").alias("name"))
    missing = own.join(entities.select("kind", "key"), ["kind", "key"], "left_anti")
    return entities.unionByName(missing, allowMissingColumns=True)


def detector_tier(detector: Column) -> Column:
    """1 for exact identifiers, 2 for other patterns, 3 for lexicon terms, 4 for the rest."""
    return F.when(detector.isin("EMAIL", "URL", "DOI", "UUID", "IP_ADDRESS", "PHONE"), 1).when(detector.isin("HASH_HEX", "FILEPATH", "BARE_DOMAIN", "arXiv", "CVE", "ORCID", "HANDLE", "HASHTAG"), 2).when(detector.startswith("LEXICON"), 3).otherwise(4)


def surface_scores(mentions: DataFrame) -> DataFrame:
    """entity_id, surface, score, count, best_tier, first_at: trust in the speaker, times the detector's weight, times confidence.

    Sums run in the order of message and start, so that they are the same wherever rows lie.
    """
    tier = detector_tier(F.col("detector"))
    weight = F.when(tier == 1, 1.0).when(tier == 2, 0.9).when(tier == 3, 0.8).otherwise(0.6)
    role = F.when(F.col("role") == "user", 1.0).otherwise(0.5)
    rows = mentions.select("entity_id", "surface", "message_id", "start", "created_at", tier.alias("tier"), (role * weight * (0.5 + 0.5 * F.col("confidence"))).alias("part"))
    per = rows.groupBy("entity_id", "surface").agg(F.array_sort(F.collect_list(F.struct("message_id", "start", "part"))).alias("parts"), F.count(F.lit(1)).alias("count"), F.min("tier").alias("best_tier"), F.min("created_at").alias("first_at"))
    return per.select("entity_id", "surface", F.aggregate("parts", F.lit(0.0), lambda s, p: s + p["part"]).alias("score"), "count", "best_tier", "first_at")


def canonical_names(scores: DataFrame, terms: DataFrame | None = None, bonus: float = 0.2) -> DataFrame:
    """entity_id, name, confidence: the surface ranked first, a lexicon term's own surface (entity_id, canonical) with a bonus."""
    if terms is not None:
        scores = scores.join(terms.select("entity_id", "canonical"), "entity_id", "left").withColumn("score", F.col("score") + F.when(F.col("surface") == F.col("canonical"), bonus).otherwise(0.0)).drop("canonical")
    order = Window.partitionBy("entity_id").orderBy(F.desc("score"), "best_tier", F.desc("count"), F.col("first_at").asc_nulls_last(), F.desc(F.length("surface")), "surface")
    total = F.sum("score").over(Window.partitionBy("entity_id"))
    ranked = scores.withColumn("rank", F.row_number().over(order)).withColumn("total", total).where("rank = 1")
    return ranked.select("entity_id", F.col("surface").alias("name"), F.when(F.col("total") > 0, clamp(F.col("score") / F.col("total") + (4 - F.col("best_tier")) * 0.05)).otherwise(1.0).alias("confidence"))


def name_changes(entities: DataFrame, names: DataFrame) -> DataFrame:
    """entity_id, previous_name, name, confidence where the chosen name differs."""
    joined = entities.select("entity_id", F.col("name").alias("previous_name")).join(names, "entity_id")
    return joined.where(~F.col("previous_name").eqNullSafe(F.col("name"))).select("entity_id", "previous_name", "name", "confidence")


def best_tiers(mentions: DataFrame) -> DataFrame:
    """entity_id and the best tier of the detectors that found it."""
    return mentions.groupBy("entity_id").agg(F.min(detector_tier(F.col("detector"))).alias("best_tier"))


def greatest_salience(entities: DataFrame) -> DataFrame:
    """One row: the corpus's greatest salience, at least 1."""
    return entities.agg(F.greatest(F.lit(1.0), F.coalesce(F.max("salience"), F.lit(1.0))).alias("most"))


def with_salience(facts: DataFrame, entities: DataFrame, bonus: float = 0.1) -> DataFrame:
    """facts (subject_id) with subject_salience and salience_factor, 1 for subjects that are no entity."""
    known = entities.select(F.col("entity_id").alias("subject_id"), F.col("salience").alias("subject_salience"))
    # one row of one number
    joined = facts.join(known, "subject_id", "left").crossJoin(F.broadcast(greatest_salience(entities)))
    return joined.withColumn("salience_factor", salience_factor(F.col("subject_salience"), F.col("most"), bonus)).drop("most")


def context_mentions(messages: DataFrame, mentions: DataFrame, k: int = 5) -> DataFrame:
    """message_id, entity_id and mentions: what the messages up to k before each message mention.

    Messages have conversation_id and order_index; each mention goes to the
    messages that come at most k places later.
    """
    placed = mentions.select("message_id", "entity_id").join(messages.select("message_id", "conversation_id", "order_index"), "message_id")
    ahead = placed.select("conversation_id", "entity_id", F.explode(F.sequence(F.col("order_index") + 1, F.col("order_index") + k)).alias("order_index"))
    met = ahead.join(messages.select("message_id", "conversation_id", "order_index"), ["conversation_id", "order_index"])
    return met.groupBy("message_id", "entity_id").agg(F.count(F.lit(1)).alias("mentions"))


def at_spans(spans: DataFrame, mentions: DataFrame) -> DataFrame:
    """spans (message_id, start, end) with the entity of the mention they meet: the best by tier, confidence and id; null where none."""
    tier = detector_tier(F.col("detector"))
    known = mentions.groupBy("message_id").agg(F.collect_list(F.struct(tier.alias("tier"), (-F.col("confidence")).alias("less"), "entity_id", F.col("start"), F.col("end"))).alias("_known"))
    met = F.filter("_known", lambda m: (F.col("start") < m["end"]) & (F.col("end") > m["start"]))
    best = F.array_min(met)
    joined = spans.join(known, "message_id", "left")
    return joined.select(*spans.columns, best["entity_id"].alias("entity_id"), best["tier"].alias("tier"), (-best["less"]).alias("entity_conf"))
