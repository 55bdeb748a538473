"""Assertions and retractions: extraction, grounding, corroboration, keys."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.config import AssertionConfig
from factloom.functions.ids import entity_id, json_string
from factloom.functions.scores import final_confidence, grounding
from factloom.functions.spans import overlaps
from factloom.functions.text import collapsed, jaro_winkler, jaro_winkler_of, nfkc

_KIN = "mother|father|sister|brother|wife|husband|friend|colleague|boss|partner|child|son|daughter"
# Predicate, object kind, modality, confidence, priority and pattern (the named groups are subject, object and relation).
PATTERNS = [
    ("has_name", "string", "fact", 0.90, 1, re.compile(r"\bMy\s+name\s+is\s+(?P<o>[A-Z][A-Za-z\s'-]{1,40}?)\b", re.IGNORECASE)),
    ("works_at", "entity", "state", 0.85, 5, re.compile(r"\bI\s+work\s+(?:at|for)\s+(?P<o>[A-Z][A-Za-z\s&.,'-]{1,50}?)\b", re.IGNORECASE)),
    ("lives_in", "entity", "state", 0.85, 5, re.compile(r"\bI\s+live\s+in\s+(?P<o>[A-Z][A-Za-z\s,'-]{1,50}?)\b", re.IGNORECASE)),
    ("has_", "entity", "fact", 0.85, 5, re.compile(rf"\b(?P<o>[A-Z][A-Za-z]+)\s+is\s+my\s+(?P<r>{_KIN})\b", re.IGNORECASE)),
    ("has_", "entity", "fact", 0.85, 5, re.compile(rf"\bMy\s+(?P<r>{_KIN})\s+is\s+(?P<o>[A-Z][A-Za-z]+)\b", re.IGNORECASE)),
    ("is_a", "string", "state", 0.75, 10, re.compile(r"\b(?:I\s+am|I'm)\s+(?:a\s+)?(?P<o>[A-Za-z][A-Za-z\s]{1,30}?)\b", re.IGNORECASE)),
    ("likes", "string", "preference", 0.70, 15, re.compile(r"\bI\s+(?:like|love|prefer|enjoy)\s+(?P<o>[A-Za-z][A-Za-z\s]{1,40}?)\b", re.IGNORECASE)),
    ("dislikes", "string", "preference", 0.70, 15, re.compile(r"\bI\s+(?:don't\s+like|hate|dislike)\s+(?P<o>[A-Za-z][A-Za-z\s]{1,40}?)\b", re.IGNORECASE)),
    ("has", "string", "state", 0.70, 20, re.compile(r"\bI\s+have\s+(?:a\s+)?(?P<o>[A-Za-z][A-Za-z\s]{1,40}?)\b", re.IGNORECASE)),
]
# Kind of retraction, confidence and pattern.
RETRACTIONS = [
    ("full", 0.80, re.compile(r"\b(?:Actually|Wait|No),?\s+(?:that's\s+)?(?:not\s+true|wrong|incorrect)\b", re.IGNORECASE)),
    ("full", 0.85, re.compile(r"\bI\s+was\s+wrong\s+(?:about\s+)?(.+?)(?:\.|$)", re.IGNORECASE)),
    ("correction", 0.85, re.compile(r"\bActually,?\s+(?:it's|I\s+meant?)\s+(.+?)\s+not\s+(.+?)(?:\.|$)", re.IGNORECASE)),
    ("correction", 0.80, re.compile(r"\bSorry,?\s+I\s+meant\s+(.+?)(?:\.|$)", re.IGNORECASE)),
    ("temporal_bound", 0.75, re.compile(r"\b(?:That's\s+)?no\s+longer\s+(?:true|the\s+case)\b", re.IGNORECASE)),
    ("temporal_bound", 0.80, re.compile(r"\bI\s+(?:stopped|quit|no\s+longer)\s+(.+?)(?:\.|$)", re.IGNORECASE)),
]


def extracted(messages: DataFrame) -> DataFrame:
    """message_id, predicate, object_kind, object, modality, polarity, confidence, start, end, surface of every match outside ``excluded``."""

    @F.pandas_udf("array<struct<predicate:string,object_kind:string,object:string,modality:string,confidence:double,start:int,end:int,surface:string>>")
    def scan(texts: pd.Series) -> pd.Series:
        def of(text):
            out = []
            for predicate, kind, modality, confidence, _, pattern in PATTERNS:
                for m in pattern.finditer(text):
                    thing = m.group("o").strip()
                    if len(thing) < 2:
                        continue
                    name = predicate + m.group("r").lower() if predicate == "has_" else predicate
                    out.append(dict(predicate=name, object_kind=kind, object=thing, modality=modality, confidence=confidence, start=m.start(), end=m.end(), surface=m.group(0)))
            return out

        return texts.map(of)

    rows = messages.where(F.col("text").rlike(r"(?i)\bI\b|\bmy\b"))
    excluded = F.col("excluded") if "excluded" in rows.columns else F.lit(None).cast("array<struct<start:int,end:int>>")
    found = rows.select("message_id", excluded.alias("excluded"), F.explode(scan("text")).alias("a")).select("message_id", "excluded", "a.*")
    return found.where(~overlaps(F.col("start"), F.col("end"), F.col("excluded"))).drop("excluded").withColumn("polarity", F.lit("positive"))


def retractions(messages: DataFrame) -> DataFrame:
    """message_id, kind, confidence, start, end, surface, replacement and target clause of retractions in users' messages."""

    @F.pandas_udf("array<struct<kind:string,confidence:double,start:int,end:int,surface:string,replacement:string,target:string>>")
    def scan(texts: pd.Series) -> pd.Series:
        def of(text):
            out = []
            for kind, confidence, pattern in RETRACTIONS:
                for m in pattern.finditer(text):
                    two = kind == "correction" and pattern.groups >= 2
                    out.append(dict(kind=kind, confidence=confidence, start=m.start(), end=m.end(), surface=m.group(0), replacement=m.group(1) if two else None, target=m.group(2) if two else m.group(0)))
            return out

        return texts.map(of)

    rows = messages.where((F.col("role") == "user") & F.col("text").rlike(r"(?i)wrong|incorrect|true|meant?\b|it's|longer|stopped|quit"))
    return rows.select("message_id", F.explode(scan("text")).alias("r")).select("message_id", "r.*")


def validated(candidates: DataFrame) -> DataFrame:
    """Candidates with a predicate, a known modality and polarity and at most one object; wrong spans become null."""
    ok = F.trim("predicate").isNotNull() & (F.trim("predicate") != "") & F.col("modality").isin("state", "fact", "preference", "intention", "question") & F.col("polarity").isin("positive", "negative")
    bad = (F.col("start") < 0) | (F.col("end") <= F.col("start"))
    return candidates.where(ok).withColumns({c: F.when(~F.coalesce(bad, F.lit(True)), F.col(c)) for c in ("start", "end")})


def literal_signature(kind: Column, value: Column) -> Column:
    """V: and the SHA-256 of the canonical JSON of a literal's type and value."""
    return F.concat(F.lit("V:"), F.sha2(F.concat(F.lit("["), json_string(kind), F.lit(","), json_string(value), F.lit("]")), 256))


def least_share(threshold: float) -> float:
    """The least share of the longer name's length that the shorter has where Jaro-Winkler reaches the threshold.

    Four equal letters ahead lift a Jaro score j to j + 0.4 * (1 - j); with every
    letter of the shorter name matched in order, j is (2 + share) / 3.
    """
    return max(0.0, 3 * (threshold - 0.4) / 0.6 - 2)


def resolved_objects(candidates: DataFrame, entities: DataFrame, config: AssertionConfig = AssertionConfig()) -> DataFrame:
    """candidates with object_entity, object_tier and object_conf (null for literals).

    Entities (entity_id, kind, key, name, aliases, salience) are tried by name,
    alias and key, then by similarity, then made anew; a new entity serves all
    later mentions of the same name, in the order of message and start.
    """
    refs = candidates.where("object_kind = 'entity'").select(F.trim("object").alias("ref")).distinct().withColumn("low", F.lower("ref"))
    best = Window.partitionBy("low").orderBy(F.col("salience").desc_nulls_last(), "entity_id")

    def first(rows: DataFrame, one: float, many: float) -> DataFrame:
        counted = rows.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("low"))).withColumn("rank", F.row_number().over(best))
        return counted.where("rank = 1").select("low", F.col("entity_id").alias("id"), F.when(F.col("n") == 1, one).otherwise(many).alias("conf"))

    by_name = first(entities.select(F.lower("name").alias("low"), "entity_id", "salience"), 0.95, 0.8).toDF("low", "id1", "c1")
    by_alias = first(entities.select(F.explode("aliases").alias("a"), "entity_id", "salience").select(F.lower("a").alias("low"), "entity_id", "salience").distinct(), 0.9, 0.75).toDF("low", "id2", "c2")
    kinds = F.array_position(F.array(*[F.lit(k) for k in ("PERSON", "ORGANIZATION", "LOCATION", "OTHER")]), F.col("kind"))
    by_key = entities.where(kinds > 0).groupBy(F.col("key").alias("norm")).agg(F.min_by("entity_id", kinds).alias("id3"))
    lows = refs.select("low").distinct().withColumn("norm", collapsed(nfkc("low")))
    found = lows.join(by_name, "low", "left").join(by_alias, "low", "left").join(by_key, "norm", "left")
    known = found.select("low", F.coalesce("id1", "id2", "id3").alias("id"), F.when(F.col("id1").isNotNull(), F.col("c1")).when(F.col("id2").isNotNull(), F.col("c2")).when(F.col("id3").isNotNull(), 0.9).alias("conf"))
    # what is left is compared, form by form, with all that share a letter and whose length leaves room for such a score
    forms = entities.select("entity_id", "salience", F.explode(F.array_union(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("form")).where("form is not null").select("entity_id", "salience", F.lower("form").alias("form")).distinct()
    rest = known.where("id is null").select("low")
    letters = lambda c: F.array_distinct(F.split(c, ""))
    near = rest.select("low", F.explode(letters(F.col("low"))).alias("letter")).join(forms.select("entity_id", "salience", "form", F.explode(letters(F.col("form"))).alias("letter")), "letter").where("letter <> ''").select("low", "entity_id", "salience", "form").distinct()
    near = near.where(F.least(F.length("low"), F.length("form")) >= least_share(config.fuzzy_threshold) * F.greatest(F.length("low"), F.length("form")) - 1e-9).withColumn("score", jaro_winkler("low", "form")).where(F.col("score") >= config.fuzzy_threshold)
    fuzzy = near.groupBy("low").agg(F.max_by(F.struct("entity_id", "score"), F.struct("score", F.coalesce("salience", F.lit(-1.0)))).alias("m")).select("low", F.col("m.entity_id").alias("id4"), (0.8 * F.col("m.score")).alias("c4"))
    settled = known.join(fuzzy, "low", "left").select("low", F.coalesce("id", "id4").alias("known_id"), F.coalesce("conf", "c4").alias("known_conf"))
    joined = candidates.withColumn("low", F.when(F.col("object_kind") == "entity", F.lower(F.trim("object")))).join(settled, "low", "left")
    new = (F.col("object_kind") == "entity") & F.col("known_id").isNull()
    seen = F.row_number().over(Window.partitionBy("low", new).orderBy("message_id", "start"))
    made = entity_id("entity", "OTHER", F.col("low"))
    return joined.withColumn("seen", F.when(new, seen)).select(
        *candidates.columns,
        F.when(new, made).otherwise(F.col("known_id")).alias("object_entity"),
        F.when(F.col("object_kind") == "entity", 4).alias("object_tier"),
        F.when(new, F.when(F.col("seen") == 1, 0.5).otherwise(0.95)).otherwise(F.col("known_conf")).alias("object_conf"),
    )


def corroborated(assertions: DataFrame, config: AssertionConfig = AssertionConfig()) -> DataFrame:
    """assertions with corroborated: an assistant's statement that a user made too, at most so many messages before.

    Predicates may differ a little; objects, subjects and conversations may not.
    """
    before = Window.partitionBy("conversation_id", "subject", "object_signature").orderBy("order_index").rangeBetween(-config.corroboration_window, -1)

    @F.pandas_udf("boolean")
    def alike(predicate: pd.Series, said: pd.Series) -> pd.Series:
        return pd.Series([any(jaro_winkler_of(p, x) >= config.predicate_similarity for x in some) for p, some in zip(predicate, said, strict=True)], dtype="bool")

    # what users said of it in the messages before: few predicates a row
    heard = assertions.withColumn("_said", F.when(F.col("role") == "assistant", F.collect_set(F.when(F.col("role") == "user", F.col("predicate"))).over(before)).otherwise(F.array().cast("array<string>")))
    exact = F.array_contains("_said", F.col("predicate"))
    rest = F.when(exact, F.array().cast("array<string>")).otherwise(F.col("_said"))
    return heard.withColumn("corroborated", exact | alike("predicate", rest)).drop("_said")


def grounded(messages: DataFrame, candidates: DataFrame, entities: DataFrame, owner: str | None = None, config: AssertionConfig = AssertionConfig()) -> DataFrame:
    """Assertions with subject, object, signature, keys and the three confidences.

    The subject is SELF, of all messages together or of each value of the owner column.
    """
    objects = resolved_objects(validated(candidates), entities, config)
    rows = objects.join(messages.select("message_id", "conversation_id", "role", "order_index", "created_at"), "message_id")
    whose = F.lit("__SELF__") if owner is None else F.concat(F.lit("__SELF__:"), F.col(owner).cast("string"))
    signature = F.when(F.col("object_entity").isNotNull(), F.concat(F.lit("E:"), "object_entity")).when(F.col("object").isNotNull(), literal_signature(F.col("object_kind"), F.col("object"))).otherwise("N:__NONE__")
    rows = rows.withColumn("subject", entity_id("entity", "PERSON", whose)).withColumn("object_signature", signature)
    key = entity_id("assertion_key", F.col("message_id"), F.col("subject"), F.col("predicate"), F.col("object_signature"), F.col("start"), F.col("modality"), F.col("polarity"))
    rows = rows.withColumn("assertion_id", key).withColumn("fact_key", entity_id("fact", F.col("subject"), F.col("predicate"), F.col("object_signature")))
    rows = corroborated(rows, config)
    ground = grounding(F.lit(1.0), F.lit(1), F.col("object_conf"), F.col("object_tier"), config)
    return rows.withColumn("grounding", ground).withColumn("final", final_confidence(F.col("confidence"), F.col("grounding"), F.col("role"), F.col("corroborated"), config))


def keep_highest(assertions: DataFrame, config: AssertionConfig = AssertionConfig()) -> DataFrame:
    """One row an assertion_id: the first, with the confidence that later ones raised by more than the margin, in order of message and start."""
    order = F.struct("message_id", "start", "final", "grounding")
    folded = assertions.groupBy("assertion_id").agg(F.array_sort(F.collect_list(order)).alias("all"))
    best = F.aggregate("all", F.element_at("all", 1), lambda b, x: F.when(x["final"] > b["final"] + config.keep_margin, x).otherwise(b))
    firsts = assertions.withColumn("rank", F.row_number().over(Window.partitionBy("assertion_id").orderBy("message_id", "start"))).where("rank = 1").drop("rank", "final", "grounding")
    return firsts.join(folded.select("assertion_id", best["final"].alias("final"), best["grounding"].alias("grounding")), "assertion_id")


def retraction_targets(found: DataFrame, messages: DataFrame, assertions: DataFrame, config: AssertionConfig = AssertionConfig()) -> DataFrame:
    """Retractions with target_id and target_fact: the latest user assertion of the conversation within the window before."""
    placed = found.join(messages.select("message_id", "conversation_id", "order_index"), "message_id").withColumn("retraction_id", entity_id("retraction", F.col("message_id"), F.col("start"), F.col("kind")))
    users = assertions.where("role = 'user'").select("conversation_id", "order_index", F.lit(None).cast("string").alias("retraction_id"), F.struct(F.col("order_index").alias("at"), "assertion_id", "fact_key").alias("said"))
    both = users.unionByName(placed.select("conversation_id", "order_index", "retraction_id"), allowMissingColumns=True)
    before = Window.partitionBy("conversation_id").orderBy("order_index").rangeBetween(-config.retraction_window, -1)
    latest = both.withColumn("t", F.max("said").over(before)).where("retraction_id is not null and t is not null")
    latest = latest.select("retraction_id", F.col("t.assertion_id").alias("target_id"), F.col("t.fact_key").alias("target_fact")).distinct()
    return placed.join(latest, "retraction_id", "left")


def predicates(assertions: DataFrame) -> DataFrame:
    """predicate_id, label, first_seen and count of every predicate."""
    label = collapsed(F.col("predicate"))
    return assertions.groupBy(label.alias("label")).agg(F.min("created_at").alias("first_seen"), F.count(F.lit(1)).alias("assertions")).select(entity_id("predicate", F.col("label")).alias("predicate_id"), "label", "first_seen", "assertions")


def qualified(candidates: DataFrame, times: DataFrame) -> DataFrame:
    """candidates (message_id, qualifier: a surface or null) with qualifier_start: the time mention of that surface in the message, the surest, then first."""
    best = times.groupBy("message_id", F.col("surface").alias("qualifier")).agg(F.min(F.struct((-F.col("confidence")).alias("less"), F.col("start"))).alias("_t"))
    joined = candidates.join(best, ["message_id", "qualifier"], "left")
    return joined.select(*candidates.columns, F.col("_t.start").alias("qualifier_start"))


def supersede_retracted(assertions: DataFrame, targets: DataFrame) -> DataFrame:
    """assertions with supersession: retraction where a full retraction (kind, target_id) names them, no replacement."""
    named = targets.where("kind = 'full' and target_id is not null").select(F.col("target_id").alias("assertion_id")).distinct().withColumn("supersession", F.lit("retraction"))
    return assertions.join(named, "assertion_id", "left")
