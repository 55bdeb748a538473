"""What mattered when: windows, member salience, categories and clusters of focal subjects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.config import ProfileConfig
from factloom.functions.scores import evergreen, window_salience
from factloom.functions.times import window_end, window_label, window_start

# Categories in their order, with the words that vote for them and the modality that does.
CATEGORIES = {
    "project": (("project", "build", "launch"), "fact"),
    "interest": (("like", "interest", "view"), "preference"),
    "problem": (("problem", "error", "issue"), "question"),
    "task": (("task", "todo", "click"), None),
    "desire": (("want", "wish", "purchase"), None),
    "plan": (("plan", "intend", "signup"), "intention"),
}


def focal(facts: DataFrame, configured: Column | None = None) -> DataFrame:
    """The configured subject, or the one of most facts (ties to the least id): one row."""
    if configured is not None:
        return facts.where(F.col("subject_id") == configured).select("subject_id").limit(1)
    return facts.groupBy("subject_id").count().orderBy(F.desc("count"), "subject_id").limit(1).select("subject_id")


def windows(facts: DataFrame, config: ProfileConfig = ProfileConfig()) -> DataFrame:
    """subject_id, window_start, window_end, label, window_index, previous and facts of every window with enough facts."""
    at = F.coalesce("valid_from", "asserted_at")
    dated = facts.where(at.isNotNull()).select("subject_id", window_start(config.granularity, at).alias("window_start"))
    counted = dated.groupBy("subject_id", "window_start").agg(F.count(F.lit(1)).alias("facts")).where(F.col("facts") >= config.min_assertions)
    order = Window.partitionBy("subject_id").orderBy("window_start")
    return counted.select("subject_id", "window_start", window_end(config.granularity, F.col("window_start")).alias("window_end"), window_label(config.granularity, F.col("window_start")).alias("label"), (F.row_number().over(order) - 1).alias("window_index"), F.lag("window_start").over(order).alias("previous"), "facts")


def overlapping(facts: DataFrame, found: DataFrame) -> DataFrame:
    """assertion_id and window_start of every window that a fact's valid time meets (no end: for ever)."""
    spans = facts.where("valid_from is not null").select("assertion_id", "subject_id", "valid_from", "valid_to")
    met = spans.join(found.select("subject_id", "window_start", "window_end"), "subject_id")
    return met.where((F.col("valid_from") < F.col("window_end")) & (F.col("valid_to").isNull() | (F.col("valid_to") >= F.col("window_start")))).select("assertion_id", "window_start")


def members(facts: DataFrame, found: DataFrame, config: ProfileConfig = ProfileConfig()) -> DataFrame:
    """subject_id, window_start, member, mentions, salience of what facts are about in each window.

    Confidences are added up in the order of assertions, so that sums, and with
    them the ranks of members nearly as salient as each other, are the same
    wherever rows lie.
    """
    at = F.coalesce("valid_from", "asserted_at")
    rows = facts.where(at.isNotNull()).select("subject_id", window_start(config.granularity, at).alias("window_start"), F.col("object_signature").alias("member"), at.alias("at"), "confidence", "assertion_id")
    placed = rows.join(found.select("subject_id", "window_start", "window_end", F.col("facts").alias("total")), ["subject_id", "window_start"])
    days = F.greatest(F.lit(0), F.timestamp_diff("DAY", F.col("at"), F.col("window_end")))
    own = Window.partitionBy("subject_id", "window_start", "member").orderBy("assertion_id", "confidence").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = placed.select("*", (1 / (1 + config.decay * days)).alias("recent"), F.sum("confidence").over(own).alias("sum"), F.count("confidence").over(own).alias("sure"), F.count(F.lit(1)).over(own).alias("mentions"))
    last = F.max_by(F.struct("mentions", (F.col("sum") / F.col("sure")).alias("confidence"), "total"), "mentions")
    per = running.groupBy("subject_id", "window_start", "member").agg(F.max("recent").alias("recency"), last.alias("last")).select("subject_id", "window_start", "member", "recency", "last.*")
    base = window_salience(F.col("mentions"), F.col("total"), F.col("recency"), F.col("confidence"))
    spread = per.groupBy("subject_id", "member").agg(F.count(F.lit(1)).alias("member_windows"))
    all_windows = found.groupBy("subject_id").agg(F.count(F.lit(1)).alias("windows"))
    joined = per.withColumn("base", base).join(spread, ["subject_id", "member"]).join(all_windows, "subject_id")
    return joined.select("subject_id", "window_start", "member", "mentions", evergreen(F.col("base"), F.col("windows"), F.col("member_windows"), config.evergreen).alias("salience"))


def classified(facts: DataFrame, config: ProfileConfig = ProfileConfig()) -> DataFrame:
    """subject_id, window_start, member, category: most votes by predicate words and modality, ties to the first name, else unclassified."""
    at = F.coalesce("valid_from", "asserted_at")
    rows = facts.where(at.isNotNull()).select("subject_id", window_start(config.granularity, at).alias("window_start"), F.col("object_signature").alias("member"), F.lower("predicate").alias("predicate"), "modality")
    votes = []
    for name, (words, modality) in CATEGORIES.items():
        weight = sum((F.col("predicate").contains(w).cast("int") for w in words), F.lit(0))
        if modality:
            weight = weight + (F.col("modality") == modality).cast("int")
        votes.append(F.struct(F.lit(name).alias("category"), weight.alias("weight")))
    cast = rows.select("subject_id", "window_start", "member", F.explode(F.array(*votes)).alias("v")).groupBy("subject_id", "window_start", "member", "v.category").agg(F.sum("v.weight").alias("votes"))
    best = cast.groupBy("subject_id", "window_start", "member").agg(F.min(F.struct((-F.col("votes")).alias("v"), F.col("category"))).alias("b"))
    return best.select("subject_id", "window_start", "member", F.when(F.col("b.v") < 0, F.col("b.category")).otherwise("unclassified").alias("category"))


def ranked(scored: DataFrame, categories: DataFrame, config: ProfileConfig = ProfileConfig()) -> DataFrame:
    """Members with category, cluster_rank (within window and category, up to the cap) and window_rank."""
    keys = ["subject_id", "window_start"]
    rows = scored.join(categories, [*keys, "member"])
    inside = Window.partitionBy(*keys, "category").orderBy(F.desc("salience"), "member")
    overall = Window.partitionBy(*keys).orderBy(F.desc("salience"), "member")
    return rows.withColumn("cluster_rank", F.row_number().over(inside)).withColumn("window_rank", F.row_number().over(overall)).where(F.col("cluster_rank") <= config.cluster_cap)


def clusters(rows: DataFrame, found: DataFrame, config: ProfileConfig = ProfileConfig()) -> DataFrame:
    """subject_id, window_start, category, size, mean_salience, cluster_rank and evolves (the category was in the window before)."""
    keys = ["subject_id", "window_start"]
    per = rows.groupBy(*keys, "category").agg(F.count(F.lit(1)).alias("size"), F.avg("salience").alias("mean_salience"))
    per = per.join(found.select(*keys, "previous"), keys)
    before = per.select("subject_id", F.col("window_start").alias("previous"), "category", F.lit(True).alias("was"))
    joined = per.join(before, ["subject_id", "previous", "category"], "left")
    order = Window.partitionBy(*keys).orderBy(F.desc("mean_salience"), "category")
    return joined.select(*keys, "category", "size", "mean_salience", F.row_number().over(order).alias("cluster_rank"), F.coalesce("was", F.lit(False)).alias("evolves"))


def layout(rows: DataFrame, config: ProfileConfig = ProfileConfig()) -> DataFrame:
    """member, window_start, x, y, z: polar places by category and rank, height by window; no jitter."""
    names = [*CATEGORIES, "unclassified"]
    sector = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("category")) - 1
    angle = 2 * F.pi() * (sector + F.col("cluster_rank") / (config.cluster_cap + 1)) / len(names)
    radius = 1.0 / (0.1 + F.greatest(F.lit(0.0), F.col("salience")))
    height = F.dense_rank().over(Window.partitionBy("subject_id").orderBy("window_start")) - 1
    return rows.select("subject_id", "window_start", "member", (radius * F.cos(angle)).alias("x"), (radius * F.sin(angle)).alias("y"), height.alias("z"))


def evidence(facts: DataFrame, config: ProfileConfig = ProfileConfig()) -> DataFrame:
    """subject_id, window_start, member, assertion_id, evidence_rank, total and capped: the first assertions by id that speak of a member in a window, up to the cap."""
    at = F.coalesce("valid_from", "asserted_at")
    rows = facts.where(at.isNotNull()).select("subject_id", window_start(config.granularity, at).alias("window_start"), F.col("object_signature").alias("member"), "assertion_id")
    whole = Window.partitionBy("subject_id", "window_start", "member")
    placed = rows.withColumns({"evidence_rank": F.row_number().over(whole.orderBy("assertion_id")) - 1, "total": F.count(F.lit(1)).over(whole)})
    return placed.where(F.col("evidence_rank") < config.evidence_cap).withColumn("capped", F.col("total") > config.evidence_cap)
