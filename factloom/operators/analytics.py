"""Overviews of messages, conversations and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def overview(messages: DataFrame) -> DataFrame:
    """One row: messages, conversations, mean and median messages a conversation."""
    per = messages.groupBy("conversation_id").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.sum("n").alias("messages"), F.count(F.lit(1)).alias("conversations"), F.avg("n").alias("mean_messages"), F.median("n").alias("median_messages"))


def by_role(messages: DataFrame) -> DataFrame:
    """role and messages, most first."""
    return messages.groupBy("role").agg(F.count(F.lit(1)).alias("messages")).orderBy(F.desc("messages"), "role")


def resampled(rows: DataFrame, at: str, unit: str) -> DataFrame:
    """bucket and rows for every unit between the first and the last, zeros included."""
    counted = rows.where(F.col(at).isNotNull()).groupBy(F.date_trunc(unit, at).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    step = {"day": "1 day", "week": "7 days", "month": "1 month"}[unit]
    every = counted.agg(F.min("bucket").alias("a"), F.max("bucket").alias("b")).where("a is not null").select(F.explode(F.sequence("a", "b", F.expr(f"interval {step}"))).alias("bucket"))
    return every.join(counted, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"))


def day_by_hour(rows: DataFrame, at: str) -> DataFrame:
    """weekday (Monday 0), hour and rows of all 168 places."""
    counted = rows.groupBy(F.weekday(at).alias("weekday"), F.hour(at).alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    spark = rows.sparkSession
    grid = spark.range(7 * 24).select(F.expr("cast(id div 24 as int)").alias("weekday"), F.expr("cast(id % 24 as int)").alias("hour"))
    return grid.join(F.broadcast(counted), ["weekday", "hour"], "left").select("weekday", "hour", F.coalesce("n", F.lit(0)).alias("n"))


def top_words(messages: DataFrame, n: int = 50, min_length: int = 3) -> DataFrame:
    """word and count of the most frequent words (letters, digits, - and _ only), ties by word."""
    words = messages.select(F.explode(F.split(F.lower("text"), r"\s+")).alias("raw")).select(F.regexp_replace("raw", r"(?U)[^\w-]", "").alias("word"))
    return words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(n)


def message_histogram(messages: DataFrame, width: int = 2) -> DataFrame:
    """bin (its least number of messages) and conversations."""
    per = messages.groupBy("conversation_id").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy((F.floor(F.col("n") / width) * width).alias("bin")).agg(F.count(F.lit(1)).alias("conversations"))


def grouped_titles(rows: DataFrame, project: Column, at: str, top: int = 3) -> DataFrame:
    """project, rows, first_at, last_at, and items (id, rank, project total) of the top rows of each project by size."""
    named = rows.withColumn("project", project).where(F.col("project").isNotNull())
    totals = named.groupBy("project").agg(F.count(F.lit(1)).alias("items"), F.sum("size").alias("total"), F.min(at).alias("first_at"), F.max(at).alias("last_at"))
    best = Window.partitionBy("project").orderBy(F.desc("size"), "id")
    heads = named.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("project", "id", "size", "rank")
    return heads.join(totals, "project").select("project", "id", "size", "rank", "items", "total", "first_at", "last_at")


def shares(rows: DataFrame, *by: str) -> DataFrame:
    """by columns, n and share of all rows."""
    counted = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.sum("n").alias("total"))
    return counted.join(F.broadcast(total)).select(*by, "n", (F.col("n") / F.col("total")).alias("share"))


def word_counts(messages: DataFrame) -> DataFrame:
    """message_id, chars and words of every message."""
    text = F.coalesce("text", F.lit(""))
    words = F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))
    return messages.select("message_id", F.length(text).alias("chars"), words.alias("words"))


def quality_report(facts: DataFrame) -> DataFrame:
    """One row: counts of facts, dated, active and superseded ones, span of time and mean confidence."""
    return facts.agg(
        F.count(F.lit(1)).alias("facts"),
        F.count_if(F.col("valid_from").isNotNull()).alias("dated"),
        F.count_if(F.col("status") == "active").alias("active"),
        F.min("valid_from").alias("first_at"),
        F.max("valid_from").alias("last_at"),
        F.count_distinct("subject_id").alias("subjects"),
        F.avg("confidence").alias("mean_confidence"),
    )


def stage_counts(messages: DataFrame) -> DataFrame:
    """One row: conversations, messages and their characters, 0 where there are none."""
    chars = F.coalesce(F.sum(F.length(F.coalesce("text", F.lit("")))), F.lit(0))
    return messages.agg(F.count_distinct("conversation_id").alias("conversations"), F.count(F.lit(1)).alias("messages"), chars.alias("chars"))


def tier_histogram(assertions: DataFrame, sides: dict[str, str]) -> DataFrame:
    """side, tier, n and mean_grounding: assertions by the detector tier of each side (name to column), unknown tiers left out."""
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(c).cast("int").alias("tier")) for s, c in sides.items()])).alias("x")
    return assertions.select("grounding", each).where("x.tier is not null").groupBy("x.side", "x.tier").agg(F.count(F.lit(1)).alias("n"), F.avg("grounding").alias("mean_grounding"))
