"""Order and shape of conversations: tree paths, order, context windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.session import cut


def tree_paths(messages: DataFrame) -> DataFrame:
    """messages with tree_path: 1-based ranks among siblings (by message_id), six digits each, joined by dots.

    A message whose parent is missing is a root; messages of a cycle become
    further roots, at their least message_id. Rounds grow with the logarithm of
    the depth.
    """
    ids = messages.select("conversation_id", F.col("message_id").alias("parent_id"), F.lit(True).alias("known"))
    linked = messages.join(ids, ["conversation_id", "parent_id"], "left").withColumn("up", F.when(F.col("known"), F.col("parent_id")))
    ranks = Window.partitionBy("conversation_id", "up").orderBy("message_id")
    step = F.lpad(F.row_number().over(ranks).cast("string"), 6, "0")
    walked = cut(linked.select("conversation_id", "message_id", "up", step.alias("tree_path")))
    # each round joins a message's path to that of the ancestor it reaches so far: twice as far every time
    open_ = walked.where("up is not null").count()
    while open_:
        above = walked.select("conversation_id", F.col("message_id").alias("up"), F.col("up").alias("next"), F.col("tree_path").alias("ahead"))
        longer = walked.where("up is not null").join(above, ["conversation_id", "up"]).select("conversation_id", "message_id", F.col("next").alias("up"), F.concat_ws(".", "ahead", "tree_path").alias("tree_path"))
        walked = cut(walked.where("up is null").unionByName(longer))
        left = walked.where("up is not null").count()
        if left == open_:
            break  # what no round resolves hangs on a cycle
        open_ = left
    walked = walked.where("up is null").drop("up")
    joined = messages.join(walked, ["conversation_id", "message_id"], "left")
    roots = F.max(F.when(F.col("tree_path").isNotNull() & ~F.col("tree_path").contains("."), F.col("tree_path").cast("int"))).over(Window.partitionBy("conversation_id"))
    stray = F.row_number().over(Window.partitionBy("conversation_id", F.col("tree_path").isNull()).orderBy("message_id"))
    return joined.withColumn("tree_path", F.coalesce("tree_path", F.lpad((F.coalesce(roots, F.lit(0)) + stray).cast("string"), 6, "0")))


def ordered(messages: DataFrame) -> DataFrame:
    """messages with order_index: 0-based by (tree_path, message_id) in each conversation."""
    return messages.withColumn("order_index", F.row_number().over(Window.partitionBy("conversation_id").orderBy("tree_path", "message_id")) - 1)


def eligible(messages: DataFrame, min_chars: int = 10) -> DataFrame:
    """User and assistant messages of enough characters."""
    return messages.where(F.col("role").isin("user", "assistant") & (F.length("text") >= min_chars))


def with_context(messages: DataFrame, k: int = 5) -> DataFrame:
    """messages with context: the message_ids of up to k messages with text before each, oldest first."""
    before = Window.partitionBy("conversation_id").orderBy("order_index").rowsBetween(-k, -1)
    texts = messages.where(F.col("text").isNotNull())
    return texts.withColumn("context", F.collect_list("message_id").over(before))
