"""Chat exports in JSON: conversations, messages and their parts.

The whole file is one value; conversations are its elements (or the file itself,
or what stands under conversations, data or items). Messages lie in a map from
node id to node; nodes without a message, or whose message has no content, are
dropped. Text parts are joined by an empty line, with the place of each kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions.ids import entity_id, number, uuid5
from factloom.functions.times import from_any

ROLES = ("user", "assistant", "system", "tool")


def pointer_path(pointer: str) -> str:
    """A JSON pointer as a variant path."""
    if pointer == "":
        return "$"
    steps = [s.replace("~1", "/").replace("~0", "~") for s in pointer.lstrip("/").split("/")]
    return "$" + "".join(f"[{s}]" if s.isdigit() else f"['{s}']" for s in steps)


def normal_role(role: Column) -> Column:
    """A known role in lower case, or unknown."""
    low = F.lower(role)
    return F.when(low.isin(*ROLES), low).otherwise("unknown")


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """One row a conversation: its value as a variant."""
    whole = spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("root"))
    for place in ("conversations", "data", "items"):
        whole = whole.withColumn("root", F.coalesce(F.try_variant_get("root", f"$.{place}", "variant"), "root"))
    as_list = F.when(F.schema_of_variant("root").startswith("ARRAY"), F.col("root").cast("array<variant>")).otherwise(F.array("root"))
    return whole.select(F.explode(as_list).alias("conversation"))


def _get(value: str | Column, path: str, kind: str) -> Column:
    return F.try_variant_get(value, path, kind)


def conversations(exports: DataFrame, zone: str = "Europe/Berlin") -> DataFrame:
    """conversation_id, export_id, title, created_at, updated_at and the value."""
    export_id = F.coalesce(_get("conversation", "$.conversation_id", "string"), _get("conversation", "$.id", "string"))
    return exports.select(
        entity_id("conversation", export_id).alias("conversation_id"),
        export_id.alias("export_id"),
        _get("conversation", "$.title", "string").alias("title"),
        from_any(_get("conversation", "$.create_time", "string"), zone).alias("created_at"),
        from_any(_get("conversation", "$.update_time", "string"), zone).alias("updated_at"),
        "conversation",
    )


def messages(convs: DataFrame) -> DataFrame:
    """message_id, conversation_id, node_id, parent_id, role, created_at, timestamp_quality and content of messages that have content."""
    convs.createOrReplaceTempView("_factloom_conversations")
    nodes = convs.sparkSession.sql("SELECT c.conversation_id, c.export_id, n.key AS node_key, n.value AS node FROM _factloom_conversations c, LATERAL variant_explode(try_variant_get(c.conversation, '$.mapping', 'variant')) AS n")
    found = nodes.select(
        "conversation_id",
        "export_id",
        F.coalesce(_get("node", "$.message.id", "string"), _get("node", "$.id", "string"), "node_key").alias("node_id"),
        _get("node", "$.parent", "string").alias("parent_node"),
        normal_role(_get("node", "$.message.author.role", "string")).alias("role"),
        from_any(_get("node", "$.message.create_time", "string")).alias("created_at"),
        _get("node", "$.message.content", "variant").alias("content"),
    ).where(F.col("content").isNotNull() & (F.schema_of_variant("content") != "VOID"))
    own = entity_id("message", F.col("export_id"), F.col("node_id"))
    parent = F.when(F.col("parent_node").isNotNull(), entity_id("message", F.col("export_id"), F.col("parent_node")))
    quality = F.when(F.col("created_at").isNull(), "imputed_prior").otherwise("original")
    return found.select(own.alias("message_id"), "conversation_id", "node_id", parent.alias("parent_id"), "role", "created_at", quality.alias("timestamp_quality"), "content")


def parts(found: DataFrame) -> DataFrame:
    """part_id, message_id, part_index, part_type, text, mime_type, file_path of every part of a message's content."""
    shape = F.schema_of_variant("content")
    listed = F.when(shape.startswith("ARRAY"), F.col("content").cast("array<variant>")).when(shape == "STRING", F.array("content")).otherwise(F.coalesce(_get("content", "$.parts", "array<variant>"), F.array("content")))
    rows = found.select("message_id", "content", F.posexplode(listed).alias("part_index", "part"))
    plain = F.schema_of_variant("part") == "STRING"
    kind = F.lower(F.coalesce(_get("part", "$.content_type", "string"), _get("part", "$.type", "string"), _get("content", "$.content_type", "string"), F.lit("text")))
    text = F.when(plain, F.col("part").cast("string")).otherwise(F.coalesce(*[_get("part", f"$.{k}", "string") for k in ("text", "content", "value")]))
    mime, path = _get("part", "$.mime_type", "string"), F.coalesce(_get("part", "$.file_path", "string"), _get("part", "$.asset_pointer", "string"))
    named = (
        F.when(plain | kind.isin("text", "multimodal_text", "thoughts"), "text")
        .when(kind.contains("image"), "image")
        .when(kind.isin("tool_call", "code"), "tool_call")
        .when(kind.isin("tool_result", "execution_output"), "tool_result")
        .when(mime.isNotNull() | path.isNotNull(), "file")
        .when(text.isNotNull(), "text")
        .otherwise("other")
    )
    part_id = uuid5(F.concat(F.lit('["part","'), F.col("message_id"), F.lit('",'), number(F.col("part_index")), F.lit("]")))
    return rows.select(part_id.alias("part_id"), "message_id", "part_index", named.alias("part_type"), text.alias("text"), mime.alias("mime_type"), path.alias("file_path"))


def assembled(found: DataFrame, all_parts: DataFrame) -> DataFrame:
    """messages with text, content_type, text_map (start and end of each part) and attachments."""
    kept = F.filter(F.array_sort(F.collect_list(F.struct("part_index", "text"))), lambda p: p["text"].isNotNull() & (p["text"] != ""))
    per = all_parts.groupBy("message_id").agg(kept.alias("kept"), F.count_if(F.col("mime_type").isNotNull() | F.col("file_path").isNotNull()).cast("int").alias("attachments"), F.count(F.lit(1)).alias("n"))
    texts = F.transform("kept", lambda p: p["text"])
    spans = F.aggregate(
        texts,
        F.array().cast("array<struct<start:int,end:int>>"),
        lambda done, t: F.concat(done, F.array(F.struct((F.coalesce(F.try_element_at(done, F.lit(-1))["end"] + 2, F.lit(0))).alias("start"), (F.coalesce(F.try_element_at(done, F.lit(-1))["end"] + 2, F.lit(0)) + F.length(t)).cast("int").alias("end")))),
    )
    kind = F.when(F.size("kept") > 1, "mixed").when(F.size("kept") == 1, "text").when(F.coalesce("n", F.lit(0)) > 0, "unknown").otherwise("empty")
    return found.drop("content").join(per, "message_id", "left").select("message_id", "conversation_id", "node_id", "parent_id", "role", "created_at", "timestamp_quality", F.when(F.size("kept") > 0, F.array_join(texts, "\n\n")).alias("text"), kind.alias("content_type"), spans.alias("text_map"), F.coalesce("attachments", F.lit(0)).alias("attachments"))
