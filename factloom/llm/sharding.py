"""Two-pass external shuffle into shards.

Pass one scatters the rows uniformly into memory-sized buckets by a seeded
hash; pass two runs Spark's own Fisher-Yates ``shuffle`` over each bucket. The
buckets, laid end to end, are the shuffled order; shards are its equal slices,
so their row counts are at most one apart (the law is ``rows``).

Only one bucket is ever held by a task, the offsets of the buckets come from
prefix sums in two levels, and the text crosses the network once. The same rows
in the same number of buckets give the same order, whichever task is run again.

The hash is of the whole row; rows that are equal in every column are counted
first, and each copy is scattered by its own number, so that they fall into all
buckets like any others. Null ids and null texts are values like others; null
text has size 1 and CRC 0. Ties cannot arise: every row has its own place. An
empty table gives an empty one. Input columns named like an output column
(shard, slot) are replaced; columns must be of types that can be ordered (no
maps).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LAW = "rows"
BLOCK = 1 << 12  # buckets whose offsets are summed together
COPIES = 1 << 10  # copies of one row that one task makes
SMALL_ROWS = 1 << 18  # rows of two numbers that may be broadcast (about 8 MB)


def text_size(text):
    """UTF-8 bytes of the text (null: none) plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def _numbered(docs: DataFrame, seed: int) -> DataFrame:
    """record (the row as a struct) and _hash, another one for each copy of rows that are equal in all columns."""
    columns = [F.col(c) for c in docs.columns]
    nulls = F.concat(*[F.when(c.isNull(), "0").otherwise("1") for c in columns])
    keys = [F.xxhash64(F.lit(salt), nulls, *columns) for salt in (seed, seed + 1)]
    keyed = docs.select(F.struct(*columns).alias("record"), keys[0].alias("_hash"), keys[1].alias("_other"))
    several = keyed.groupBy("_hash", "_other").agg(F.count(F.lit(1)).alias("_copies")).where("_copies > 1").select("_hash", "_other")
    found = several.count()
    if not found:
        return keyed.select("record", "_hash")
    several = F.broadcast(several) if found <= SMALL_ROWS else several
    once = keyed.join(several, ["_hash", "_other"], "left_anti").select("record", "_hash")
    groups = keyed.join(several, ["_hash", "_other"], "left_semi").groupBy("_hash", "record").agg((F.count(F.lit(1)) - 1).alias("_last"))
    # copies are made in two steps, so that no task makes all of one row
    parts = groups.select("*", F.explode(F.sequence(F.lit(0), F.expr(f"_last div {COPIES}"))).alias("_part")).repartition("_hash", "_part")
    copies = parts.select("record", "_hash", F.explode(F.sequence(F.col("_part") * COPIES, F.least("_last", F.col("_part") * COPIES + COPIES - 1))).alias("_copy"))
    return once.unionByName(copies.select("record", F.xxhash64("_hash", "_copy").alias("_hash")))


def shuffle_into_shards(docs: DataFrame, n_shards: int = 8, seed: int = 20240229, bucket_bytes: int = 8 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs with shard (0 to n_shards - 1) and slot (gapless from 0 in each shard)."""
    docs = docs.select(*[c for c in docs.columns if c.lower() not in ("shard", "slot")])
    total, rows = docs.agg(F.coalesce(F.sum(text_size(F.col(text_col))), F.lit(0)), F.count(F.lit(1))).first()
    buckets = max(1, math.ceil(total / bucket_bytes))
    scattered = _numbered(docs, seed).select(F.pmod("_hash", F.lit(buckets)).alias("bucket"), F.struct("_hash", "record").alias("record"))

    # prefix sums within blocks of buckets, then over the blocks, of which there are few
    counts = scattered.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).withColumn("block", F.expr(f"bucket div {BLOCK}"))
    ahead = Window.rowsBetween(Window.unboundedPreceding, -1)
    inside = counts.select("bucket", "block", F.coalesce(F.sum("n").over(ahead.partitionBy("block").orderBy("bucket")), F.lit(0)).alias("inside"))
    blocks = counts.groupBy("block").agg(F.sum("n").alias("n"))
    blocks = blocks.select("block", F.coalesce(F.sum("n").over(ahead.orderBy("block")), F.lit(0)).alias("before"))
    offsets = inside.join(blocks, "block").select("bucket", (F.col("before") + F.col("inside")).alias("offset"))

    # one bucket is a row from here on; sorted before the shuffle, so that a task run again repeats it
    held = scattered.repartition(buckets, "bucket").groupBy("bucket").agg(F.array_sort(F.collect_list("record")).alias("records"))
    held = held.join(offsets, "bucket").sortWithinPartitions("bucket")
    placed = held.select("offset", F.posexplode(F.shuffle("records", F.lit(seed))).alias("at", "record"))
    whole = max(rows, 1)
    placed = placed.select((F.col("offset") + F.col("at")).cast("long").alias("_place"), F.col("record.record").alias("row")).withColumn("_shard", F.expr(f"_place * {n_shards} div {whole}"))
    # the first place of a shard is the least p with p * n_shards div rows = shard
    first = F.expr(f"(_shard * {whole} + {n_shards - 1}) div {n_shards}")
    return placed.select("row.*", F.col("_shard").cast("int").alias("shard"), (F.col("_place") - first).alias("slot"))


def write_shards(sharded: DataFrame, path: str, rows_per_chunk: int = 1 << 18) -> None:
    """Folders of Parquet by shard and chunk (runs of slots), in slot order within each; chunks are written side by side."""
    chunked = sharded.withColumn("chunk", F.expr(f"slot div {rows_per_chunk}"))
    chunked.repartition("shard", "chunk").sortWithinPartitions("shard", "chunk", "slot").write.partitionBy("shard", "chunk").parquet(path)


def digest(sharded: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of what shuffle_into_shards() returns."""
    return sharded.select(
        F.col(id_col).alias("doc_id"),
        text_size(F.col(text_col)).alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
