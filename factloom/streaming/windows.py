"""Streams of facts or events: duplicates dropped within the watermark, counts by calendar day or sliding window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The files of a table as a stream."""
    schema = spark.read.parquet(f"{sf_dir}/{table}.parquet").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", f"{table}.parquet").parquet(sf_dir)
    return rows.withColumns({c: F.col(c).cast("timestamp") for c, kind in rows.dtypes if kind == "timestamp_ntz"})


def without_duplicates(rows: DataFrame, at: str, *keys: str, delay: str = "1 hour") -> DataFrame:
    """The first row of each key within the watermark."""
    return rows.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(keys))


def daily(rows: DataFrame, at: str, *by: str, delay: str = "1 day") -> DataFrame:
    """Rows a day and value of the other columns; late rows count up to the delay."""
    return rows.withWatermark(at, delay).groupBy(F.window(at, "1 day").alias("w"), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("day"), *by, "n")


def run_once(result: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """What is there now, run to its end, as a table of the session (for results that are small)."""
    query = result.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    query.awaitTermination()
    return result.sparkSession.table(name)


def to_files(result: DataFrame, path: str, checkpoint: str):
    """An unbounded run into Parquet files, exactly once, with its progress in the checkpoint folder."""
    return result.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).start()
