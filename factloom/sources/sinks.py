"""Tables written whole: staged beside their place and moved there once complete; runs recorded."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions.ids import entity_id


def replace_table(rows: DataFrame, path: str) -> None:
    """rows in the place of whatever lies at path; a run that fails leaves the old table as it was."""
    spark = rows.sparkSession
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    rows.write.parquet(staged)
    jvm = spark._jvm
    old, new = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(staged)
    files = new.getFileSystem(spark._jsc.hadoopConfiguration())
    # the old table is moved aside and only deleted once the new one stands in its place
    aside = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")
    held = files.exists(old)
    if held and not files.rename(old, aside):
        raise OSError(f"could not move {path} aside; the new table is at {staged}")
    if not files.rename(new, old):
        if held:
            files.rename(aside, old)
        raise OSError(f"could not move {staged} to {path}")
    if held:
        files.delete(aside, True)


def require_tables(spark: SparkSession, folder: str, *tables: str) -> None:
    """Raises for tables that are not there."""
    jvm = spark._jvm
    missing = []
    for table in tables:
        where = jvm.org.apache.hadoop.fs.Path(f"{folder}/{table}.parquet")
        if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
            missing.append(table)
    if missing:
        raise FileNotFoundError(f"missing tables: {', '.join(missing)}")


def run_record(spark: SparkSession, stage: str, as_of: str, stats: DataFrame) -> DataFrame:
    """run_id, stage, as_of and stats_json of one run; stats has one row."""
    return stats.select(entity_id("run", stage, as_of).alias("run_id"), F.lit(stage).alias("stage"), F.lit(as_of).alias("as_of"), F.to_json(F.struct("*")).alias("stats_json"))


def next_version(builds: DataFrame) -> DataFrame:
    """version: one more than the greatest build_version, 1 where there is none."""
    return builds.agg((F.coalesce(F.max("build_version"), F.lit(0)) + 1).alias("version"))
