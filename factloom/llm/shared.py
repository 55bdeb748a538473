"""What several operators of this subpackage need: the shared folder, lineage cuts, tokenizer paths."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _LOCAL.setdefault("dir", "file://" + tempfile.mkdtemp(prefix="factloom-"))


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder and read again, so that later failures need not go further back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    again = spark.read.schema(df.schema).parquet(path)
    again._factloom_path = path
    return again


def drop_cut(df: DataFrame) -> None:
    """Deletes the files behind cut(); nothing may read df afterwards."""
    path = getattr(df, "_factloom_path", None)
    if path:
        jvm = df.sparkSession._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


class Cuts:
    """Cut tables that are deleted when their last reader is done."""

    def __init__(self):
        self.held: list[DataFrame] = []

    def add(self, df: DataFrame) -> DataFrame:
        """cut(df), remembered."""
        self.held.append(cut(df))
        return self.held[-1]

    def drop(self, *tables: DataFrame) -> None:
        """Deletes the files of these tables."""
        for table in tables:
            drop_cut(table)
        self.held = [t for t in self.held if not any(t is x for x in tables)]

    def keep_only(self, *tables: DataFrame) -> None:
        """Deletes the files of all remembered tables but these."""
        self.drop(*[t for t in self.held if not any(t is x for x in tables)])


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 4 MB and 2000 rows from here on: texts may be long, and a batch is held whole on both sides."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", 2000), ("spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20)):
        now = spark.conf.get(key, None)
        if now is None or not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def give_back() -> None:
    """Memory that a Python worker no longer uses goes back to the machine: idle workers keep what they once held."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        return  # another C library


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file on this machine (the same on every executor)."""
    import public_tokenizers

    return str(public_tokenizers.path(name))
