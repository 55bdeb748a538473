"""A SparkSession with the settings that the engine relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def session(app: str = "factloom", master: str | None = None, **settings: str) -> SparkSession:
    """Times in UTC, adaptive execution on, recursion deep enough for long threads."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.cteRecursionLevelLimit", "100000")
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def cut(rows):
    """The same rows, checkpointed in the folder that spark.checkpoint.dir names; where that is unset on a local master, in a temporary one."""
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = rows.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="factloom-"))
    return rows.checkpoint()
