"""Rules and term lists from files."""

from __future__ import annotations

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RULE = "rule_id int, predicate string, subject_type string, functional boolean, policy string"


def _text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def rules(spark: SparkSession, path: str, predicates: DataFrame | None = None) -> DataFrame:
    """Invalidation rules of a YAML file and the default rule; with predicates (label), those of unknown labels are left out."""
    listed = (yaml.safe_load(_text(spark, path)) or {}).get("rules") or []
    rows = [(i, r.get("predicate_label"), r.get("subject_entity_type") or "*", bool(r.get("is_functional", False)), r.get("invalidation_policy")) for i, r in enumerate(listed, 1)]
    found = spark.createDataFrame(rows, RULE)
    if predicates is not None:
        found = found.join(predicates.select(F.col("label").alias("predicate")), "predicate", "left_semi").select("rule_id", "predicate", "subject_type", "functional", "policy")
    return found.unionByName(spark.createDataFrame([(0, None, "*", False, "none")], RULE))


def denylist(spark: SparkSession, path: str) -> list[str]:
    """Terms of a file, one a line, lines that begin with # left out."""
    lines = spark.read.text(path).select(F.lower(F.trim("value")).alias("term")).where("term <> '' and not term like '#%'")
    return [r.term for r in lines.distinct().orderBy("term").collect()]


def section(spark: SparkSession, path: str, name: str) -> dict:
    """One section of a YAML file ({} if it has none)."""
    return (yaml.safe_load(_text(spark, path)) or {}).get(name) or {}
