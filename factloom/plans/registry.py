"""The engine's registered queries and their oracle SQL."""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from factloom.plans import detail_oracles, details, oracles
from factloom.plans import queries as own


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship query: active statements, newest first."""
    return own.qry02_active_facts(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Query name to function of (spark, sf_dir)."""
    return {name: f for module in (own, details) for name, f in inspect.getmembers(module, inspect.isfunction) if f.__module__ == module.__name__ and not name.startswith("_")}


def oracle_sql() -> dict[str, str]:
    """Query name to DuckDB SQL."""
    return oracles.ORACLES | detail_oracles.ORACLES
