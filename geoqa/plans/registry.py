"""Query registry: name -> (Spark plan builder, DuckDB oracle SQL).

Plan builders take ``(spark, sf_dir)`` and return a DataFrame; they read the
given tables (through the fixtures) so their work grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from geoqa.plans.fixtures import with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None, ctes: tuple = ()):
    """Register a plan builder; ``oracle`` is SQL over base tables + fixtures."""
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = with_fixtures(oracle, ctes)
        return fn
    return deco
