"""Named queries with their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gaugeworks.bindings.tables import tidy

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, binary: bool = False):
    """Register ``(spark, sf_dir) -> DataFrame`` under a name, output tidied."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return tidy(build(spark, sf_dir), binary)

        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
