"""Registered queries over the test tables and the SQL they are checked with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without SQL only its rows are checked."""
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run
    return register


def load_all() -> None:
    from holdshort.catalog import (  # noqa: F401
        aggregates, cleaning, decoding, features, joins, models, scalars, sources, windows,
    )
