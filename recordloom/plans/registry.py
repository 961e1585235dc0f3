"""Where queries are registered, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def registered(sql: str | None = None):
    """Registers a function of a table reader under its own name, with its SQL."""

    def add(fn: Callable[[Callable[[str], DataFrame]], DataFrame]):
        QUERIES[fn.__name__] = lambda spark, sf_dir: fn(lambda name: _table(spark, sf_dir, name))
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add
