"""Registry of named queries and their independent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wide_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table, spread over all cores for costly row work."""
    return spread(table(spark, sf_dir, name).select(*columns))


def joined(array: Column) -> Column:
    """Array as text, so that results compare the same everywhere."""
    return F.array_join(array.cast("array<string>"), ";")


def sql_list(values) -> str:
    """SQL list literal of strings."""
    return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"
