"""Register of the queries over the test tables, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagequarry.session import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with its SQL when there is one."""

    def register(function: Query) -> Query:
        name = function.__name__
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


KEYS = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id"}


def texts(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table whose texts are worked on: spread over the cores when it has few partitions."""
    return spread(table(spark, folder, name), KEYS[name])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
