"""Registered queries: a name, a function of (spark, folder of parquet tables), and its ANSI SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from filingweave.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(tune(spark), folder)

        QUERIES[fn.__name__] = run
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
