"""Registry of the queries in this folder: a Spark callable and, beside it, the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function `(load) -> DataFrame` under its own name; `load(table)` reads a table."""

    def register(function):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(Tables(spark, folder))

        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLES[function.__name__] = " ".join(sql.split())
        return function

    return register


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))
