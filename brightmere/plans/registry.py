"""The queries of this library over the standard tables, each with its SQL equivalent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of one data folder, read on demand: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(self.path(name))
        return self._read[name]


def query(name: str, sql: str | None = None):
    """Register ``plan(spark, tables)`` as ``name``, with the SQL that gives the same rows."""

    def add(plan: Callable[[SparkSession, Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} exists already")
        QUERIES[name] = lambda spark, folder: plan(spark, Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return plan

    return add
