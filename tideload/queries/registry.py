"""The register of queries and the tables they read."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tideload.session import clear_staged, fresh_dir, prepare

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

_databases: list[str] = []

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables of one folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = prepare(spark)
        self.folder = folder
        self._schemas = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        path = f"{self.folder}/{name}.parquet"
        if name not in self._schemas:
            self._schemas[name] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[name]).parquet(path)

    def scratch(self, label: str) -> str:
        return fresh_dir(self.spark, label)

    def database(self) -> str:
        """A new database whose tables lie in the shared folder."""
        name = f"tideload_{uuid.uuid4().hex[:12]}"
        self.spark.sql(f"CREATE DATABASE {name} LOCATION '{self.scratch('db')}'")
        _databases.append(name)
        return name


def clear_query_data(spark: SparkSession) -> None:
    """Remove the databases and staged files of the queries run so far; their results must have been read."""
    while _databases:
        spark.sql(f"DROP DATABASE IF EXISTS {_databases.pop()} CASCADE")
    clear_staged(spark)


def query(name: str, sql: str):
    """Register a function of :class:`Tables` under ``name`` with its SQL."""

    def add(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        ORACLES[name] = sql
        return fn

    return add
