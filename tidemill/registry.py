"""Named queries, each beside the SQL that must give the same rows."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemill.session import ship_package, size_shuffles, size_states
from tidemill.tables import Tables

MODULES = (
    "projections",
    "joins",
    "aggregates",
    "windows",
    "ordering",
    "nulls",
    "scalars",
    "udfs",
    "partitioning",
    "storage",
    "analyses",
    "streams",
    "models",
    "checks",
    "blocked",
)


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    oracle: str | None

    def __call__(self, spark: SparkSession, root: str) -> DataFrame:
        size_shuffles(spark, root)
        size_states(spark, root)
        ship_package(spark)
        return self.build(Tables(spark, root))


_QUERIES: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} registered twice")
        _QUERIES[name] = Query(name, build, oracle)
        return build

    return register


def all_queries() -> dict[str, Query]:
    for module in MODULES:
        importlib.import_module(f"tidemill.queries.{module}")
    return dict(_QUERIES)
