"""Collects query callables and their SQL twins."""

from __future__ import annotations

import functools
import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from broadloom.session import prepare
from broadloom.sources.files import table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}
_MODULES = (
    "relational", "joins", "aggregates", "windows", "scalars", "logs", "layout", "files", "mutable", "streams", "replays", "learning",
)


class Tables:
    """Attribute access to the tables of one folder: ``t.lineitem``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)


def query(name: str, sql: str | None = None):
    """Register ``fn(t: Tables) -> DataFrame`` under ``name``."""

    def wrap(fn):
        if name in _QUERIES:
            raise ValueError(f"query {name} registered twice")

        @functools.wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(prepare(spark), folder))

        _QUERIES[name] = run
        if sql:
            _ORACLES[name] = sql.strip()
        return run

    return wrap


def _load() -> None:
    for module in _MODULES:
        importlib.import_module(f"broadloom.queries.{module}")


def registered() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
