"""Registry of named queries and the SQL that must give the same rows."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakewarden.plans.tables import Tables
from lakewarden.plans.views import with_views

MODULES = (
    "ingest", "schemas", "sync", "versions", "validation", "drift", "backup",
    "monitoring", "profiling", "health", "contracts", "scanning", "events", "streams",
)

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_oracles: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register ``fn(tables)`` under a name, with its SQL twin over the derived views."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in _queries:
            raise ValueError(f"query {name} registered twice")
        _queries[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            _oracles[name] = with_views(views, sql)
        return fn

    return register


def _load() -> None:
    for module in MODULES:
        importlib.import_module(f"lakewarden.plans.{module}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_queries)


def oracles() -> dict[str, str]:
    _load()
    return dict(_oracles)
