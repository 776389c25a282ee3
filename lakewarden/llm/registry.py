"""The queries of this subpackage and the SQL of those that SQL can say."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MODULES = (
    "mixing", "byte_bpe", "secrets", "substring_dedup", "suffix_dedup", "simhash",
    "exact_dedup", "neighbours", "pii", "toxicity", "quality", "centroids", "conversations", "pipeline",
)


def _gather(name: str) -> dict:
    out: dict = {}
    for module in MODULES:
        out |= getattr(importlib.import_module(f"lakewarden.llm.{module}"), name)
    return out


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _gather("QUERIES")


def oracles() -> dict[str, str]:
    return _gather("ORACLES")
