"""Named queries over the given tables, each with its SQL twin where SQL can say it."""

from lakewarden.plans.registry import oracles, queries

__all__ = ["oracles", "queries"]
