"""Small Column builders shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

# Severity order, lowest first.
SEVERITIES = ("low", "medium", "high", "critical")


def severity_rank(col: Column) -> Column:
    """1 (low) to 4 (critical); 0 for anything else."""
    return lookup(col, {name: i + 1 for i, name in enumerate(SEVERITIES)}, 0)


def lookup(key: Column, table: Mapping, default) -> Column:
    """Constant map lookup as one expression, without a join."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def ladder(value: Column, steps: Sequence[tuple[float, str]], otherwise: str | None) -> Column:
    """Name of the first step whose bound the value exceeds; steps go from high to low."""
    out = None
    for bound, name in steps:
        cond = value > F.lit(bound)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(F.lit(otherwise))


def ladder_at_least(value: Column, steps: Sequence[tuple[float, str]], otherwise: str | None) -> Column:
    out = None
    for bound, name in steps:
        cond = value >= F.lit(bound)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(F.lit(otherwise))


def micros(ts: Column) -> Column:
    """Epoch microseconds, also for timestamps without zone (session zone UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def seconds_between(start: Column, end: Column) -> Column:
    return (micros(end) - micros(start)) / F.lit(1_000_000.0)


def ntz(value: datetime | str) -> Column:
    """Literal timestamp without zone."""
    return F.lit(str(value)).cast("timestamp_ntz")


def moment(df: DataFrame, ts: str, at, seconds: int = 0) -> Column:
    """Literal of the column's own type, so that a comparison with the bare column reaches the reader."""
    value = datetime.fromisoformat(str(at)) + timedelta(seconds=seconds)
    return F.lit(str(value)).cast(df.schema[ts].dataType)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0.0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def clamp(value: Column, low: float = 0.0, high: float = 100.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def advice_list(*items: tuple[Column, Column | str]) -> Column:
    """Texts whose condition holds, in the given order."""
    return F.array_compact(
        F.array(*[F.when(cond, F.lit(text) if isinstance(text, str) else text) for cond, text in items])
    )


def one_row(*parts: DataFrame) -> DataFrame:
    """Results of one row each as one row, without a join."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out.agg(*[F.max(c).alias(c) for c in out.columns])
