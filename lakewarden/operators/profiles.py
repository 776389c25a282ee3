"""Column profiles that merge: stored per batch, added up to days and histories without reading rows again.

A state is one row per column (and group) with counts, moments, value types and
three sketches: distinct values (HLL), order statistics (KLL) and frequent
values. All of it comes from one scan with partial aggregation in every task,
and states merge by the same kind of aggregate, so a profile of the whole equals
the merged profiles of its parts: exactly in counts, types, least and largest
value, to rounding in moments, and within the sketches' errors elsewhere (about
2 % of distinct values, 2 % of ranks; counts of frequent values are exact while
no more than TRACKED different values have been seen). ``validation.profile``
has the exact distinct count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lakewarden.functions.columns import ratio
from lakewarden.operators.rules import FRACTIONAL, INTEGRAL, value_type

TYPES = ("string", "integer", "float", "boolean", "datetime", "unknown")
STATE = ("field", "rows", "n", "lo", "hi", "numbers", "mean", "var", "chars", "distinct", "order", "frequent", *[f"type_{t}" for t in TYPES])
TRACKED = 1000  # different values of which frequencies are kept


def _state(i: int, name: str, dtype: T.DataType) -> tuple[list[Column], Column]:
    """Aggregates of a column, and the struct of its state made from them."""
    col = F.col(f"`{name}`")
    number = col.cast("double") if isinstance(dtype, INTEGRAL + FRACTIONAL) else F.lit(None).cast("double")
    text = col.cast("string")
    kind = value_type(col, dtype)
    length = F.length(col).cast("double") if isinstance(dtype, T.StringType) else F.lit(None).cast("double")
    aggs = {
        "rows": F.count("*"), "n": F.count(col), "lo": F.min(number), "hi": F.max(number),
        "numbers": F.count(number), "mean": F.avg(number), "var": F.var_pop(number), "chars": F.sum(length),
        "distinct": F.hll_sketch_agg(text), "order": F.kll_sketch_agg_double(number),
        "frequent": F.call_function("approx_top_k_accumulate", text, F.lit(TRACKED)),
    } | {f"type_{t}": F.count_if(col.isNotNull() & (kind == t)) for t in TYPES}
    own = lambda key: F.col(f"__{key}{i}").alias(key)
    return [a.alias(f"__{k}{i}") for k, a in aggs.items()], F.struct(F.lit(name).alias("field"), *map(own, aggs))


def accumulate(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The state of each column per group, from one scan of the rows."""
    types = {f.name: f.dataType for f in df.schema.fields}
    states = [_state(i, name, types[name]) for i, name in enumerate(columns)]
    found = df.groupBy(*by).agg(*[a for aggs, _ in states for a in aggs])
    return found.select(*by, F.inline(F.array(*[row for _, row in states])))


def merge(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The states of larger groups from those of their parts."""
    held = states.where("rows > 0")  # a part without rows adds nothing
    square = F.col("numbers") * (F.col("var") + F.col("mean") * F.col("mean"))
    sums = [F.sum(c).alias(c) for c in ("rows", "n", "numbers", "chars", *[f"type_{t}" for t in TYPES])]
    found = held.groupBy(*by, "field").agg(
        *sums, F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.sum(F.col("numbers") * F.col("mean")).alias("__s"), F.sum(square).alias("__q"),
        F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("order").alias("order"),
        F.call_function("approx_top_k_combine", F.col("frequent"), F.lit(TRACKED)).alias("frequent"))
    mean = F.try_divide("__s", "numbers")
    return found.withColumn("mean", mean).withColumn(
        "var", F.when(F.col("numbers") > 0, F.greatest(F.lit(0.0), F.try_divide("__q", "numbers") - mean * mean))
    ).select(*by, *STATE)


def finish(states: DataFrame, quantiles: Sequence[float] = (0.5, 0.95, 0.99), samples: int = 5, by: Sequence[str] = ()) -> DataFrame:
    """The profile of each state: counts, distinct values, moments, quantiles, value types with shares, frequent values."""
    counted = [F.struct(F.lit(t).alias("value_type"), F.col(f"type_{t}").alias("n"), ratio(F.col(f"type_{t}"), F.col("n")).alias("share")) for t in TYPES]
    ranks = F.when(F.col("numbers") > 0, F.kll_sketch_get_quantile_double("order", F.array(*map(F.lit, quantiles))))
    return states.select(
        *by, "field", F.col("n").alias("non_null_count"), (F.col("rows") - F.col("n")).alias("null_count"),
        ratio(F.col("n"), F.col("rows")).alias("population_rate"), F.hll_sketch_estimate("distinct").alias("unique_values"),
        F.col("lo").alias("min"), F.col("hi").alias("max"), "mean", F.sqrt("var").alias("stddev"),
        F.try_divide("chars", "n").alias("average_length"), ranks.alias("quantiles"),
        F.filter(F.array(*counted), lambda x: x["n"] > 0).alias("value_types"),
        F.call_function("approx_top_k_estimate", F.col("frequent"), F.lit(samples)).alias("frequent_values"))
