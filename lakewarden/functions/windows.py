"""Ordered computations that stay parallel when one key holds much of the data.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task. The
helpers below split a key by salt (rank cut-offs) or by rank (lag, running
sums) and carry only a summary between the pieces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakewarden.session import settled


def newest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    spread_by: Sequence[str],
    spread: int = 32,
    rank: str | None = None,
) -> DataFrame:
    """First ``n`` rows per key in ``order``.

    The first pass ranks inside (key, salt) and keeps n of each, so the second
    pass sees at most ``spread * n`` rows of a key however many there were.
    Spark adds its own per-task group limit before both shuffles.
    """
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*spread_by), F.lit(spread)))
    by_salt = Window.partitionBy(*keys, "__salt").orderBy(*order)
    by_key = Window.partitionBy(*keys).orderBy(*order)
    kept = (
        salted.withColumn("__rank", F.row_number().over(by_salt))
        .where(F.col("__rank") <= n)
        .drop("__rank", "__salt")
        .withColumn("__rank", F.row_number().over(by_key))
        .where(F.col("__rank") <= n)
    )
    return kept.withColumnRenamed("__rank", rank) if rank else kept.drop("__rank")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys, NULL equal to NULL; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    cond = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        cond = same if cond is None else cond & same
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


def with_previous(
    df: DataFrame, keys: Sequence[str], ts: str, tie: str, cols: Sequence[str], into: str, pieces: int | None = None
) -> DataFrame:
    """Struct of ``cols`` from the row before, per key in (ts, tie) order; NULL on the first.

    Rows are cut by rank: ranges of (key, ts, tie) go to tasks of about equal
    size, so neither a large key nor a burst within a second meets in one. The
    last row of each piece of a key is carried to the next piece. The cut is
    written once, as ranges may fall elsewhere when they are taken again.
    """
    order = [*keys, ts, tie]
    dealt = df.repartitionByRange(pieces, *order) if pieces else df.repartitionByRange(*order)
    cut = settled(dealt.withColumn("__piece", F.spark_partition_id()), "previous")
    tails = cut.groupBy(*keys, "__piece").agg(
        F.max(F.struct(F.col(ts).alias("__t"), F.col(tie).alias("__i"), *cols)).alias("__tail"))
    between = Window.partitionBy(*keys).orderBy("__piece")  # a row per key and piece
    carried = tails.withColumn("__last", F.lag("__tail").over(between)).where(F.col("__last").isNotNull()).select(
        *keys, "__piece", F.struct(*[F.col(f"__last.{c}").alias(c) for c in cols]).alias("__carry"))
    inside = Window.partitionBy(*keys, "__piece").orderBy(ts, tie)
    lagged = cut.withColumn("__before", F.lag(F.struct(*cols)).over(inside))
    return (
        null_safe_join(lagged, carried, [*keys, "__piece"], "left")
        .withColumn(into, F.coalesce("__before", "__carry"))
        .drop("__before", "__carry", "__piece")
    )


def running_sum(df: DataFrame, keys: Sequence[str], ts: str, values: Sequence[str], pieces: int | None = None) -> DataFrame:
    """Running totals per key over ts: a prefix scan over pieces cut by rank.

    Ranges of (key, ts, hash of the row) go to tasks of about equal size, so
    neither a large key nor a burst within a second meets in one; each piece adds
    up its own rows on top of the total of the pieces before it. Rows of the same
    time follow each other in the order of their hash. The cut is written once,
    as ranges may fall elsewhere when they are taken again.
    """
    order = [*keys, ts, "__tie"]
    tied = df.withColumn("__tie", F.xxhash64(*df.columns))
    dealt = tied.repartitionByRange(pieces, *order) if pieces else tied.repartitionByRange(*order)
    cut = settled(dealt.withColumn("__piece", F.spark_partition_id()), "sums")
    before = Window.partitionBy(*keys).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(*keys, "__piece").agg(*[F.sum(v).alias(f"__s_{v}") for v in values])  # a row per key and piece
    offsets = totals.select(*keys, "__piece", *[
        F.coalesce(F.sum(f"__s_{v}").over(before), F.lit(0)).alias(f"__o_{v}") for v in values])
    inside = Window.partitionBy(*keys, "__piece").orderBy(ts, "__tie").rowsBetween(Window.unboundedPreceding, 0)
    sums = null_safe_join(cut.withColumns({v: F.sum(v).over(inside) for v in values}), offsets, [*keys, "__piece"], "inner")
    return sums.withColumns({v: F.col(v) + F.col(f"__o_{v}") for v in values}).drop(
        "__piece", "__tie", *[f"__o_{v}" for v in values])
