"""Analytics over an operation log (op, ts, duration, is_error) and resource samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakewarden.functions.columns import advice_list, ladder, micros, ntz, one_row, ratio, severity_rank
from lakewarden.functions.windows import null_safe_join

# Sample size, limits and advice.
ACCURACY = 10_000  # of the quantile sketch: its ranks are right to one in so many
PERCENTILES = (50, 95, 99)
TREND_BYTES_PER_SECOND = 100 * 1024.0
IDLE_SECONDS = 24 * 3600
LATENCY_SECONDS = [(30.0, "critical"), (10.0, "high"), (5.0, "medium")]
ERROR_RATES = [(0.2, "critical"), (0.1, "high"), (0.05, "medium")]
GROWTH_MIB = [(100.0, "critical"), (10.0, "high"), (1.0, "medium")]
GOROUTINES = [(10_000.0, "critical"), (5_000.0, "high"), (1_000.0, "medium")]
GC_PAUSE_SECONDS = 0.1
SUGGESTIONS = {
    "latency": "Consider optimizing the operation or adding caching",
    "errors": "Investigate error causes and improve error handling",
    "memory": "Check for memory leaks and optimize memory usage",
    "goroutines": "Review goroutine lifecycle management and prevent goroutine leaks",
}
GROWING_ADVICE = "Monitor memory allocation patterns and implement regular profiling"
GC_ADVICE = "Consider tuning GC parameters to reduce pause times"
HEALTHY_ADVICE = "System performance appears healthy - continue monitoring"
MIB = 1024 * 1024.0


def operation_metrics(log: DataFrame, by: Sequence[str] = ("op",)) -> DataFrame:
    """Counts, total, smallest, largest and mean duration, errors and last update per operation."""
    return log.groupBy(*by).agg(
        F.count("*").alias("n"), F.sum("duration").alias("total_time"), F.min("duration").alias("min_time"),
        F.max("duration").alias("max_time"), F.avg("duration").alias("avg_time"),
        F.count_if(F.col("is_error")).alias("errors"), F.max("ts").alias("last_updated"))


def brackets(log: DataFrame, by: Sequence[str], accuracy: int = ACCURACY) -> DataFrame:
    """Of each operation and percentile the durations that can be it, with counts; a null duration counts all below them.

    A mergeable quantile sketch is right to a share 1 / accuracy of the ranks, so
    the wanted rank lies between its values four such shares below and above.
    Only what is between them is kept apart by duration: far values do not
    matter, and equal durations are one row.
    """
    keys, reach = list(by), 4 / accuracy
    points = [F.lit(x) for p in PERCENTILES for x in (max(0.0, p / 100 - reach), min(1.0, p / 100 + reach))]
    known = log.where(F.col("duration").isNotNull()).select(*keys, "duration")
    edges = known.groupBy(*keys).agg(
        F.percentile_approx("duration", F.array(*points), accuracy).alias("__e"), F.count("*").alias("__n"))

    def part(i: int, p: int) -> Column:
        low, high, own = F.col("__e")[2 * i], F.col("__e")[2 * i + 1], F.col("duration")
        return F.when(own < low, F.struct(F.lit(p).alias("p"), F.lit(None).cast("double").alias("at"))).when(
            own <= high, F.struct(F.lit(p).alias("p"), own.cast("double").alias("at")))

    parts = F.array_compact(F.array(*[part(i, p) for i, p in enumerate(PERCENTILES)]))
    met = null_safe_join(known, edges, keys, "inner").select(*keys, "__n", F.explode(parts).alias("x"))
    return met.groupBy(*keys, "__n", F.col("x.p").alias("__p"), F.col("x.at").alias("__at")).agg(F.count("*").alias("__c"))


def percentiles(log: DataFrame, by: Sequence[str] = ("op",), accuracy: int = ACCURACY) -> DataFrame:
    """p50, p95 and p99 of all durations, exact, by zero-based floor index without interpolation."""
    keys = list(by)
    upward = Window.partitionBy(*keys, "__p").orderBy(F.col("__at").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    upto = brackets(log, keys, accuracy).withColumn("__upto", F.sum("__c").over(upward))
    wanted = F.col("__upto") > F.floor(F.col("__n") * F.col("__p") / 100)
    outside = wanted & F.col("__at").isNull()

    def at(p: int) -> Column:
        own = F.when((F.col("__p") == p) & outside, F.raise_error(F.lit("the quantile sketch misses its stated error"))).when(
            (F.col("__p") == p) & wanted, F.col("__at"))
        return F.min(own).alias(f"p{p}")

    return upto.groupBy(*keys).agg(*[at(p) for p in PERCENTILES])


def _summary(as_of, period_s: int) -> tuple[list[Column], list[Column]]:
    """Aggregates and result columns of the resource summary."""
    inside = micros(F.col("ts")) > micros(ntz(as_of)) - period_s * 1_000_000

    def both(agg, col: str, name: str) -> list[Column]:
        return [agg(F.when(inside, F.col(col))).alias(f"__p_{name}"), agg(F.col(col)).alias(f"__a_{name}")]

    def pick(name: str) -> Column:
        return F.when(F.col("__n") > 0, F.col(f"__p_{name}")).otherwise(F.col(f"__a_{name}"))

    aggs = [
        F.count_if(inside).alias("__n"),
        *both(F.avg, "memory", "avg_memory"), *both(F.max, "memory", "peak_memory"),
        *both(F.avg, "goroutines", "avg_goroutines"), *both(F.max, "goroutines", "peak_goroutines"),
        F.max_by("gc_count", micros(F.col("ts"))).alias("gc_count"),
        F.max_by("gc_pause_s", micros(F.col("ts"))).alias("gc_pause_s")]
    return aggs, [
        F.floor(pick("avg_memory")).alias("avg_memory"), pick("peak_memory").alias("peak_memory"),
        F.floor(pick("avg_goroutines")).alias("avg_goroutines"), pick("peak_goroutines").alias("peak_goroutines"),
        F.col("gc_count"), F.col("gc_pause_s")]


def _trend(as_of, window_s: int) -> tuple[list[Column], list[Column]]:
    """Aggregates and result columns of the first-to-last trend."""
    inside = micros(F.col("ts")) >= micros(ntz(as_of)) - window_s * 1_000_000
    t, us, v = (F.when(inside, x) for x in (F.col("ts"), micros(F.col("ts")), F.col("memory")))
    aggs = [
        F.count(us).alias("__samples"), F.min(us).alias("__t0"), F.max(us).alias("__t1"), F.max(t).alias("__last"),
        F.min_by("memory", us).alias("__v0"), F.max_by("memory", us).alias("__v1"),
        F.max(v).alias("__peak"), F.floor(F.avg(v)).alias("__average")]
    span = (F.col("__t1") - F.col("__t0")) / 1_000_000.0
    rate = F.coalesce(F.try_divide((F.col("__v1") - F.col("__v0")).cast("double"), span), F.lit(0.0))
    direction = (
        F.when(F.col("__samples") == 0, "unknown").when(rate > TREND_BYTES_PER_SECOND, "increasing")
        .when(rate < -TREND_BYTES_PER_SECOND, "decreasing").otherwise("stable"))
    return aggs, [
        F.col("__samples").alias("samples"), F.col("__last").alias("last_updated"), F.col("__v1").alias("current"),
        F.col("__peak").alias("peak"), F.col("__average").alias("average"), rate.alias("rate"), direction.alias("direction")]


def resource_summary(samples: DataFrame, by: Sequence[str], as_of, period_s: int) -> DataFrame:
    """Mean and peak memory and goroutines in the period, and the last collector values.

    Samples are (ts, memory, goroutines, gc_count, gc_pause_s). A series with no
    sample in the period is summed up over its whole history.
    """
    aggs, out = _summary(as_of, period_s)
    return samples.groupBy(*by).agg(*aggs).select(*by, *out)


def resource_trend(samples: DataFrame, by: Sequence[str], as_of, window_s: int) -> DataFrame:
    """First-to-last rate per second in the window, with direction, peak, mean and current value."""
    aggs, out = _trend(as_of, window_s)
    return samples.groupBy(*by).agg(*aggs).select(*by, *out)


def resource_report(samples: DataFrame, by: Sequence[str], as_of, period_s: int) -> DataFrame:
    """Summary and trend in one pass."""
    (a, x), (b, y) = _summary(as_of, period_s), _trend(as_of, period_s)
    return samples.groupBy(*by).agg(*a, *b).select(*by, *x, *y)


def resource_leaks(trend: DataFrame, threshold: float) -> DataFrame:
    return trend.where((F.col("direction") == "increasing") & (F.col("rate") > threshold))


def _bottleneck(kind: str, operation: Column, severity: Column, impact: Column) -> list[Column]:
    return [F.lit(kind).alias("type"), operation.alias("operation"), severity.alias("severity"),
            impact.cast("double").alias("impact"), F.lit(SUGGESTIONS[kind]).alias("suggestion")]


def bottlenecks(
    metrics: DataFrame, ranks: DataFrame, resources: DataFrame | None = None, series: str = "metric"
) -> DataFrame:
    """Slow or failing operations, growing memory and many goroutines, each with severity and impact.

    ``resources`` has the columns of both resource_trend and resource_summary.
    """
    op, p95 = F.col("op"), F.col("p95")
    error_rate = ratio(F.col("errors"), F.col("n"))
    slow = ranks.select(*_bottleneck("latency", op, ladder(p95, LATENCY_SECONDS, None), p95 / 30.0))
    failing = metrics.select(*_bottleneck("errors", op, ladder(error_rate, ERROR_RATES, None), error_rate))
    out = slow.unionByName(failing)
    if resources is not None:
        growth = F.when(F.col("direction") == "increasing", F.col("rate") / MIB)
        peak = F.col("peak_goroutines").cast("double")
        both = F.array(
            F.struct(*_bottleneck("memory", F.col(series), ladder(growth, GROWTH_MIB, None), growth / 100.0)),
            F.struct(*_bottleneck("goroutines", F.col(series), ladder(peak, GOROUTINES, None), peak / 10_000.0)))
        out = out.unionByName(resources.select(F.inline(both)))
    return out.where(F.col("severity").isNotNull())


def ranked_advice(found: DataFrame, resources: DataFrame | None = None) -> DataFrame:
    """Advice for high and critical bottlenecks, the worst first, then general advice.

    (rank, impact, operation, advice); ordered by rank and impact. One "all
    well" line when there is nothing else.
    """
    rank = severity_rank(F.col("severity"))
    urgent = found.where(rank >= 3).select(
        rank.alias("rank"), "impact", "operation", F.col("suggestion").alias("advice"))
    facts = urgent.agg(F.count("*").alias("urgent"))
    if resources is not None:
        facts = one_row(facts, resources.agg(
            F.count_if(F.col("direction") == "increasing").alias("growing"),
            F.count_if(F.col("gc_pause_s") > GC_PAUSE_SECONDS).alias("pausing")))
    else:
        facts = facts.withColumns({"growing": F.lit(0), "pausing": F.lit(0)})
    growing, pausing = F.col("growing") > 0, F.col("pausing") > 0
    general = facts.select(F.explode(advice_list(
        (growing, GROWING_ADVICE), (pausing, GC_ADVICE),
        ((F.col("urgent") == 0) & ~growing & ~pausing, HEALTHY_ADVICE))).alias("advice"))
    return urgent.unionByName(general.select(
        F.lit(0).alias("rank"), F.lit(0.0).alias("impact"), F.lit("system").alias("operation"), "advice"
    )).orderBy(F.col("rank").desc(), F.col("impact").desc())


def live_operations(log: DataFrame, as_of, idle_s: int = IDLE_SECONDS, by: Sequence[str] = ("op",)) -> DataFrame:
    """Operations that were updated within the idle limit; the rest has expired."""
    return operation_metrics(log, by).where(
        micros(F.col("last_updated")) >= micros(ntz(as_of)) - idle_s * 1_000_000)
