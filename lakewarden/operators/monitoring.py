"""Metric trends, anomalies, threshold rules, overall health and error patterns.

Metrics are (ts, metric, value). Windows over a metric are cut into stretches
of time, so a long history is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakewarden.functions.columns import micros, moment, ntz, ratio
from lakewarden.functions.windows import newest_per_key, null_safe_join, running_sum

# Slope, strength and history limits.
SLOPE_STABLE = 0.01
STRONG, MODERATE = 0.7, 0.3
MIN_HISTORY = 10


@dataclass(frozen=True)
class HealthRule:
    """Threshold rule; ``below`` rules fail under the bound, the others over it."""

    name: str
    metric: str
    warning: float | None = None
    critical: float | None = None
    below: bool = False
    severity: str = "warning"
    enabled: bool = True


def trend(metrics: DataFrame, as_of, window_s: int) -> DataFrame:
    """Least-squares slope per second, direction and strength per metric over the trailing window."""
    start = micros(ntz(as_of)) - window_s * 1_000_000
    x = (micros(F.col("ts")) - start) / 1_000_000.0
    y = F.col("value")
    out = metrics.where(F.col("ts") > moment(metrics, "ts", as_of, -window_s)).groupBy("metric").agg(
        F.regr_slope(y, x).alias("slope"),
        F.when(F.regr_syy(y, x) == 0, 0.0).otherwise(F.regr_r2(y, x)).alias("r2"),
        F.count("value").alias("data_points"), (F.max(x) - F.min(x)).alias("span_s"))
    return out.where(F.col("data_points") >= 2).withColumn(
        "direction", F.when(F.col("slope") > SLOPE_STABLE, "increasing")
        .when(F.col("slope") < -SLOPE_STABLE, "decreasing").otherwise("stable")
    ).withColumn(
        "strength", F.when(F.col("r2") > STRONG, "strong").when(F.col("r2") > MODERATE, "moderate").otherwise("weak"))


def window_average(metrics: DataFrame, as_of, window_s: int) -> DataFrame:
    """Mean of the values newer than as_of - window, per metric."""
    return metrics.where(F.col("ts") > moment(metrics, "ts", as_of, -window_s)).groupBy("metric").agg(
        F.avg("value").alias("average"), F.count("value").alias("data_points"))


def trailing_average(metrics: DataFrame, window_s: int) -> DataFrame:
    """For every row, the mean of the window ending with it.

    A metric is cut into stretches of four windows; each also gets the rows of
    one window before it, so no task holds a whole history.
    """
    us, width, reach = micros(F.col("ts")), 4 * window_s * 1_000_000, window_s * 1_000_000
    chunk = F.floor(us / width)
    own = F.struct(chunk.alias("__chunk"), F.lit(True).alias("__own"))
    ahead = F.struct((chunk + 1).alias("__chunk"), F.lit(False).alias("__own"))
    here = F.when(us > (chunk + 1) * width - reach, F.array(own, ahead)).otherwise(F.array(own))
    trailing = Window.partitionBy("metric", "__chunk").orderBy(us).rangeBetween(-(reach - 1), 0)
    cut = metrics.select("*", F.inline_outer(here))
    return cut.withColumn("trailing_average", F.avg("value").over(trailing)).where("__own").drop("__chunk", "__own")


def recent(metrics: DataFrame, n: int) -> DataFrame:
    """Newest n rows per metric."""
    return newest_per_key(metrics, ["metric"], [F.col("ts").desc()], n, spread_by=["ts"])


def anomalies(metrics: DataFrame, threshold: float, min_history: int = MIN_HISTORY) -> DataFrame:
    """Rows far from the mean of all rows before, in standard deviations."""
    # Sums run in two levels, of values less the metric's own mean, so that squares stay exact.
    centre = metrics.groupBy("metric").agg(F.avg("value").alias("__c"))
    off = F.col("value") - F.col("__c")
    known = F.when(off.isNotNull(), 1).otherwise(0)
    zero = F.coalesce(off, F.lit(0.0))
    tagged = null_safe_join(metrics, centre, ["metric"], "left").withColumns({"__off": zero, "__known": known})
    summed = running_sum(
        tagged.withColumns({"__n": F.col("__known"), "__s": F.col("__off"), "__q": F.col("__off") * F.col("__off")}),
        ["metric"], "ts", ["__n", "__s", "__q"])
    n = F.col("__n") - F.col("__known")
    rows = summed.withColumns({
        "__n": n, "__m": F.try_divide(F.col("__s") - F.col("__off"), n), "__v": F.try_divide(F.col("__q") - F.col("__off") * F.col("__off"), n),
    }).withColumns({
        "mean": F.col("__c") + F.col("__m"), "spread": F.sqrt(F.greatest(F.lit(0.0), F.col("__v") - F.col("__m") * F.col("__m")))})
    z = (F.col("value") - F.col("mean")) / F.nullif(F.col("spread"), F.lit(0.0))
    return rows.where(F.col("__n") >= min_history).withColumn("z_score", z).where(
        F.abs("z_score") > threshold
    ).select(
        "metric", "ts", "value", "mean", "spread", "z_score",
        F.when(F.abs("z_score") > 2 * threshold, "critical").otherwise("warning").alias("severity"),
        F.format_string("%.2f ± %.2f", F.col("mean"), F.col("spread") * threshold).alias("expected_range"))


def check_rules(metrics: DataFrame, rules: Sequence[HealthRule]) -> DataFrame:
    """Status of each enabled rule on each metric row that it is about; rules become one expression."""
    value = F.col("value")

    def outside(rule: HealthRule, bound: float | None) -> Column:
        if bound is None:
            return F.lit(False)
        return value < bound if rule.below else value > bound

    def result(rule: HealthRule) -> Column:
        status = F.when(outside(rule, rule.critical), "critical").when(
            outside(rule, rule.warning), "warning").otherwise("ok")
        bound = F.when(outside(rule, rule.critical), F.lit(rule.critical)).otherwise(F.lit(rule.warning)).cast("double")
        side = "below" if rule.below else "above"
        message = F.when(status == "ok", F.lit(f"{rule.name} is within limits")).otherwise(
            F.concat(F.lit(f"{rule.name} is {side} its "), status, F.lit(" threshold")))
        return F.when(F.col("metric") == rule.metric, F.struct(
            F.lit(rule.name).alias("rule"), F.lit(rule.severity).alias("rule_severity"), status.alias("status"),
            F.when(status != "ok", bound).alias("threshold"), message.alias("message")))

    results = F.array(*[result(r) for r in rules if r.enabled])
    return metrics.select("ts", "metric", "value", F.inline(results)).where(F.col("rule").isNotNull())


def overall_health(results: DataFrame, by: Sequence[str]) -> DataFrame:
    """critical if any failing rule is critical by status or severity, else warning, else ok."""
    failing = F.col("status") != "ok"
    rank = F.when(failing & ((F.col("rule_severity") == "critical") | (F.col("status") == "critical")), 2).when(
        F.col("status") == "warning", 1).otherwise(0)
    return results.groupBy(*by).agg(
        F.max(rank).alias("__rank"), F.count("*").alias("checked"), F.count_if(failing).alias("failing")
    ).withColumn("overall_status", F.when(F.col("__rank") == 2, "critical").when(
        F.col("__rank") == 1, "warning").otherwise("ok")).drop("__rank")


def error_patterns(errors: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Counts by each dimension on its own in one pass, with the total as sync error rate / 100."""
    sets = [[d] for d in dimensions] + [[]]
    grouped = errors.groupingSets(sets, *dimensions).agg(
        F.count("*").alias("errors"), F.grouping_id().alias("__set"))
    n = len(dimensions)
    name, value = F.lit("total"), F.lit("")
    for i, d in enumerate(dimensions):
        mine = (1 << n) - 1 - (1 << (n - 1 - i))
        name = F.when(F.col("__set") == mine, F.lit(d)).otherwise(name)
        value = F.when(F.col("__set") == mine, F.col(d).cast("string")).otherwise(value)
    return grouped.select(name.alias("dimension"), value.alias("value"), "errors",
                          (F.col("errors") / 100.0).alias("sync_error_rate"))


def retry_patterns(attempts: DataFrame) -> DataFrame:
    """Attempts, successes, failures, mean delay and recovery rate per operation."""
    ok = F.count_if(F.col("success"))
    return attempts.groupBy("operation").agg(
        F.count("*").alias("attempts"), ok.alias("successful"), F.count_if(~F.col("success")).alias("failed"),
        F.avg("delay").alias("average_delay"), ratio(ok, F.count("*")).alias("recovery_rate"))
