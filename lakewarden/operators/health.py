"""Commit, retry, breaker, sync and call metrics, and the scores made from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakewarden.functions.columns import advice_list, clamp, micros, ntz, one_row, ratio, seconds_between
from lakewarden.functions.windows import newest_per_key, with_previous

HOUR = 3600.0


def commit_metrics(commits: DataFrame, table: str = "table") -> DataFrame:
    """Per table: commits, newest version, files, size, last commit and commits per hour.

    ``commits`` is (table, version, ts, files, size). Only the two newest
    commits of a table are ranked; the rest is summed.
    """
    newest = newest_per_key(commits, [table], [F.col("version").desc()], 2, spread_by=["version"], rank="__r")
    ends = newest.groupBy(table).agg(
        F.max(F.when(F.col("__r") == 1, F.struct("version", "ts", "files", "size"))).alias("last"),
        F.max(F.when(F.col("__r") == 2, F.col("ts"))).alias("before"))
    sums = commits.groupBy(table).agg(
        F.count("*").alias("commits"), F.sum("files").alias("total_files"), F.sum("size").alias("total_size"))
    hours = seconds_between(F.col("before"), F.col("last.ts")) / HOUR
    return sums.join(ends, table).select(
        table, "commits", F.col("last.version").alias("version"), F.col("last.files").alias("files"),
        F.col("last.size").alias("size"), F.col("last.ts").alias("last_commit"),
        F.when(hours > 0, 1.0 / hours).otherwise(0.0).alias("commits_per_hour"), "total_files", "total_size")


def commit_totals(metrics: DataFrame) -> DataFrame:
    return metrics.agg(
        F.count("*").alias("tables"), F.sum("commits").alias("commits"),
        F.sum("total_files").alias("active_files"), F.sum("total_size").alias("total_size"))


def checkpoint_health(log: DataFrame, by: Sequence[str], as_of) -> DataFrame:
    """Score per group of a log (ts, kind) with kinds created, valid and invalid; 50 when none was created."""
    kind = F.col("kind")
    out = log.groupBy(*by).agg(
        F.count_if(kind == "created").alias("created"), F.count_if(kind == "valid").alias("valid"),
        F.count_if(kind == "invalid").alias("invalid"), F.max(F.when(kind == "created", F.col("ts"))).alias("__last"))
    failures = ratio(F.col("invalid"), F.col("valid") + F.col("invalid"))
    hours = seconds_between(F.col("__last"), ntz(as_of)) / HOUR
    stale = F.least(F.lit(20.0), F.greatest(F.lit(0.0), (hours - 24.0) * 2.0))
    score = clamp(100.0 - failures * 30.0 - stale)
    return out.withColumn("score", F.when(F.col("created") == 0, 50.0).otherwise(score)).drop("__last")


def retry_metrics(attempts: DataFrame) -> DataFrame:
    """Per operation, and over all (operation NULL), from (operation, ts, success, delay)."""
    ok = F.count_if(F.col("success"))
    return attempts.rollup("operation").agg(
        F.count("*").alias("attempts"), ok.alias("successful"), F.count_if(~F.col("success")).alias("failed"),
        F.sum("delay").alias("total_delay"), F.min("delay").alias("min_delay"), F.max("delay").alias("max_delay"),
        F.avg("delay").alias("average_delay"), ratio(ok, F.count("*")).alias("success_rate"),
        F.max("ts").alias("last_attempt"))


def breaker_metrics(
    log: DataFrame, key: str, tie: str, as_of
) -> DataFrame:
    """State-change metrics per breaker from (key, ts, state, success).

    Open time is summed without pairing rows: leave times less enter times,
    leaving out a first period that was open from the start, plus the time up
    to ``as_of`` while open. Only the state before each row needs an order.
    """
    rows = with_previous(log, [key], "ts", tie, ["state"], into="__prev")
    prev, state = F.col("__prev.state"), F.col("state")
    changed = F.col("__prev").isNotNull() & (prev != state)
    enter, leave = changed & (state == "OPEN"), changed & (prev == "OPEN")
    us = micros(F.col("ts")).cast("decimal(38,0)")
    zero = F.lit(0).cast("decimal(38,0)")
    end = micros(ntz(as_of)).cast("decimal(38,0)")
    out = rows.groupBy(key).agg(
        F.count("*").alias("requests"), F.count_if(F.col("success")).alias("successes"),
        F.count_if(~F.col("success")).alias("failures"), F.count_if(changed).alias("transitions"),
        F.count_if(enter).alias("open_count"), F.count_if(changed & (state == "HALF_OPEN")).alias("half_open_count"),
        F.max_by("state", F.struct("ts", tie)).alias("state"), F.min_by("state", F.struct("ts", tie)).alias("__first"),
        F.max(F.when(changed, F.col("ts"))).alias("last_change"),
        F.coalesce(F.sum(F.when(leave, us)), zero).alias("__left"), F.coalesce(F.sum(F.when(enter, us)), zero).alias("__entered"),
        F.min(F.when(leave, us)).alias("__first_leave"))
    unpaired = F.when(F.col("__first") == "OPEN", F.coalesce("__first_leave", zero)).otherwise(zero)
    still = F.when((F.col("state") == "OPEN") & (F.col("open_count") > 0), end).otherwise(zero)
    open_s = ((F.col("__left") - unpaired - F.col("__entered") + still).cast("double")) / 1_000_000.0
    return out.select(
        key, "state", "requests", "successes", "failures", ratio(F.col("successes"), F.col("requests")).alias("success_rate"),
        "transitions", "open_count", "half_open_count", open_s.alias("open_seconds"), "last_change")


def _busy() -> Column:
    return F.col("operation").isNotNull() & (F.col("attempts") > 10) & (F.col("success_rate") < 0.8)


def _retry_inputs(retries: DataFrame, breakers: DataFrame) -> DataFrame:
    """The few sums both verdicts need, as one row; each side is one row before they meet."""
    ops = retries.agg(
        F.max(F.when(F.col("operation").isNull(), F.col("attempts"))).alias("attempts"),
        F.max(F.when(F.col("operation").isNull(), F.col("success_rate"))).alias("success_rate"),
        F.count("operation").alias("operations"),
        F.count_if(F.col("operation").isNotNull() & (F.col("attempts") > 5) & (F.col("success_rate") < 0.8)).alias("weak"),
        F.count_if(_busy()).alias("failing"),
        F.max("last_attempt").alias("last_update"))
    states = breakers.agg(F.count("*").alias("breakers"), F.count_if(F.col("state") == "OPEN").alias("open_breakers"))
    return one_row(ops, states)


def retry_health_score(retries: DataFrame, breakers: DataFrame, as_of) -> DataFrame:
    """0 to 100: low success, open breakers, failing operations and staleness each take points."""
    r = _retry_inputs(retries, breakers)
    low = F.when(F.col("attempts") > 10, (1.0 - F.col("success_rate")) * 40.0).otherwise(0.0)
    opened = ratio(F.col("open_breakers"), F.col("breakers")) * 30.0
    weak = ratio(F.col("weak"), F.col("operations")) * 20.0
    hours = seconds_between(F.col("last_update"), ntz(as_of)) / HOUR
    stale = F.least(F.lit(10.0), F.greatest(F.lit(0.0), F.coalesce((hours - 1.0) * 2.0, F.lit(0.0))))
    return r.select("attempts", "success_rate", "breakers", "open_breakers", "weak",
                    clamp(100.0 - low - opened - weak - stale).alias("score"))


def retry_health(retries: DataFrame, breakers: DataFrame, worst: int) -> DataFrame:
    """Healthy or not, how many operations fail often, the ``worst`` of them by success rate, and what to do."""
    few = retries.where(_busy()).orderBy("success_rate", "operation").limit(worst).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("success_rate", "operation"))), lambda x: x["operation"]), ", ").alias("few"))
    r = one_row(_retry_inputs(retries, breakers), few)
    opened, failing, low = F.col("open_breakers") > 0, F.col("failing") > 0, F.col("success_rate") < 0.9
    return r.select(
        (~low & ~opened & ~failing).alias("healthy"), "success_rate", "breakers", "open_breakers",
        F.col("failing").alias("failing_operations"), F.col("few").alias("worst_operations"),
        F.array_join(advice_list(
            (opened, "Investigate services with open circuit breakers"),
            (failing, "Review retry policies for high failure rate operations"),
            (low, "Overall success rate is below 90%, consider system health review"),
        ), "; ").alias("actions"))


def run_metrics(log: DataFrame, by: Sequence[str], tie: str) -> DataFrame:
    """Runs, successes, failures, rate and the last duration and time per source."""
    ok = F.count_if(F.col("success"))
    newest = F.struct("ts", tie)
    return log.groupBy(*by).agg(
        F.count("*").alias("runs"), ok.alias("successful"), F.count_if(~F.col("success")).alias("failed"),
        ratio(ok, F.count("*")).alias("success_rate"), F.max_by("duration", newest).alias("last_duration"),
        F.max("ts").alias("last_time"))


def call_metrics(log: DataFrame, parts: Sequence[str], tie: str) -> DataFrame:
    """Calls, failures, last duration and time per composite key."""
    keyed = log.withColumn("call", F.concat_ws(".", *[F.col(p).cast("string") for p in parts]))
    return run_metrics(keyed, ["call"], tie).select(
        "call", F.col("runs").alias("calls"), F.col("failed").alias("failures"), "last_duration", "last_time")


def http_metrics(requests: DataFrame, tie: str) -> DataFrame:
    """Requests by method and path with the last duration, and by status, in one pass."""
    keyed = requests.withColumn("request", F.concat_ws(" ", F.upper("method"), F.col("path")))
    out = keyed.groupingSets([["request"], ["status"]], "request", "status").agg(
        F.count("*").alias("n"), F.max_by("duration", F.col(tie)).alias("__last"), F.grouping("request").alias("__by_status"))
    by_status = F.col("__by_status") == 1
    return out.select(
        F.when(by_status, "status").otherwise("request").alias("kind"),
        F.when(by_status, F.col("status").cast("string")).otherwise(F.col("request")).alias("key"), "n",
        F.when(~by_status, F.col("__last")).alias("last_duration"))


def volume_totals(df: DataFrame, source: str, size: Column, changed: Column) -> DataFrame:
    """Bytes, records and schema changes per source."""
    return df.groupBy(source).agg(
        F.count("*").alias("records"), F.sum(size).alias("bytes"), F.count_if(changed).alias("schema_changes"))
