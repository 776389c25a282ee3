"""Security-event counts, scores, alerts, reports and trends; issue de-duplication."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F

from lakewarden.functions.columns import advice_list, clamp, lookup, micros, moment, ntz
from lakewarden.functions.windows import running_sum

# Category, weight and cap of each event type.
EVENT_TYPES: dict[str, tuple[str, float, int]] = {
    "auth_failure": ("auth_failures", 2.0, 50),
    "network_anomaly": ("network_anomalies", 1.5, 20),
    "file_access": ("file_access_violations", 1.8, 10),
    "memory_anomaly": ("memory_anomalies", 1.2, 30),
    "process_anomaly": ("process_anomalies", 1.0, 25),
    "network_connection": ("unauthorized_connections", 3.0, 5),
    "tls_violation": ("tls_violations", 4.0, 3),
    "credential_exposure": ("credential_exposures", 10.0, 1),
    "data_integrity": ("data_integrity_violations", 8.0, 2),
    "access_control": ("access_control_violations", 5.0, 5),
}
TREND_TYPES = ("auth_failure", "network_anomaly", "memory_anomaly", "process_anomaly")
TICK_SECONDS, WINDOW_SECONDS = 30, 3600
IDLE_SECONDS = 24 * 3600


def category_counts(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Events per type with the category the type belongs to."""
    names = {k: v[0] for k, v in EVENT_TYPES.items()}
    return events.groupBy(*by, "type").agg(F.count("*").alias("events")).withColumn(
        "category", lookup(F.col("type"), names, "other"))


def _penalty(count_of) -> Column:
    total = F.lit(0.0)
    for kind, (_, weight, cap) in EVENT_TYPES.items():
        total = total + F.least(count_of(kind), F.lit(cap)) * weight
    return total


def event_score(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """100 less the weighted, capped counts."""
    out = events.groupBy(*by).agg(*[F.count_if(F.col("type") == k).alias(f"__{k}") for k in EVENT_TYPES])
    return out.select(*by, clamp(100.0 - _penalty(lambda k: F.col(f"__{k}"))).alias("score"))


def event_alerts(events: DataFrame, auth_threshold: int) -> DataFrame:
    """High and critical events, and authentication failures from the threshold-th one on.

    The running count only matters where it reaches the threshold, so the
    threshold-th failure is found by a top-k and compared with; no row is numbered.
    """
    order = F.struct("ts", "event_id")
    auth = F.col("type") == "auth_failure"
    hard = F.col("severity").isin("high", "critical")
    alert = hard
    if auth_threshold > 0:
        first = events.where(auth).select("ts", "event_id").orderBy("ts", "event_id").limit(auth_threshold)
        point = first.agg(F.when(F.count("*") >= auth_threshold, F.max(order)).alias("p"))
        alert = hard | (auth & F.coalesce(order >= point.scalar(), F.lit(False)))
    return events.where(alert).withColumn("title", F.concat(F.lit("Security Event: "), F.col("type")))


def recent_events(events: DataFrame, as_of, limit: int | None = None, window_s: int = WINDOW_SECONDS) -> DataFrame:
    """Events of the window, or the newest ``limit`` of them."""
    kept = events.where(F.col("ts") > moment(events, "ts", as_of, -window_s))
    return kept if limit is None else kept.orderBy(F.col("ts").desc(), F.col("event_id").desc()).limit(limit)


def event_report(events: DataFrame) -> DataFrame:
    """One row: severities of all events, score, risk and advice; give it the events of a window."""

    def of(s: str) -> Column:
        return F.count_if(F.col("severity") == s).alias(s)

    found = events.agg(F.count("*").alias("total_issues"), of("low"), of("medium"), of("high"), of("critical"),
                       *[F.count_if(F.col("type") == k).alias(f"__{k}") for k in EVENT_TYPES])
    score = clamp(100.0 - _penalty(lambda k: F.col(f"__{k}")))
    advice = advice_list(
        (F.col("__auth_failure") > 10, "Investigate authentication failures"),
        (F.col("__memory_anomaly") > 5, "Address memory anomalies"),
        (F.col("__credential_exposure") > 0, "Immediate credential exposure response"),
        (F.col("total_issues") > 50, "Review security monitoring configuration"))
    return found.select(
        "total_issues", "low", "medium", "high", "critical", (F.col("high") + F.col("critical")).alias("high_severity"),
        score.alias("score"), (100.0 - score).alias("risk"), F.array_join(advice, "; ").alias("advice"))


def event_trend(events: DataFrame, start, end, tick_s: int = TICK_SECONDS) -> DataFrame:
    """Cumulative value of four counters at every tick from start up to end, quiet ticks too.

    Ticks without events are rows of the range itself, so a gap is no hole. Sums
    go in two levels; the upper one has a row a day.
    """
    spark, step = events.sparkSession, tick_s * 1_000_000
    inside = events.where((F.col("ts") >= moment(events, "ts", start)) & (F.col("ts") < moment(events, "ts", end)))
    first, last = (int(datetime.fromisoformat(str(x)).replace(tzinfo=timezone.utc).timestamp() * 1e6) for x in (start, end))
    names = [EVENT_TYPES[k][0] for k in TREND_TYPES]
    counted = inside.groupBy(F.floor(micros(F.col("ts")) / step).alias("n")).agg(*[
        F.count_if(F.col("type") == k).alias(n) for k, n in zip(TREND_TYPES, names)])
    every = spark.range(first // step, -(-last // step)).select(F.col("id").alias("n"))
    ticks = every.join(counted, "n", "left").fillna(0, names).select(
        F.timestamp_seconds(F.col("n") * tick_s).alias("tick"), *names, F.lit(1).alias("__all"))
    totals = running_sum(ticks, ["__all"], "tick", names)
    return totals.select(F.col("tick").cast("timestamp_ntz").alias("tick"), *names).unpivot("tick", names, "category", "value")


def fold_issues(log: DataFrame, as_of, idle_s: int = IDLE_SECONDS) -> DataFrame:
    """Equal issues (subject, type, message) as one; resolved ones idle for longer are dropped."""
    out = log.groupBy("subject", "type", "message").agg(
        F.count("*").alias("n"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"),
        F.max_by("resolved", F.struct("ts", "seq")).alias("resolved"), F.bool_or("resolved").alias("__ever"))
    gone = F.col("resolved") & (micros(F.col("last_seen")) <= micros(ntz(as_of)) - idle_s * 1_000_000)
    return out.where(~gone).withColumn("reopened", F.col("__ever") & ~F.col("resolved")).drop("__ever")
