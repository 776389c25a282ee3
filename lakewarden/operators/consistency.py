"""Checks across related objects: staleness, missing dependents, drift and gaps.

State is (object, last_sync, watermark); edges are (parent, dependent). Every
check returns (type, parent, dependent, severity, amount_s).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakewarden.functions.columns import ladder, ntz, seconds_between, severity_rank

HOUR = 3600.0
# Cut-offs of the checks.
STALE_RATIOS = [(4.0, "critical"), (2.0, "high"), (1.5, "medium")]
DRIFT_SECONDS = [(24 * HOUR, "critical"), (12 * HOUR, "high"), (6 * HOUR, "medium")]
DRIFT_ALLOWED = 1 * HOUR
GAP_ALLOWED = 6 * HOUR
DEFAULT_WINDOW = 24 * HOUR


def _row(kind: str, parent: Column, dependent: Column, severity: Column, amount: Column) -> list[Column]:
    return [F.lit(kind).alias("type"), parent.alias("parent"), dependent.alias("dependent"),
            severity.alias("severity"), amount.cast("double").alias("amount_s")]


def staleness(state: DataFrame, as_of, windows: DataFrame | None = None, default_s: float = DEFAULT_WINDOW) -> DataFrame:
    """Objects not synced within their window; severity by how many windows have passed."""
    rows = state if windows is None else state.join(
        windows.select("object", F.col("max_age_s").alias("__max")), "object", "left")
    limit = F.lit(default_s) if windows is None else F.coalesce(F.col("__max").cast("double"), F.lit(default_s))
    age = seconds_between(F.col("last_sync"), ntz(as_of))
    return rows.where(age > limit).select(*_row(
        "staleness", F.col("object"), F.lit(None).cast("string"), ladder(age / limit, STALE_RATIOS, "low"), age))


def missing_dependents(state: DataFrame, edges: DataFrame) -> DataFrame:
    """Dependents that were not synced while their parent was; one row per pair, nothing is collected.

    All missing dependents of a parent are one violation, see ``report``.
    """
    known = state.select("object").distinct()
    there = edges.join(known.withColumnRenamed("object", "parent"), "parent", "left_semi")
    gone = there.join(known.withColumnRenamed("object", "dependent"), "dependent", "left_anti")
    return gone.select(*_row(
        "missing_object", F.col("parent"), F.col("dependent"), F.lit("high"), F.lit(None)))


def _pairs(state: DataFrame, edges: DataFrame) -> DataFrame:
    p = state.select(F.col("object").alias("parent"), F.col("last_sync").alias("p_sync"), F.col("watermark").alias("p_wm"))
    d = state.select(F.col("object").alias("dependent"), F.col("last_sync").alias("d_sync"), F.col("watermark").alias("d_wm"))
    return edges.join(p, "parent").join(d, "dependent")


def _pair_checks(state: DataFrame, edges: DataFrame) -> DataFrame:
    """Both checks that compare a parent with a dependent, from one join."""
    drift = seconds_between(F.col("d_wm"), F.col("p_wm"))
    gap = F.abs(seconds_between(F.col("d_sync"), F.col("p_sync")))
    pair = (F.col("parent"), F.col("dependent"))
    found = F.array(
        F.when(drift > DRIFT_ALLOWED, F.struct(*_row("watermark_drift", *pair, ladder(drift, DRIFT_SECONDS, "low"), drift))),
        F.when(gap > GAP_ALLOWED, F.struct(*_row("transaction_boundary", *pair, F.lit("medium"), gap))))
    return _pairs(state, edges).select(F.inline(found)).where(F.col("type").isNotNull())


def watermark_drift(state: DataFrame, edges: DataFrame) -> DataFrame:
    """Dependents whose watermark is behind their parent's by more than an hour."""
    return _pair_checks(state, edges).where(F.col("type") == "watermark_drift")


def sync_gap(state: DataFrame, edges: DataFrame) -> DataFrame:
    """Related objects synced more than six hours apart."""
    return _pair_checks(state, edges).where(F.col("type") == "transaction_boundary")


def violations(state: DataFrame, edges: DataFrame, as_of, windows: DataFrame | None = None) -> DataFrame:
    return (
        staleness(state, as_of, windows).unionByName(missing_dependents(state, edges))
        .unionByName(_pair_checks(state, edges))
    )


def report(found: DataFrame) -> DataFrame:
    """One row: violations by severity and the overall status; a parent's missing dependents count once."""
    missing = F.col("type") == "missing_object"
    parents = F.count_distinct(F.when(missing, F.col("parent")))

    def of(level: str) -> Column:
        n = F.count_if(~missing & (F.col("severity") == level))
        return (n + parents if level == "high" else n).alias(level)

    worst = F.coalesce(F.max(severity_rank(F.col("severity"))), F.lit(0))
    return found.agg(
        (F.count_if(~missing) + parents).alias("violations"), of("low"), of("medium"), of("high"), of("critical"),
        F.when(worst == 4, "unhealthy").when(worst > 0, "degraded").otherwise("healthy").alias("status"))
