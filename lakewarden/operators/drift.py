"""Drift of column statistics against their own history.

History is (object, field, snapshot_ts, population_rate, mean, ...), one row
per field and snapshot, trimmed to a window; so windows over it are short.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakewarden.functions.columns import advice_list, ladder
from lakewarden.functions.windows import newest_per_key
from lakewarden.operators.validation import profile

# Severity cut-offs, scores and defaults of drift detection.
CUTS = [(0.5, "high"), (0.2, "medium")]
SCORES = {"high": 1.0, "medium": 0.6, "low": 0.3}
MIN_SAMPLES = 10
SMALL_MEAN = 0.001
KEY = ["object", "field"]


def snapshots(
    df: DataFrame, columns: Sequence[str], object_col: str, ts: str, distinct: str | None = "approx"
) -> DataFrame:
    """Statistics of each column per object and snapshot time."""
    out = profile(df, columns, by=[object_col, ts], distinct=distinct)
    total = F.col("null_count") + F.col("non_null_count")
    return out.withColumnsRenamed({object_col: "object", ts: "snapshot_ts"}).withColumn(
        "null_rate", F.try_divide(F.col("null_count").cast("double"), total.cast("double")))


def trim(history: DataFrame, window_size: int) -> DataFrame:
    """The newest snapshots per field."""
    return newest_per_key(history, KEY, [F.col("snapshot_ts").desc()], window_size, spread_by=["snapshot_ts"])


def merge(stored: DataFrame, new: DataFrame, window_size: int) -> DataFrame:
    """Stored and new history as one: per whole second the new snapshot wins; trimmed."""
    cols = [c for c in stored.columns if c not in KEY]
    both = stored.withColumn("__side", F.lit(0)).unionByName(new.withColumn("__side", F.lit(1)))
    second = F.date_trunc("second", F.col("snapshot_ts"))
    chosen = both.groupBy(*KEY, second.alias("__second")).agg(
        F.max_by(F.struct(*cols), F.struct("__side", "snapshot_ts")).alias("s"))
    return trim(chosen.select(*KEY, "s.*"), window_size)


# What is compared with its past, and the name of the drift.
POPULATION, MEAN = ("population_rate", "population"), ("mean", "statistical")


def _change(value: str, kind: str) -> Column:
    """Relative change against the past; NULL where there is nothing to compare."""
    past, moved = F.col(f"__past_{value}"), F.abs(F.col(value) - F.col(f"__past_{value}"))
    if kind == "population":
        from_zero = F.when(moved > 0, F.lit(float("inf")))
        return F.when(past == 0, from_zero).otherwise(moved / F.nullif(past, F.lit(0.0)))
    return F.when(F.abs(past) > SMALL_MEAN, moved / F.nullif(F.abs(past), F.lit(0.0)))


def _past_drifts(
    history: DataFrame, checks: Sequence[tuple[str, str]], threshold: float, latest: bool, min_samples: int
) -> DataFrame:
    """The given checks from one window pass over the history."""
    past = Window.partitionBy(*KEY).orderBy("snapshot_ts").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*KEY)
    rows = history.select(*KEY, "snapshot_ts", *[v for v, _ in checks]).withColumns({
        "__samples": F.count("*").over(whole),
        "__latest": F.max("snapshot_ts").over(whole) == F.col("snapshot_ts"),
        **{f"__past_{v}": F.avg(v).over(past) for v, _ in checks},
    }).where(F.col("__samples") >= min_samples)
    if latest:
        rows = rows.where("__latest")

    def drift(value: str, kind: str) -> Column:
        change = _change(value, kind)
        return F.when(change > threshold, F.struct(
            F.lit(kind).alias("drift_type"), ladder(change, CUTS, "low").alias("severity"),
            F.col(value).cast("double").alias("current_value"),
            F.col(f"__past_{value}").cast("double").alias("historical_average"), (change * 100).alias("change_percent")))

    return rows.select(*KEY, "snapshot_ts", F.inline(F.array(*[drift(*c) for c in checks]))).where(
        F.col("drift_type").isNotNull())


def population_drift(history: DataFrame, threshold: float, latest: bool = True, min_samples: int = 2) -> DataFrame:
    """Population rate against the mean of all snapshots before; from zero to anything is infinite."""
    return _past_drifts(history, [POPULATION], threshold, latest, min_samples)


def mean_drift(history: DataFrame, threshold: float, latest: bool = True, min_samples: int = 2) -> DataFrame:
    """Mean of a numeric field against the mean of its means; near-zero means are left alone."""
    return _past_drifts(history, [MEAN], threshold, latest, min_samples)


def type_drift(shares: DataFrame, threshold: float, min_samples: int = 2) -> DataFrame:
    """Newest type shares against their mean over the snapshots before.

    ``shares`` is (object, field, snapshot_ts, value_type, share). A type absent
    from a snapshot counts as share zero, so sums replace the outer join.
    """
    span = shares.groupBy(*KEY).agg(
        F.max("snapshot_ts").alias("__last"), F.count_distinct("snapshot_ts").alias("__samples"))
    per_type = shares.join(span, KEY).groupBy(*KEY, "__last", "__samples", "value_type").agg(
        F.sum(F.when(F.col("snapshot_ts") == F.col("__last"), F.col("share")).otherwise(0.0)).alias("now"),
        F.sum(F.when(F.col("snapshot_ts") < F.col("__last"), F.col("share")).otherwise(0.0)).alias("past"))
    mean = F.col("past") / F.nullif(F.col("__samples") - 1, F.lit(0))
    out = per_type.groupBy(*KEY, "__last", "__samples").agg(F.sum(F.abs(F.col("now") - mean)).alias("drift"))
    return out.where((F.col("__samples") >= F.greatest(F.lit(2), F.lit(min_samples))) & (F.col("drift") > threshold)).select(
        *KEY, F.col("__last").alias("snapshot_ts"), F.lit("type").alias("drift_type"),
        ladder(F.col("drift"), CUTS, "low").alias("severity"), F.col("drift").alias("current_value"),
        F.lit(0.0).alias("historical_average"), (F.col("drift") * 100).alias("change_percent"))


def field_drifts(
    history: DataFrame, threshold: float, shares: DataFrame | None = None, min_samples: int = MIN_SAMPLES
) -> DataFrame:
    """All drifts of the newest snapshots of fields with enough history."""
    out = _past_drifts(history, [POPULATION, MEAN], threshold, True, min_samples)
    if shares is not None:
        out = out.unionByName(type_drift(shares, threshold, min_samples))
    return out


def report(
    history: DataFrame, threshold: float, shares: DataFrame | None = None, min_samples: int = MIN_SAMPLES
) -> DataFrame:
    """Per object: fields with enough history, drifts, score and advice."""
    counted = history.groupBy(*KEY).agg(F.count("*").alias("n")).where(F.col("n") >= min_samples)
    if shares is not None:
        by_type = shares.groupBy(*KEY).agg(F.count_distinct("snapshot_ts").alias("n")).where(F.col("n") >= min_samples)
        counted = counted.unionByName(by_type)
    fields = counted.select(*KEY).distinct().groupBy("object").agg(F.count("*").alias("fields"))
    score = F.when(F.col("severity") == "high", SCORES["high"]).when(
        F.col("severity") == "medium", SCORES["medium"]).otherwise(SCORES["low"])

    def named(kind: str) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(F.col("drift_type") == kind, F.col("field")))), " ")

    drifts = field_drifts(history, threshold, shares, min_samples).groupBy("object").agg(
        F.count("*").alias("drifts"), F.sum(score).alias("__score"), F.count_if(F.col("severity") == "high").alias("high"),
        F.count_distinct("field").alias("drifting_fields"), named("population").alias("population_fields"),
        named("type").alias("type_fields"))
    out = fields.join(drifts, "object", "left").fillna(0, ["drifts", "high", "drifting_fields", "__score"]).fillna(
        "", ["population_fields", "type_fields"])
    return (
        out.withColumn("drift_detected", F.col("drifts") > 0)
        .withColumn("overall_score", F.col("__score") / F.col("fields"))
        .withColumn("advice", advice_list(
            (F.col("high") > 0, F.concat(
                F.lit("Investigate "), F.col("high").cast("string"),
                F.lit(" fields with high-severity drift - may indicate upstream system changes"))),
            (F.col("population_fields") != "", F.concat(
                F.lit("Population rate changes detected in fields: ["), F.col("population_fields"),
                F.lit("] - check for data completeness issues"))),
            (F.col("type_fields") != "", F.concat(
                F.lit("Type distribution changes detected in fields: ["), F.col("type_fields"),
                F.lit("] - verify data transformation logic"))),
            (F.col("drifting_fields") * 2 > F.col("fields"), F.lit(
                "Widespread drift detected - consider reviewing connector configuration and source system changes")),
        ))
        .drop("__score")
    )
