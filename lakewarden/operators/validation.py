"""Record verdicts, batch and object summaries, column profiles, sampling and alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F
from pyspark.sql import types as T

from lakewarden.functions.columns import ladder, ladder_at_least, ratio
from lakewarden.functions.windows import newest_per_key, null_safe_join
from lakewarden.operators.rules import Check, FRACTIONAL, Field, INTEGRAL, value_type


ISSUES = "array<struct<field:string,type:string,message:string,value:string,severity:string>>"


def _issues(checks: Sequence[Check], severity: str) -> Column:
    """Failing checks as an array; concat stays in generated code where a filter over an array would not."""
    none = F.array().cast(ISSUES)
    parts = [F.when(c.fails, F.array(c.issue())).otherwise(none) for c in checks if c.severity == severity]
    return F.concat(none, *parts)


def _count(checks: Sequence[Check], severity: str) -> Column:
    """Number of failing checks of a row; plain arithmetic, so it stays in generated code."""
    total = F.lit(0)
    for c in checks:
        if c.severity == severity:
            total = total + F.coalesce(c.fails, F.lit(False)).cast("int")
    return total


def _nulls(fields: Sequence[Field]) -> Column:
    total = F.lit(0)
    for f in fields:
        total = total + F.col(f.name).isNull().cast("int")
    return total


def record_issues(df: DataFrame, keys: Sequence[str], checks: Sequence[Check]) -> DataFrame:
    """One row per failing check: keys, field, type, message, value, severity."""
    if not checks:
        return df.select(*keys, F.inline(F.array().cast(ISSUES)))
    each = F.array(*[F.when(c.fails, c.issue()) for c in checks])
    return df.select(*keys, F.inline(each)).where(F.col("severity").isNotNull())


def record_verdict(df: DataFrame, fields: Sequence[Field], checks: Sequence[Check]) -> DataFrame:
    """Every row with its valid flag, errors, warnings and rates over the field count."""
    n = len(fields)
    return (
        df.withColumn("errors", _issues(checks, "error"))
        .withColumn("warnings", _issues(checks, "warning"))
        .withColumn("valid", _count(checks, "error") == 0)
        .withColumn("error_rate", _count(checks, "error") / F.lit(float(n)))
        .withColumn("warning_rate", _count(checks, "warning") / F.lit(float(n)))
        .withColumn("null_rate", _nulls(fields) / F.lit(float(n)))
    )


def batch_summary(
    df: DataFrame, by: Sequence[str], fields: Sequence[Field], checks: Sequence[Check],
    validated: Column | None = None,
) -> DataFrame:
    """Counts and rates per batch. ``validated`` marks sampled rows; the rest only count as total."""
    seen = F.lit(True) if validated is None else validated
    rows = df.select(*by, *_marks(fields, checks, seen))
    return _rates(rows.groupBy(*by).agg(*_totals()), len(fields))


def observed(df: DataFrame, fields: Sequence[Field], checks: Sequence[Check], observation: Observation) -> DataFrame:
    """The rows as they are; whoever writes them finds the counts of ``batch_summary`` in the observation, without another pass."""
    marks = _marks(fields, checks, F.lit(True))
    return df.select("*", *marks).observe(observation, *_totals()).select(*[F.col(f"`{c}`") for c in df.columns])


def observed_summary(spark: SparkSession, counts: dict, fields: Sequence[Field]) -> DataFrame:
    """The row of ``batch_summary`` from observed counts; a batch without rows has none and counts zero."""
    names = ["total_records", "valid_records", "error_records", "warning_records", "error_count", "warning_count", "__null_cells"]
    row = spark.createDataFrame([tuple(counts.get(n) or 0 for n in names)], ", ".join(f"{n} long" for n in names))
    return _rates(row, len(fields))


def _marks(fields: Sequence[Field], checks: Sequence[Check], seen: Column) -> list[Column]:
    return [seen.alias("__seen"), _count(checks, "error").alias("__errors"),
            _count(checks, "warning").alias("__warnings"), _nulls(fields).alias("__nulls")]


def _totals() -> list[Column]:
    return [
        F.count("*").alias("total_records"),
        F.count_if(F.col("__seen") & (F.col("__errors") == 0)).alias("valid_records"),
        F.count_if(F.col("__seen") & (F.col("__errors") > 0)).alias("error_records"),
        F.count_if(F.col("__seen") & (F.col("__warnings") > 0)).alias("warning_records"),
        F.sum(F.when(F.col("__seen"), F.col("__errors")).otherwise(0)).alias("error_count"),
        F.sum(F.when(F.col("__seen"), F.col("__warnings")).otherwise(0)).alias("warning_count"),
        F.sum(F.when(F.col("__seen"), F.col("__nulls")).otherwise(0)).alias("__null_cells"),
    ]


def _rates(out: DataFrame, n: int) -> DataFrame:
    checked = F.col("valid_records") + F.col("error_records")
    return (
        out.withColumn("error_rate", ratio(F.col("error_records"), checked))
        .withColumn("warning_rate", ratio(F.col("warning_records"), checked))
        .withColumn("null_rate", ratio(F.col("__null_cells"), checked * F.lit(n)))
        .drop("__null_cells")
    )


def profile(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), distinct: str | None = "exact"
) -> DataFrame:
    """One row per column (and group): population, distinct count, min, max, mean, spread.

    ``distinct`` is "exact", "approx" or None. Exact counts are taken column by
    column: each reads one column only, and all together read the table once,
    where one aggregate would copy every row once per column.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs: list[Column] = [F.count("*").alias("__rows")]
    for i, name in enumerate(columns):
        col, numeric = F.col(name), isinstance(types[name], INTEGRAL + FRACTIONAL)
        number = col.cast("double") if numeric else F.lit(None).cast("double")
        unique = F.approx_count_distinct(col) if distinct == "approx" else F.max(F.lit(None).cast("long"))
        length = F.length(col).cast("double") if isinstance(types[name], T.StringType) else F.lit(None).cast("double")
        aggs += [
            F.count(col).alias(f"__n{i}"), unique.alias(f"__u{i}"),
            F.min(number).alias(f"__lo{i}"), F.max(number).alias(f"__hi{i}"),
            F.avg(number).alias(f"__mean{i}"), F.stddev_pop(number).alias(f"__sd{i}"),
            F.avg(length).alias(f"__len{i}"),
        ]
    rows = [
        F.struct(
            F.lit(name).alias("field"), value_type(F.col(name), types[name]).alias("value_type")
            if not isinstance(types[name], T.VariantType) else F.lit("variant").alias("value_type"),
            F.col(f"__n{i}").alias("non_null_count"),
            (F.col("__rows") - F.col(f"__n{i}")).alias("null_count"),
            ratio(F.col(f"__n{i}"), F.col("__rows")).alias("population_rate"),
            F.col(f"__u{i}").alias("unique_values"), F.col(f"__lo{i}").alias("min"),
            F.col(f"__hi{i}").alias("max"), F.col(f"__mean{i}").alias("mean"),
            F.col(f"__sd{i}").alias("stddev"), F.col(f"__len{i}").alias("average_length"),
        )
        for i, name in enumerate(columns)
    ]
    out = df.groupBy(*by).agg(*aggs).select(*by, F.inline(F.array(*rows)))
    if distinct != "exact":
        return out
    counts = [
        df.groupBy(*by).agg(F.count_distinct(name).alias("__unique")).select(*by, F.lit(name).alias("field"), "__unique")
        for name in columns
    ]
    unique = counts[0]
    for more in counts[1:]:
        unique = unique.unionByName(more)
    return null_safe_join(out, unique, [*by, "field"], "inner").withColumn("unique_values", F.col("__unique")).drop("__unique")


def type_distribution(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count and share of run-time value types per column."""
    types = {f.name: f.dataType for f in df.schema.fields}
    pairs = [
        F.struct(F.lit(c).alias("field"),
                 F.when(F.col(c).isNotNull(), value_type(F.col(c), types[c])).alias("value_type"))
        for c in columns
    ]
    counted = (
        df.select(*by, F.inline(F.array(*pairs))).where(F.col("value_type").isNotNull())
        .groupBy(*by, "field", "value_type").agg(F.count("*").alias("n"))
    )
    whole = Window.partitionBy(*by, "field")
    return counted.withColumn("share", F.col("n") / F.sum("n").over(whole))


def sample_values(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """The n smallest distinct values of each column, as text."""
    pairs = [F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns]
    distinct = df.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull()).distinct()
    return newest_per_key(distinct, ["field"], [F.col("value")], n, spread_by=["value"], rank="position")


def hash_sample(df: DataFrame, key: Sequence[str], rate: float) -> DataFrame:
    """About ``rate`` of the rows, chosen by the MD5 of their key: the same rows whatever the batch or its size."""
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])
    return df.where(F.substring(F.md5(text), 1, 8) < f"{int(rate * 2**32):08x}" if rate < 1 else F.lit(True))


def strict_gate(df: DataFrame, by: Sequence[str], checks: Sequence[Check]) -> DataFrame:
    """Rows of the objects in which no row has an error; one bad row holds its whole object back."""
    failing = df.where(_count(checks, "error") > 0).select(*by).distinct()
    same = None
    left, right = df.alias("l"), failing.alias("r")
    for k in by:
        cond = F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
        same = cond if same is None else same & cond
    return left.join(right, same, "left_anti")


def object_rollup(batches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sums and rates per object over its batches, with status."""
    checked = F.col("processed_records")
    out = batches.groupBy(*by).agg(
        F.count("*").alias("batches"),
        F.sum("total_records").alias("total_records"),
        F.sum(F.col("valid_records") + F.col("error_records")).alias("processed_records"),
        F.sum("error_records").alias("error_records"),
        F.sum("warning_records").alias("warning_records"),
        F.sum(F.col("null_rate") * (F.col("valid_records") + F.col("error_records"))).alias("__nulls"),
    )
    return (
        out.withColumn("error_rate", ratio(F.col("error_records"), checked))
        .withColumn("warning_rate", ratio(F.col("warning_records"), checked))
        .withColumn("null_rate", ratio(F.col("__nulls"), checked))
        .withColumn("status", F.when(F.col("error_records") > 0, "error")
                    .when(F.col("warning_records") > 0, "warning").otherwise("success"))
        .drop("__nulls")
    )


def validation_alerts(
    objects: DataFrame, object_col: str, threshold: float,
    drift: DataFrame | None = None, quality_issues: DataFrame | None = None,
) -> DataFrame:
    """Alerts: error rate over the threshold, drift detected, and one per data-quality warning.

    ``drift`` has (object, overall_score, drift_detected); ``quality_issues``
    has (object, field, message, type) as record_issues gives them.
    """
    name = F.col(object_col).cast("string").alias("object_name")
    none = F.lit(None)
    over = objects.where((F.col("processed_records") > 0) & (F.col("error_rate") > threshold)).select(
        F.lit("error_threshold").alias("type"),
        ladder_at_least(F.col("error_rate") / F.lit(threshold),
                        [(3.0, "critical"), (2.0, "high"), (1.5, "medium")], "low").alias("severity"),
        name, none.cast("string").alias("field_name"),
        F.format_string("Error rate %.2f%% exceeds threshold %.2f%%",
                        F.col("error_rate") * 100, F.lit(threshold * 100)).alias("message"),
        F.lit(threshold).alias("threshold"), F.col("error_rate").alias("actual_value"),
    )
    out = over
    if drift is not None:
        out = out.unionByName(drift.where("drift_detected").select(
            F.lit("drift_detected").alias("type"),
            ladder(F.col("overall_score"), [(0.7, "high"), (0.4, "medium")], "low").alias("severity"),
            F.col("object").cast("string").alias("object_name"), none.cast("string").alias("field_name"),
            F.format_string("Schema drift detected (score: %.2f)", F.col("overall_score")).alias("message"),
            none.cast("double").alias("threshold"), F.col("overall_score").alias("actual_value"),
        ))
    if quality_issues is not None:
        out = out.unionByName(quality_issues.where(F.col("type") == "data_quality").select(
            F.lit("data_quality").alias("type"), F.lit("low").alias("severity"), name,
            F.col("field").alias("field_name"), F.concat(F.lit("Data quality issue: "), F.col("message")).alias("message"),
            none.cast("double").alias("threshold"), none.cast("double").alias("actual_value"),
        ))
    return out


def run_summary(objects: DataFrame) -> DataFrame:
    """Object counts by status, rates over total records and the overall status; one row."""
    out = objects.agg(
        F.count("*").alias("total_objects"),
        F.count_if(F.col("status") == "success").alias("successful_objects"),
        F.count_if(F.col("status") == "warning").alias("warning_objects"),
        F.count_if(F.col("status") == "error").alias("error_objects"),
        F.coalesce(F.sum("total_records"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum("error_records"), F.lit(0)).alias("__errors"),
        F.coalesce(F.sum("warning_records"), F.lit(0)).alias("__warnings"),
    )
    return (
        out.withColumn("error_rate", ratio(F.col("__errors"), F.col("total_records")))
        .withColumn("warning_rate", ratio(F.col("__warnings"), F.col("total_records")))
        .withColumn("overall_status", F.when(F.col("error_objects") > 0, "error")
                    .when(F.col("warning_objects") > 0, "warning").otherwise("success"))
        .drop("__errors", "__warnings")
    )


def recent_reports(reports: DataFrame, modified: str, tie: str, limit: int) -> DataFrame:
    """Newest reports: a top-k, kept per task before anything moves."""
    return reports.orderBy(F.col(modified).desc(), F.col(tie).desc()).limit(limit)
