"""What to load per object, how state moves on, and what failed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakewarden.functions.columns import lookup, micros, moment, ntz
from lakewarden.operators import schemas

# Advice by phase of the failure.
PHASE_ADVICE = {
    "connect": "Check connector credentials and API endpoint availability. Verify network connectivity.",
    "discover": "Verify object permissions and API access. Check if objects exist in the source system.",
    "extract": "Check API rate limits and query timeouts. Consider reducing batch size or adding retry delays.",
    "transform": "Validate data schema and transformation rules. Check for data type mismatches.",
    "store": "Verify S3 bucket permissions and network connectivity. Check available disk space.",
    "commit": "Check Delta Lake transaction conflicts. Verify log file integrity and retry the commit.",
    "validate": "Review validation rules and data quality. Consider adjusting validation thresholds.",
}
OTHER_ADVICE = "Check logs for detailed error information and contact support if issue persists."


def plan(
    catalog: DataFrame, fields: DataFrame, state: DataFrame, previous: DataFrame,
    allowed: DataFrame | None = None,
) -> DataFrame:
    """Skip, full or incremental for each catalogued object, with reason and schema version.

    ``fields`` and ``previous`` are (object, name, type); ``state`` is (object,
    schema_hash, schema_version). All joins are on the object.
    """
    compared = schemas.compare(previous, fields).select(
        "object", "new_hash", (F.col("old_fields") > 0).alias("has_previous"),
        (F.col("classification") == "breaking").alias("breaking"))
    known = state.select("object", F.coalesce("schema_hash", F.lit("")).alias("schema_hash"),
                         F.col("schema_version"), F.lit(True).alias("has_state"))
    rows = catalog.join(known, "object", "left").join(compared, "object", "left")
    if allowed is None:
        rows = rows.withColumn("is_allowed", F.lit(True))
    else:
        names = allowed.select("object").distinct().withColumn("is_allowed", F.lit(True))
        rows = rows.join(names, "object", "left").fillna(False, ["is_allowed"])
    skip = ~F.col("is_allowed")
    first = F.col("has_state").isNull()
    changed = ~first & F.col("new_hash").isNotNull() & (F.col("schema_hash") != "") & (
        F.col("new_hash") != F.col("schema_hash"))
    blind = changed & ~F.col("has_previous")
    broken = changed & F.col("has_previous") & F.col("breaking")
    return rows.select(
        *catalog.columns,
        F.when(skip, "skip").when(first | blind | broken, "full").otherwise("incremental").alias("mode"),
        F.when(skip, "not in allowed objects list").when(first, "no prior sync state")
        .when(blind, "schema changed (no prior schema for diffing)")
        .when(broken, "breaking schema change detected").otherwise("incremental from watermark").alias("reason"),
        (~skip & F.coalesce(changed, F.lit(False))).alias("schema_changed"),
        F.when(skip, F.lit(None)).when(first, 1).when(changed, F.col("schema_version") + 1)
        .otherwise(F.col("schema_version")).cast("int").alias("new_version"),
    )


def advance_state(state: DataFrame, written: DataFrame, object_col: str, watermark: str, as_of) -> DataFrame:
    """State after a commit; objects without written rows keep what they had.

    The watermark becomes the highest one among the committed rows. ``state``
    is (object, last_sync, watermark, total_records).
    """
    new = written.groupBy(F.col(object_col).alias("object")).agg(
        F.max(watermark).alias("__wm"), F.count("*").alias("last_records"))
    touched = F.col("last_records").isNotNull()
    return state.join(new, "object", "full_outer").select(
        "object",
        F.when(touched, ntz(as_of)).otherwise(F.col("last_sync")).alias("last_sync"),
        F.when(touched, F.greatest("watermark", "__wm")).otherwise(F.col("watermark")).alias("watermark"),
        (F.coalesce("total_records", F.lit(0)) + F.coalesce("last_records", F.lit(0))).alias("total_records"),
        F.coalesce("last_records", F.lit(0)).alias("last_records"),
    )


def state_issues(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per broken rule of a saved state row (source, object, schema_version, sync_type)."""
    allowed = F.col("sync_type").isNull() | F.col("sync_type").isin("", "full", "incremental")
    rules = [
        (F.coalesce("source", F.lit("")) == "", "source must be a non-empty string"),
        (F.col("object").isNull(), "missing required field: objects"),
        (F.coalesce(F.col("object") == "", F.lit(False)), "object name cannot be empty"),
        (F.coalesce(F.col("schema_version") < 0, F.lit(False)), "invalid schema version"),
        (~allowed, "invalid sync type"),
    ]
    found = F.array(*[F.when(cond, F.lit(text)) for cond, text in rules])
    return rows.select(*keys, F.explode(found).alias("issue")).where(F.col("issue").isNotNull())


def retry_queue(
    failures: DataFrame, as_of, base_s: int, max_s: int, max_attempts: int
) -> DataFrame:
    """Failed objects due for another attempt; the delay grows with the attempts up to a maximum."""
    delay = F.least((F.col("attempts") - 1) * base_s, F.lit(max_s))
    due = micros(F.col("last_attempt")) + delay * 1_000_000
    return failures.withColumn("delay_s", delay.cast("long")).where(
        (F.col("last_attempt") <= moment(failures, "last_attempt", as_of))
        & (F.col("attempts") < max_attempts) & (micros(ntz(as_of)) > due))


def error_rollup(errors: DataFrame, by: list[str], phase: str = "phase") -> DataFrame:
    """Errors counted per phase (and object, batch), each with advice for its phase."""
    keys = [phase, *[c for c in by if c != phase]]
    return errors.groupBy(*keys).agg(F.count("*").alias("errors")).withColumn(
        "advice", lookup(F.col(phase), PHASE_ADVICE, OTHER_ADVICE))
