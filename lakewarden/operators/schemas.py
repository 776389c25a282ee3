"""Schemas as a long table (object, name, type): fingerprints, diffs, history, conforming.

One job covers any number of objects. A schema is bounded by its field count,
so collecting the fields of one object is safe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from lakewarden.sources.extracts import LOGICAL_TYPES


def _hash(fields: Column) -> Column:
    return F.substring(F.sha2(F.to_json(F.array_sort(fields)), 256), 1, 16)


def fingerprint(fields: DataFrame, by: Sequence[str] = ("object",)) -> DataFrame:
    """Order-independent hash of names and types per object; nullability is left out."""
    listed = F.collect_set(F.struct("name", "type"))
    return fields.groupBy(*by).agg(
        _hash(listed).alias("schema_hash"),
        F.size(F.array_distinct(F.transform(listed, lambda f: f["name"]))).cast("long").alias("n_fields"))


def _side_by_side(before: DataFrame, after: DataFrame) -> DataFrame:
    """Every field of either side with its change; one full outer join."""
    old = before.select("object", "name", F.col("type").alias("old_type"))
    new = after.select("object", "name", F.col("type").alias("new_type"))
    change = (
        F.when(F.col("old_type").isNull(), "added").when(F.col("new_type").isNull(), "removed")
        .when(F.col("old_type") != F.col("new_type"), "type_changed")
    )
    return old.join(new, ["object", "name"], "full_outer").withColumn("change", change)


def diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Fields added, removed or of another type, per object."""
    return _side_by_side(before, after).where("change is not null")


def compare(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per object of either side: changes, class, whether it was known before, and its new fingerprint."""

    def of(kind: str):
        return F.count_if(F.col("change") == kind).alias(kind)

    fields = F.collect_set(F.when(F.col("new_type").isNotNull(), F.struct("name", F.col("new_type").alias("type"))))
    return _side_by_side(before, after).groupBy("object").agg(
        of("added"), of("removed"), of("type_changed"), F.count_if(F.col("old_type").isNotNull()).alias("old_fields"),
        F.when(F.count("new_type") > 0, _hash(fields)).alias("new_hash"),
    ).withColumn(
        "classification",
        F.when(F.col("removed") + F.col("type_changed") > 0, "breaking")
        .when(F.col("added") > 0, "additive").otherwise("none"))


def classify(before: DataFrame, after: DataFrame) -> DataFrame:
    """breaking, additive or none for every object known on either side."""
    return compare(before, after).select("object", "added", "removed", "type_changed", "classification")


def history(snapshots: DataFrame, taken: str) -> DataFrame:
    """Versions of each object's schema: a new one only where the fingerprint changed.

    The window runs over one short row per object and snapshot, not over data.
    """
    prints = fingerprint(snapshots, ["object", taken])
    in_time = Window.partitionBy("object").orderBy(taken)
    changed = prints.withColumn("__before", F.lag("schema_hash").over(in_time)).where(
        F.col("__before").isNull() | (F.col("__before") != F.col("schema_hash")))
    return changed.withColumn("version", F.row_number().over(in_time)).drop("__before")


def conform(df: DataFrame, fields: Sequence) -> DataFrame:
    """Rows in the current schema: absent columns become NULL, text is read as declared."""
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in fields:
        want = LOGICAL_TYPES[f.type]
        if f.name not in have:
            out.append(F.lit(None).cast(want).alias(f.name))
        elif have[f.name] == want:
            out.append(F.col(f.name))
        else:
            out.append(F.col(f.name).try_cast(want).alias(f.name))
    return df.select(*out)


def conform_to(df: DataFrame, schema: StructType) -> DataFrame:
    """Rows in another schema: absent columns become NULL, values that do not fit their new type too."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[
        F.lit(None).cast(f.dataType).alias(f.name) if f.name not in have
        else F.col(f"`{f.name}`") if have[f.name] == f.dataType
        else F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def union_versions(parts: Sequence[DataFrame]) -> DataFrame:
    """Rows written under different additive schemas as one; columns missing in a part are NULL."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out
