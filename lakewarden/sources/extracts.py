"""Typed scans and the full, incremental, delimited and paged-JSON extracts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from lakewarden.functions.columns import lookup

# The eight logical types and the column type each is read as.
LOGICAL_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(), "integer": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "date": T.DateType(), "datetime": T.TimestampType(), "binary": T.BinaryType(),
}
# Source field types by logical type; any other is a string.
SOURCE_TYPES: dict[str, tuple[str, ...]] = {
    "string": ("string", "textarea", "url", "email", "phone", "picklist", "multipicklist",
               "combobox", "reference", "id", "encryptedstring"),
    "integer": ("int",),
    "long": ("long",),
    "double": ("double", "currency", "percent"),
    "boolean": ("boolean",),
    "date": ("date",),
    "datetime": ("datetime",),
    "binary": ("base64",),
}
# Watermark columns of a source that can and cannot replicate.
WATERMARK_REPLICATED = "SystemModstamp"
WATERMARK_OTHER = "LastModifiedDate"


def to_struct(fields: Sequence) -> T.StructType:
    """Read schema of declared fields; an unknown logical type is read as text."""
    return T.StructType([
        T.StructField(f.name, LOGICAL_TYPES.get(f.type, T.StringType()), f.nullable) for f in fields
    ])


def scan_parquet(spark: SparkSession, path: str, fields: Sequence) -> DataFrame:
    """Parquet scan under a declared schema: columns not declared are never read."""
    return spark.read.schema(to_struct(fields)).parquet(path)


def full_snapshot(df: DataFrame) -> DataFrame:
    """All rows, columns in name order."""
    return df.select(*sorted(df.columns))


def incremental(
    df: DataFrame, watermark: str, since: datetime | str, ordered: bool = True, tie: Sequence[str] = ()
) -> DataFrame:
    """Rows whose watermark is strictly after ``since`` (cut to milliseconds), ascending.

    The comparison is against a literal of the column's own type, so it reaches
    the Parquet reader. The order is a range-partitioned sort, by ``tie`` too so
    that a watermark many rows share can be split; leave it out when the rows
    only go into a write.
    """
    moment = datetime.fromisoformat(str(since))
    moment = moment.replace(microsecond=moment.microsecond // 1000 * 1000)
    bound = F.lit(moment.isoformat(sep=" ")).cast(df.schema[watermark].dataType)
    rows = df.where(F.col(watermark) > bound)
    return rows.orderBy(F.col(watermark).asc(), *tie) if ordered else rows


def scan_delimited(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Delimited extract, every value as text: blank is NULL, short rows leave the tail NULL."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.csv(path, schema=schema, header=True, nullValue="", emptyValue="",
                          mode="PERMISSIVE", enforceSchema=True, multiLine=False)


def cast_declared(df: DataFrame, fields: Sequence) -> DataFrame:
    """Text columns read as their declared types; unreadable text becomes NULL."""
    return df.select(*[
        F.col(f.name) if f.type == "string" else F.col(f.name).try_cast(LOGICAL_TYPES[f.type]).alias(f.name)
        for f in fields
    ])


def scan_json_pages(spark: SparkSession, path: str, record_schema: str) -> DataFrame:
    """Records of paged JSON answers, one page per line; ``attributes`` is not part of a record."""
    pages = spark.read.schema(f"records array<struct<{record_schema}>>, done boolean").json(path)
    rows = pages.select(F.explode("records").alias("r")).select("r.*")
    return rows.drop("attributes") if "attributes" in rows.columns else rows


def discover_catalog(catalog: DataFrame) -> DataFrame:
    """Objects that can be queried, each with the column its watermark is taken from."""
    return catalog.where("queryable").withColumn(
        "watermark_field", F.when(F.col("replicateable"), WATERMARK_REPLICATED).otherwise(WATERMARK_OTHER))


def map_source_types(fields: DataFrame, source_type: str = "source_type") -> DataFrame:
    """Logical type of each source field, a constant lookup without a join."""
    table: Mapping[str, str] = {s: logical for logical, names in SOURCE_TYPES.items() for s in names}
    return fields.withColumn("logical_type", lookup(F.col(source_type), table, "string"))
