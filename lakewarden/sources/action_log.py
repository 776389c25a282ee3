"""Scan of a JSON action log: one action per line, one file (or written folder) per version."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

ACTION_SCHEMA = """
protocol struct<minReaderVersion:int,minWriterVersion:int>,
metaData struct<id:string,name:string,schemaString:string,partitionColumns:array<string>,createdTime:bigint>,
add struct<path:string,size:bigint,partitionValues:map<string,string>,modificationTime:bigint,dataChange:boolean,stats:string>,
remove struct<path:string,deletionTimestamp:bigint,dataChange:boolean>,
commitInfo struct<timestamp:bigint,operation:string,operationParameters:map<string,string>>
"""
VERSION_IN_PATH = r"/(?:[^/=]+=)?(\d{20})\.json(?:/[^/]*)?$"


def scan_log(spark: SparkSession, log_path: str) -> DataFrame:
    """All actions with their version; names that are not a version are left out."""
    version = F.regexp_extract(F.col("_metadata.file_path"), VERSION_IN_PATH, 1)
    return (
        spark.read.schema(ACTION_SCHEMA).json(f"{log_path}/*.json")
        .withColumn("version", F.when(version != "", version.cast("long")))
        .where(F.col("version").isNotNull())
    )


def file_actions(log: DataFrame) -> DataFrame:
    """Add and remove actions as flat rows (version, path, action, size, modified)."""
    return log.where(F.col("add").isNotNull() | F.col("remove").isNotNull()).select(
        "version",
        F.coalesce("add.path", "remove.path").alias("path"),
        F.when(F.col("add").isNotNull(), "add").otherwise("remove").alias("action"),
        F.col("add.size").alias("size"), F.col("add.modificationTime").alias("modified"),
        F.col("add.stats").alias("stats"),
    )
