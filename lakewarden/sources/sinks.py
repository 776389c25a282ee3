"""Parquet sink cut by rows per file, and the facts of what was written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

BATCH_ROWS = 10_000


def write_batches(df: DataFrame, path: str, rows_per_file: int = BATCH_ROWS, mode: str = "append") -> None:
    """Snappy Parquet, no file longer than one batch; an empty input leaves no data file with rows."""
    (df.write.mode(mode).option("compression", "snappy")
       .option("maxRecordsPerFile", rows_per_file).parquet(path))


def written_files(spark: SparkSession, path: str) -> DataFrame:
    """File, size and row count of a written folder, from the scan's hidden columns only."""
    return (
        spark.read.parquet(path)
        .select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("size"))
        .groupBy("file_path", "size").agg(F.count("*").alias("num_records"))
    )
