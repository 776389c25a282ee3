"""Micro-batch ingest: validate each batch, write it as one version, resume without repeats."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from lakewarden.functions.columns import micros
from lakewarden.operators.rules import Field, compile_checks
from lakewarden.operators.validation import observed, observed_summary
from lakewarden.sources.versioned import VersionedTable


BATCH_BYTES = 16 << 30
ONE_BATCH = 1 << 62
STRETCH_TASKS = 16  # ranges of time that a stretch is written by, each streaming through one task


class BatchRejected(ValueError):
    """A batch with errors under strict validation; nothing of it was written."""


def read_stream(spark: SparkSession, path: str, like: DataFrame, bytes_per_batch: int = BATCH_BYTES) -> DataFrame:
    """Parquet files of a folder as a stream with a declared schema, about so many bytes of them per batch."""
    return spark.readStream.schema(like.schema).option("maxBytesPerTrigger", bytes_per_batch).parquet(path)


def batches_of(table: DataFrame) -> int:
    """How many batches the files of a table make."""
    files = table.inputFiles()
    if not files:
        return 1
    listed = table.sparkSession.read.format("binaryFile").load(files).select("length")  # sizes come from the listing alone
    return max(1, -(-(listed.agg(F.sum("length")).first()[0] or 0) // BATCH_BYTES))


def arrivals(rows: DataFrame, ts: str, pieces: int, path: str) -> Iterator[DataFrame]:
    """The rows in ascending stretches of time: each is written to ``path``, then given as a stream that takes it in one batch.

    One pass cuts the table by ranges of time into a folder per stretch, so each
    stretch reads its own folder only, however many there are; equal times stay
    together, those without time come first. Files reach a stream by when they
    were written, so only a stretch at a time keeps later batches from holding
    earlier rows. Drain each before the next.
    """
    spark, staged = rows.sparkSession, f"{path}-stretches"
    dealt = rows.repartitionByRange(pieces * STRETCH_TASKS, micros(F.col(ts)))
    stretch = F.floor(F.spark_partition_id() / STRETCH_TASKS).cast("int")
    dealt.withColumn("__stretch", stretch).write.partitionBy("__stretch").parquet(staged)
    whole = StructType([*rows.schema.fields, StructField("__stretch", IntegerType())])
    made = spark.read.schema(whole).parquet(staged).select("__stretch").distinct().collect()  # one row per stretch
    for n in sorted(r[0] for r in made) or [None]:  # a table without rows arrives once
        part = rows.limit(0) if n is None else spark.read.schema(rows.schema).parquet(f"{staged}/__stretch={n}")
        part.write.mode("append").parquet(path)
        yield read_stream(spark, path, rows, bytes_per_batch=ONE_BATCH)


def ingest(
    stream: DataFrame, table: VersionedTable, fields: Sequence[Field], checkpoint: str,
    report_path: str | None = None, strict: bool = False,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Drain what is there now. Batch n becomes version n, so a batch that runs again writes nothing new.

    The checkpoint moves on only after the batch function returns; a failure
    in it leaves the version unwritten and the batch is taken up again. Counts for
    the report and the strict gate are taken while the rows are written; the
    version is listed only after the gate has let them through.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch) if prepare else batch
        if not (strict or report_path):
            table.commit(rows, version=batch_id)
            return
        counted = Observation()  # filled by the write itself: the batch is evaluated once

        def gate() -> None:
            counts = counted.get
            if strict and counts.get("error_records"):
                raise BatchRejected(f"batch {batch_id} has errors")
            if report_path:
                report = observed_summary(batch.sparkSession, counts, fields)
                report.coalesce(1).write.mode("overwrite").parquet(f"{report_path}/batch={batch_id}")

        table.commit(observed(rows, fields, compile_checks(rows, fields), counted), version=batch_id, gate=gate)

    query = (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start())
    query.awaitTermination()
