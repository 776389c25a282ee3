"""What the operators share: reading texts, settled tables in the shared folder, cleaned digests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakewarden.session import fresh_dir

# The white space that separates words; everything else is part of a word.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text alone, a null text as empty; other columns only if asked for."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def settle(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back.

    Cuts the lineage so that a lost executor costs a reread, and computes a
    table once that several steps use.
    """
    path = fresh_dir(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spare(df: DataFrame, stem: str) -> str:
    """A column name that the table does not have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of all texts: the one figure that sizes the number of shards."""
    return df.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()[0]


def joined_spans(spans: Column) -> Column:
    """Structs (start, rank, kind, end) in order as kind:start:end, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def needs(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"the table lacks {missing}")
