"""Exact dedup: two-pass Bloom filtering.

The first pass sends each task's text hashes, packed and already combined, to
the shard of the hash; a shard enters them into a Bloom filter and notes in a
second one every hash it has seen before. The second filters, whose total size
is fixed by a parameter, go to all tasks. In the second pass a row whose hash
is not among the noted ones has no equal and passes straight through; only the
rest are shuffled and grouped by their SHA-256. A full filter lets more rows
into the shuffle and never loses one.

Defined cases: a null text counts as empty; ``keep_id`` is the smallest doc_id
that is not null; a row without doc_id stays only if no row of its group has
one; rows with the same doc_id and equal texts share their verdict in
``verdicts``, while ``keep_first`` keeps one of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakewarden.llm.common import SPACES, settle, spare, table, texts

SHARDS = 64
PROBES = 3
FILTER_BITS = 1 << 26  # of all shards together: 8 MB, the most that is ever broadcast


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACES, " ")


def _mixed(hashes: np.ndarray) -> np.ndarray:
    """Spread 64-bit values anew, as shard and probes take parts of them."""
    x = hashes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    return x * np.uint64(0xD6E8FEB86659FD93)


def _places(mixed: np.ndarray, bits: int) -> np.ndarray:
    """Probe places (values x PROBES) within a shard's filter."""
    step = (mixed >> np.uint64(29)) | np.uint64(1)
    return np.stack([(mixed + np.uint64(i) * step) % np.uint64(bits) for i in range(PROBES)], axis=1).astype(np.int64)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's hashes by shard, each value once, with those met again listed a second time."""
    parts = [b.column(0).to_numpy(zero_copy_only=False) for b in batches]
    if not parts:
        return
    values, counts = np.unique(np.concatenate(parts), return_counts=True)
    shard = _mixed(values) >> np.uint64(58)
    for s in range(SHARDS):
        mine = shard == s
        for found in (values[mine], values[mine & (counts > 1)]):
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([found.tobytes()], pa.binary())], ["shard", "hashes"])


def _note(bits: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}
        again: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if s not in seen:
                    seen[s], again[s] = np.zeros(bits, bool), np.zeros(bits, bool)
                places = _places(_mixed(np.frombuffer(packed, np.int64)), bits)
                again[s][places[seen[s][places].all(axis=1)]] = True
                seen[s][places] = True
        for s, flags in again.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([s], pa.int32()), pa.array([np.packbits(flags).tobytes()], pa.binary())], ["shard", "flags"]
            )

    return build


def repeat_filter(hashes: DataFrame, filter_bits: int = FILTER_BITS):
    """A column function that is false only for hashes that occur once.

    ``hashes`` has one long column. What comes to the driver and goes to the
    tasks is ``filter_bits / 8`` bytes at most, whatever the table's size.
    """
    bits = filter_bits // SHARDS
    packed = hashes.mapInArrow(_pack, "shard int, hashes binary")
    noted = packed.repartition(SHARDS, "shard").mapInArrow(_note(bits), "shard int, flags binary")
    shared = hashes.sparkSession.sparkContext.broadcast({r["shard"]: bytes(r["flags"]) for r in noted.collect()})

    @F.pandas_udf("boolean")
    def maybe_repeated(values: pd.Series) -> pd.Series:
        mixed = _mixed(values.to_numpy(np.int64))
        shard, places = (mixed >> np.uint64(58)).astype(np.int64), _places(mixed, bits)
        out = np.zeros(len(values), bool)
        for s in np.unique(shard):
            if s in shared.value:
                mine = shard == s
                flags, at = np.frombuffer(shared.value[s], np.uint8), places[mine]
                out[mine] = ((flags[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1)
        return pd.Series(out)

    return maybe_repeated


def verdicts(docs: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    clean = normalised(F.col("text"))
    hashed = settle(
        texts(docs).select("doc_id", F.xxhash64(clean).alias("h"), F.unhex(F.sha2(clean, 256)).alias("sha")), "exact"
    )
    maybe = repeat_filter(hashed.select("h"), filter_bits)
    marked = hashed.withColumn("maybe", maybe("h"))
    single = marked.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "sha"
    )
    rest = marked.where("maybe").select("doc_id", "sha")
    groups = rest.groupBy("sha").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    return (
        single.unionByName(rest.join(groups, "sha"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))
    )


def keep_first(docs: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    clean = normalised(F.coalesce(F.col("text"), F.lit("")))
    h, maybe_name = spare(docs, "text_hash"), spare(docs, "maybe")
    maybe = repeat_filter(docs.select(F.xxhash64(clean).alias("h")), filter_bits)
    marked = docs.withColumn(h, F.xxhash64(clean)).withColumn(maybe_name, maybe(h))
    rows = [F.col(f"`{c}`") for c in docs.columns]
    first = F.min_by(F.struct(*rows), F.struct(F.col("doc_id").isNull(), F.col("doc_id")))
    rest = marked.where(F.col(maybe_name)).groupBy(F.sha2(clean, 256).alias("sha")).agg(first.alias("row"))
    return marked.where(~F.col(maybe_name)).select(*rows).unionByName(rest.select("row.*"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(table(spark, sf_dir, "documents"))


QUERIES = {"op7_exact_dedup": op7_exact_dedup}
ORACLES = {
    "op7_exact_dedup": r"""
with t as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as clean from documents
), g as (
  select doc_id, clean, min(doc_id) over (partition by clean) as keep_id, count(*) over (partition by clean) as group_size from t
)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, sha256(clean) as text_sha256 from g
"""
}
