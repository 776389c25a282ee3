"""Substring dedup: repeated windows of words merge into maximal removal intervals.

Every window of a fixed number of consecutive words is told by its Rabin-Karp
hash. A window goes if the same words also start earlier: in a document with a
smaller doc_id, or before it in the same document. Windows are judged on the
input. Windows that cannot repeat, by their seeds, are ruled out in one count
(``passages``); runs of windows equal to an earlier run are settled as a whole;
the windows of seeds with several different runs are counted one by one, by
two independent 64-bit hashes.

Defined cases: a null text counts as empty, without words; a text shorter than
the window keeps all its words; a row without doc_id takes no part and keeps
all; rows with the same doc_id and text share their removals, and none of them
counts as earlier than the other; different texts of one doc_id are documents of
their own, in the order of their xxhash64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakewarden.llm.common import table
from lakewarden.llm.passages import (
    KEY, Rolling, Tables, Units, distinct_runs, long_field, merged, per_document, readable, repeated_runs, with_parts,
)

WINDOW = 20  # words
GRAM = 5     # words of a seed's grams

WINDOWS = "h1 long, h2 long, doc_id long, variant long, first long"
PLACE = (*KEY, "first")


def _windows(rows: DataFrame, units: Units) -> DataFrame:
    """Hashes of all windows of the given runs: rows (doc_id, variant, raw, parts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = [Tables(0), Tables(1)]
        for batch in batches:
            for doc_id, variant, raw, parts in zip(*(c.to_pylist() for c in batch.columns)):
                data, starts, ends = units.cut(raw)
                first = np.concatenate([np.arange(p["first"], p["first"] + p["size"]) for p in parts])
                first = np.unique(first[first + units.window <= len(starts)])
                hashes = [Rolling(data, t).parts(*units.spans(starts, ends, first, units.window)).view(np.int64) for t in both]
                key = [np.full(len(first), k, np.int64) for k in (doc_id, variant)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*hashes, *key, first)], ["h1", "h2", *PLACE])

    return rows.mapInArrow(run, WINDOWS)


def removals(raw: DataFrame, window: int = WINDOW) -> DataFrame:
    """Repeated windows of readable texts as (doc_id, variant, first, size): first window and number of consecutive windows."""
    units = Units(window, min(GRAM, window), True)
    found = repeated_runs(raw, units)
    different = distinct_runs(found)
    again = (
        found.join(different.select("seed", "run", F.struct(*PLACE).alias("place")), ["seed", "run"])
        .where(F.struct(*PLACE) > F.col("place"))
        .select(*PLACE, "size")
    )
    several = different.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1").select("seed")
    looked = different.join(several, "seed", "left_semi")  # runs that are all equal have been settled
    rows = raw.join(per_document(looked, "first", "size"), list(KEY))
    windows = _windows(rows.select(*KEY, "raw", "parts"), units)
    earliest = windows.groupBy("h1", "h2").agg(F.min(F.struct(*PLACE)).alias("place"), F.count("*").alias("n"))
    later = (
        windows.join(earliest.where("n > 1").select("h1", "h2", "place"), ["h1", "h2"])
        .where(F.struct(*PLACE) > F.col("place"))
        .select(*PLACE, F.lit(1).cast("long").alias("size"))
    )
    return again.unionByName(later)


KEPT = "n_words long, n_removed long, kept string"


def remove(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words joined by one space, of every row."""
    units = Units(window, min(GRAM, window), True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, gone, kept = [], [], []
            for raw, parts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data, starts, ends = units.cut(raw)
                n = len(starts)
                if parts:
                    first = np.array([p["first"] for p in parts])
                    stop = first + np.array([p["size"] for p in parts]) + window - 1
                    flags = merged(first, stop, n)
                    text = data.tobytes()
                    keep = np.flatnonzero(~flags)
                    out = b" ".join([text[a:b] for a, b in zip(starts[keep].tolist(), ends[keep].tolist())])
                else:
                    flags, out = np.zeros(0, bool), data.tobytes().strip(b" ")
                counts.append(n)
                gone.append(int(flags.sum()))
                kept.append(out)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    out = T.StructType([long_field("doc_id"), *T.StructType.fromDDL(KEPT)])
    named = readable(docs)  # shuffled once for the windows and for this join
    return with_parts(docs, named, removals(named, window)).mapInArrow(run, out)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op4_substring_dedup": op4_substring_dedup}
ORACLES = {
    "op4_substring_dedup": r"""
with w as (
  select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words from documents
), s as (
  select doc_id, words, unnest(range(1, len(words) - 18)) as p from w
), h as (
  select doc_id, p, md5(array_to_string(words[p : p + 19], ' ')) as h from s
), f as (
  select h, min((doc_id, p)) as first from h group by h having count(*) > 1
), d as (
  select h.doc_id, list(h.p) as starts from h join f using (h) where (h.doc_id, h.p) > f.first group by h.doc_id
), c as (
  select doc_id, list(distinct q) as gone from (select doc_id, unnest(range(p, p + 20)) as q from (select doc_id, unnest(starts) as p from d)) group by doc_id
), k as (
  select w.doc_id, words, coalesce(gone, []) as gone from w left join c using (doc_id)
)
select doc_id, cast(len(words) as bigint) as n_words, cast(len(gone) as bigint) as n_removed
  , sha256(coalesce(array_to_string(list_filter(words, lambda x, i: not list_contains(gone, i)), ' '), '')) as kept_sha256
from k
"""
}
