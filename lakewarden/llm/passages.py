"""Fixed-length strings that occur more than once, over whole texts and without pairs.

Both passage operators ask which windows of a fixed length (20 words, 200
bytes) occur again. A window's *seed* is the smallest Rabin-Karp hash of the
short grams in it, so equal windows have equal seeds, and consecutive windows
mostly share one. A *run* is a stretch of consecutive windows of one document
whose seed stands at the same place; its hash covers all its text.

1. Runs are counted by seed. A seed that only one run has belongs to windows
   that occur once, and its run goes no further.
2. The rest are grouped by (seed, run hash): equal runs repeat window by window
   and are settled by one row, the first of them, however many there are.
3. Only the distinct runs are looked into, window by window, as each operator
   needs.

Every step is a grouping that combines before it shuffles, or a join that
adaptive execution splits; no group of rows is ever collected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lakewarden.llm.common import settle, texts

PLACE = np.uint64((1 << 24) - 1)  # low bits of a hash that give way to its place
CHUNK = 1 << 23                   # windows looked at together, few enough for a place
SEEDS = (0x5DEECE66D, 0x2545F4914F6CDD1D)  # of the two independent hash functions


def _is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Tables:
    """Letter values and powers of one hash function, lengthened as texts need them."""

    def __init__(self, which: int = 0):
        self.letters = np.random.default_rng(SEEDS[which]).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
        self.base = (SEEDS[which] * 0x9E3779B97F4A7C15 | 5) % (1 << 64)
        self.power = self.back = np.zeros(0, np.uint64)

    def reach(self, length: int) -> None:
        if length > len(self.power):
            size = max(1 << 16, 2 * length)
            self.power = np.cumprod(np.full(size, self.base, np.uint64))
            self.back = np.cumprod(np.full(size, pow(self.base, -1, 1 << 64), np.uint64))


class Rolling:
    """Rabin-Karp hashes modulo 2**64 of any parts of a byte array."""

    def __init__(self, data: np.ndarray, tables: Tables):
        tables.reach(len(data) + 1)
        self.back = tables.back
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(tables.letters[data] * tables.power[: len(data)], out=self.sums[1:])

    def parts(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.back[start]
        return mixed(raw + (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def every(self, length: int) -> np.ndarray:
        """Of all parts of one length, by start."""
        raw = (self.sums[length:] - self.sums[:-length]) * self.back[: len(self.sums) - length]
        return mixed(raw + np.uint64(length * 0x9E3779B97F4A7C15 % (1 << 64)))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, by start."""
    out, have = x, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


@dataclass(frozen=True)
class Units:
    """A text as the units that windows count: words or bytes."""

    window: int
    gram: int
    words: bool

    def cut(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes that are hashed, and each unit's start and end in them.

        Of words the separating white space becomes one space.
        """
        data = np.frombuffer(raw, np.uint8)
        if not self.words:
            at = np.arange(len(data))
            return data, at, at + 1
        space = _is_space(data)
        keep = ~space
        keep[1:] |= ~space[:-1]  # the first white space after a word
        data = np.where(space, np.uint8(32), data)[keep]
        inside = np.concatenate([[False], data != 32, [False]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        return data, edge[::2], edge[1::2]

    def spans(self, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, units: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        return starts[first], ends[first + units - 1]


def runs_of(raw: bytes, units: Units, tables: Tables) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(seed, run hash, first window, windows) of each run of a text."""
    data, starts, ends = units.cut(raw)
    windows = len(starts) - units.window + 1
    if windows < 1:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    hashes = Rolling(data, tables)
    if units.words:
        first = np.arange(len(starts) - units.gram + 1)
        grams = hashes.parts(*units.spans(starts, ends, first, units.gram))
    else:
        grams = hashes.every(units.gram)
    width = units.window - units.gram + 1
    found = []
    for low in range(0, windows, CHUNK):
        high = min(windows, low + CHUNK)
        near = grams[low : high + width - 1]
        # Order by hash, then place: equal windows choose the same place within them, so a run has no two equal windows.
        least = sliding_min((near & ~PLACE) | np.arange(len(near), dtype=np.uint64), width)
        found.append((least & PLACE).astype(np.int64) + low)
    place = np.concatenate(found)
    cut = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    size = np.diff(np.append(cut, windows))
    run = hashes.parts(*units.spans(starts, ends, cut, size + units.window - 1))
    return grams[place[cut]].view(np.int64), run.view(np.int64), cut, size


RUNS = "seed long, run long, doc_id long, variant long, at long"
#: What tells a text from all others: see ``readable``.
KEY = ("doc_id", "variant")
#: ``at`` is first window * SIZES + windows, one number to shuffle in place of two.
SIZES = 1 << 12
HOT_SEEDS = 1000
SPREAD = 64


def runs(docs: DataFrame, units: Units) -> DataFrame:
    """(seed, run, doc_id, variant, at) of all runs of all texts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables()
        for batch in batches:
            found = [runs_of(x.as_buffer().to_pybytes(), units, tables) for x in batch.column(2)]
            sizes = [len(f[0]) for f in found]
            ids, variants = (np.repeat(batch.column(c).to_numpy(zero_copy_only=False), sizes) for c in range(2))
            seed, run, first, size = (np.concatenate([f[i] for f in found]) for i in range(4))
            columns = (seed, run, ids, variants, first * SIZES + size)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["seed", "run", *KEY, "at"])

    return docs.select(*KEY, "raw").mapInArrow(cut, RUNS)


def readable(docs: DataFrame) -> DataFrame:
    """doc_id, variant and the text's bytes of the rows that have a doc_id.

    ``variant`` tells different texts of one doc_id apart: the text's hash, or 0
    where a doc_id has one text only, which costs the shuffles nothing. The doc_ids with
    several texts are written first, so Spark broadcasts them only if they are few.
    """
    # A cast that does nothing would leave a new name in one use of the rows and none in another, and the texts shuffled for each.
    doc_id = F.col("doc_id") if docs.schema["doc_id"].dataType == T.LongType() else F.col("doc_id").cast("long")
    rows = texts(docs).where(F.col("doc_id").isNotNull()).select(doc_id, F.encode("text", "UTF-8").alias("raw"))
    text_hash = F.xxhash64("raw")
    several = rows.groupBy("doc_id").agg(F.min(text_hash).alias("low"), F.max(text_hash).alias("high")).where("low <> high")
    told = settle(several.select("doc_id", F.lit(True).alias("several")), "variants")
    variant = F.when(F.col("several"), text_hash).otherwise(F.lit(0).cast("long"))
    return rows.join(told, "doc_id", "left").select("doc_id", variant.alias("variant"), "raw")


def nameless(docs: DataFrame) -> DataFrame:
    """The rows without doc_id in the columns of ``readable``; they take no part."""
    none = F.lit(None).cast("long")
    return texts(docs).where("doc_id is null").select(none.alias("doc_id"), none.alias("variant"), F.encode("text", "UTF-8").alias("raw"))


def with_parts(docs: DataFrame, named: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, raw, parts) of every row: its text and what was found in it, null if nothing."""
    parts = per_document(found, "first", "size")
    rest = nameless(docs).withColumn("parts", F.lit(None).cast(parts.schema["parts"].dataType))
    return named.join(parts, list(KEY), "left").select("doc_id", "raw", "parts").unionByName(rest.select("doc_id", "raw", "parts"))


def repeated_runs(docs: DataFrame, units: Units) -> DataFrame:
    """Runs whose seed occurs more than once: (seed, run, doc_id, variant, first, size), settled.

    Seeds with more than one in ``HOT_SEEDS`` of these runs, of which there are
    fewer than that, go to ``SPREAD`` tasks each; their list is all that is broadcast.
    """
    found = runs(docs, units)
    repeated = settle(found.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1"), "seeds")
    total = repeated.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    is_hot = F.col("n") > total / HOT_SEEDS
    hot = repeated.where(is_hot).select("seed", F.lit(True).alias("hot"))
    part = F.when(F.col("hot"), F.pmod(F.xxhash64(*KEY, "at"), F.lit(SPREAD)).cast("int")).otherwise(0)
    dealt = found.join(F.broadcast(hot), "seed", "left").withColumn("part", part)
    parts = F.when(is_hot, F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))
    kept = dealt.join(repeated.select("seed", F.explode(parts).alias("part")), ["seed", "part"], "left_semi")
    return settle(
        kept.select("seed", "run", *KEY, F.floor(F.col("at") / SIZES).alias("first"), (F.col("at") % SIZES).alias("size")), "runs"
    )


def distinct_runs(found: DataFrame) -> DataFrame:
    """One row per different run: its first place and how often it occurs."""
    place = F.struct(*KEY, "first", "size")
    return (
        found.groupBy("seed", "run").agg(F.min(place).alias("place"), F.count("*").alias("copies"))
        .select("seed", "run", "copies", "place.*")
    )


def per_document(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows of a document as one list, as long as its text at most."""
    return rows.groupBy(*KEY).agg(F.collect_list(F.struct(*columns)).alias("parts"))


def long_field(name: str) -> T.StructField:
    return T.StructField(name, T.LongType())


def merged(first: np.ndarray, stop: np.ndarray, length: int) -> np.ndarray:
    """Flags of the units that any of the spans covers."""
    places = np.arange(length + 1)
    opened = np.searchsorted(np.sort(first), places, "right")
    closed = np.searchsorted(np.sort(stop), places, "right")
    return (opened > closed)[:length]
