"""Suffix-array dedup over a run-length index.

Removes every byte that a string of a fixed number of bytes covers which also
starts anywhere else, in the same text or another. Matches do not cross texts.

``passages`` rules out text that cannot repeat and brings the different runs of
one seed to one shard. A shard's index is the Burrows-Wheeler transform of its
runs, compressed to runs of equal letters, with the suffix-array places at both
ends of each run. Only at those ends is a longest common prefix compared
letter by letter; along the text it falls by one per step until the next
sampled place, which gives every place's matching statistics towards both
neighbours in one stream. A place whose longest match reaches the length is
marked. Copies of a run count once in the index, which is what keeps it small
for repetitive corpora.

A seed with more different runs than ``HOT`` is not given to one task: its
windows are counted by two independent hashes in Spark instead, cell by cell
and then one by one, which finds the same windows.

Defined cases: a null text counts as empty; a text shorter than the length
keeps all; a row without doc_id takes no part and keeps all; rows with the same
doc_id and text count as copies of each other; different texts of one doc_id are
documents of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakewarden.llm.common import settle, table, text_bytes
from lakewarden.llm.passages import (
    KEY, PLACE, Rolling, Tables, Units, distinct_runs, long_field, merged, mixed, per_document, readable, repeated_runs, with_parts,
)

LENGTH = 200           # bytes
GRAM = 64              # bytes of a seed's grams
HOT = 1000             # different runs of a seed above which its windows are counted in Spark
CELL = 8               # neighbouring windows that are counted together first
SHARD_BYTES = 1 << 20  # of runs per shard and index


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order, by doubling; they must differ within ``depth`` symbols."""
    n = len(symbols)
    wide = int(symbols.max()) + 2
    padded = np.concatenate([symbols + 1, np.zeros(3, np.int64)])
    key = (padded[:n] * wide + padded[1 : n + 1]) * wide + padded[2 : n + 2]
    order, have = np.argsort(key), 3
    while True:
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        if have >= depth or rank[order[-1]] == n - 1:
            return order
        key = rank * (n + 1)
        key[: n - have] += rank[have:] + 1
        order, have = np.argsort(key), have * 2


class RunLengthIndex:
    """Run-compressed Burrows-Wheeler transform of texts, with samples at the ends of its runs."""

    def __init__(self, parts: list[bytes], length: int):
        sizes = np.array([len(p) for p in parts])
        n = int(sizes.sum()) + len(parts)
        ends = np.cumsum(sizes + 1) - 1
        self.starts = ends - sizes
        self.symbols = np.empty(n, np.int64)
        inside = np.ones(n, bool)
        inside[ends] = False
        self.symbols[inside] = np.frombuffer(b"".join(parts), np.uint8).astype(np.int64) + len(parts)
        self.symbols[ends] = np.arange(len(parts))  # every text ends in a symbol of its own
        self.length = length
        places = suffix_array(self.symbols, int(sizes.max()) + 1)
        letters = self.symbols[places - 1]
        heads = np.flatnonzero(np.concatenate([[True], letters[1:] != letters[:-1]]))
        tails = np.append(heads[1:], n) - 1
        self.letters, self.run_lengths = letters[heads], tails - heads + 1
        # Samples: suffixes whose match with the neighbour above, or below, does not follow from the place before.
        self.above = self._samples(places[heads[1:]], places[heads[1:] - 1])
        self.below = self._samples(places[tails[:-1]], places[tails[:-1] + 1])

    def _samples(self, at: np.ndarray, neighbour: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(at)
        at, neighbour = at[order], neighbour[order]
        n = len(self.symbols)
        common = np.zeros(len(at), np.int64)
        open_ = np.arange(len(at))
        while len(open_):  # each text's own end symbol stops a match
            a, b = at[open_] + common[open_], neighbour[open_] + common[open_]
            same = (a < n) & (b < n)
            same[same] = self.symbols[a[same]] == self.symbols[b[same]]
            open_ = open_[same]
            common[open_] += 1
        return at, common

    def _stream(self, samples: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Longest match with one neighbour for every place, from the samples."""
        at, common = samples
        places = np.arange(len(self.symbols))
        if not len(at):
            return np.zeros(len(places), np.int64)
        near = np.searchsorted(at, places, "right") - 1
        return np.where(near >= 0, common[near] - (places - at[near]), 0)

    def marks(self) -> np.ndarray:
        """Places whose match elsewhere reaches the length."""
        return np.maximum(self._stream(self.above), self._stream(self.below)) >= self.length


def _runs_text(rows: DataFrame) -> DataFrame:
    """The bytes of each different run: rows (doc_id, variant, raw, parts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, variant, raw, parts in zip(*(c.to_pylist() for c in batch.columns)):
                body = [raw[p["first"] : p["first"] + p["size"] + LENGTH - 1] for p in parts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([p["seed"] for p in parts], pa.int64()), pa.array([p["hot"] for p in parts], pa.bool_()),
                        pa.array([doc_id] * len(body), pa.int64()), pa.array([variant] * len(body), pa.int64()),
                        pa.array([p["first"] for p in parts], pa.int64()), pa.array(body, pa.binary()),
                    ],
                    ["seed", "hot", *KEY, "first", "body"],
                )

    return rows.select(*KEY, "raw", "parts").mapInArrow(run, "seed long, hot boolean, doc_id long, variant long, first long, body binary")


SPANS = "doc_id long, variant long, first long, size long"
SPAN = (*KEY, "first", "size")


def _indexed(group: pa.Table) -> pa.Table:
    """Marked windows of a shard's runs."""
    bodies = group.column("body").to_pylist()
    index = RunLengthIndex(bodies, LENGTH)
    hit = np.flatnonzero(index.marks())
    part = np.searchsorted(index.starts, hit, "right") - 1
    first = group.column("first").to_numpy()[part] + hit - index.starts[part]
    key = [group.column(k).to_numpy()[part] for k in KEY]
    if len(hit):  # consecutive windows as one span
        new = np.concatenate([[True], (part[1:] != part[:-1]) | (hit[1:] != hit[:-1] + 1)])
        head = np.flatnonzero(new)
        key, first, size = [k[head] for k in key], first[head], np.diff(np.append(head, len(hit)))
    else:
        size = hit
    return pa.table([pa.array(x, pa.int64()) for x in (*key, first, size)], names=list(SPAN))


CELL_ROWS = "core long, span long, doc_id long, variant long, first long, size long, hashes binary"


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of runs of hot seeds in cells of neighbouring places before the seed.

    ``core`` is the hash of the bytes that all windows of a cell have in common,
    however many of them the run has; ``span`` the hash of all bytes that those
    present cover; ``hashes`` two for each window.
    """
    both = [Tables(0), Tables(1)]
    width = LENGTH - GRAM + 1
    for batch in batches:
        for body, doc_id, variant, first in zip(*(batch.column(c).to_pylist() for c in ("body", *KEY, "first"))):
            data = np.frombuffer(body, np.uint8)
            one, two = (Rolling(data, t) for t in both)
            n = len(data) - LENGTH + 1
            seed = int(((one.every(GRAM)[:width] & ~PLACE) | np.arange(width, dtype=np.uint64)).argmin())
            cell = (seed - np.arange(n)) // CELL  # falls along the run
            low = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            high = np.append(low[1:], n) - 1
            nearest, farthest = seed - cell[low] * CELL, seed - cell[low] * CELL - CELL + 1  # starts of the cell's outer windows
            core = mixed(one.parts(nearest, farthest + LENGTH) + cell[low].astype(np.uint64))
            span = mixed(one.parts(low, high + LENGTH) + (seed - low).astype(np.uint64))
            hashes = np.stack([one.every(LENGTH), two.every(LENGTH)], axis=1)
            packed = [hashes[i : j + 1].tobytes() for i, j in zip(low, high)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(core.view(np.int64)), pa.array(span.view(np.int64)), pa.array(np.full(len(low), doc_id, np.int64)),
                    pa.array(np.full(len(low), variant, np.int64)), pa.array(first + low), pa.array(high - low + 1), pa.array(packed, pa.binary()),
                ],
                ["core", "span", *SPAN, "hashes"],
            )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cells' windows one by one."""
    for batch in batches:
        size = batch.column("size").to_numpy()
        hashes = np.frombuffer(b"".join(batch.column("hashes").to_pylist()), np.int64).reshape(-1, 2)
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(hashes[:, 0].copy()), pa.array(hashes[:, 1].copy()), *[pa.array(np.repeat(batch.column(k).to_numpy(), size)) for k in KEY],
                pa.array(np.repeat(batch.column("first").to_numpy(), size) + within),
            ],
            ["h1", "h2", *KEY, "first"],
        )


def counted(body: DataFrame) -> DataFrame:
    """Repeated windows of the runs of hot seeds, counted in Spark: (doc_id, variant, first, size).

    Cells whose core occurs once hold no repeated window; equal cells repeat as
    a whole; only the different cells of one core are taken apart into windows.
    """
    cells = settle(body.where("hot").mapInArrow(_cells, CELL_ROWS), "cells")
    spans = cells.groupBy("core", "span").agg(
        F.count("*").alias("n"), F.min_by(F.struct(*SPAN, "hashes"), F.struct(*KEY, "first")).alias("one")
    )
    whole = cells.join(spans.where("n > 1").select("core", "span"), ["core", "span"], "left_semi").select(*SPAN)
    several = spans.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core")
    windows = spans.join(several, "core", "left_semi").select("one.*").mapInArrow(_windows, "h1 long, h2 long, doc_id long, variant long, first long")
    twice = windows.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
    single = windows.join(twice, ["h1", "h2"], "left_semi").select(*KEY, "first", F.lit(1).cast("long").alias("size"))
    return whole.unionByName(single)


def removals(raw: DataFrame) -> DataFrame:
    """Repeated strings of readable texts as (doc_id, variant, first, size): first start and number of consecutive starts."""
    units = Units(LENGTH, GRAM, False)
    found = repeated_runs(raw, units)
    different = distinct_runs(found)
    copied = found.join(different.where("copies > 1").select("seed", "run"), ["seed", "run"]).select(*SPAN)
    crowd = different.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1").select("seed", (F.col("n") > HOT).alias("hot"))
    looked = per_document(different.join(crowd, "seed"), "seed", "first", "size", "hot")
    body = settle(_runs_text(raw.join(looked, list(KEY))), "suffix")
    shards = max(8, text_bytes(body, "body") // SHARD_BYTES)
    indexed = body.where("not hot").groupBy(F.pmod(F.hash("seed"), F.lit(shards)).alias("shard")).applyInArrow(_indexed, SPANS)
    return copied.unionByName(indexed).unionByName(counted(body))


KEPT = "n_bytes long, n_removed long, n_spans long, kept binary"


def remove(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the remaining bytes of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(4)]
            for raw, parts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                out, gone, spans = raw, 0, 0
                if parts:
                    first = np.array([p["first"] for p in parts])
                    flags = merged(first, first + np.array([p["size"] for p in parts]) + LENGTH - 1, len(raw))
                    gone = int(flags.sum())
                    spans = int((flags[1:] & ~flags[:-1]).sum()) + int(flags[:1].sum())
                    out = np.frombuffer(raw, np.uint8)[~flags].tobytes()
                for column, value in zip(columns, (len(raw), gone, spans, out)):
                    column.append(value)
            kinds = [pa.int64()] * 3 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
            )

    out = T.StructType([long_field("doc_id"), *T.StructType.fromDDL(KEPT)])
    named = readable(docs)
    return with_parts(docs, named, removals(named)).mapInArrow(run, out)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op5_suffix_dedup": op5_suffix_dedup}
ORACLES: dict[str, str] = {}
