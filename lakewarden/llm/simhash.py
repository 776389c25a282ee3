"""SimHash near-dedup by the generalised pigeonhole.

A fingerprint bit is the majority of that bit over the 64-bit hashes of all
word shingles of a text. Two fingerprints are linked if they differ in at most
``distance`` bits; a document's component is the smallest doc_id that links
lead to.

Equal fingerprints are one node from the start, so copies never meet in a join.
The bits are grouped into partitions by their correlations, so that bits that
vary together do not make several partitions common at once. If the partitions'
thresholds add up to distance - partitions + 1, fingerprints within the distance
agree within the threshold on one partition at least (-1 leaves a partition
out). Dynamic programming picks the thresholds of least estimated candidates
from the counts of values that fingerprints share. Probing joins the values
within the threshold; each candidate is verified on all bits.

A value shared by more than ``CROWD`` fingerprints is not probed pair by pair.
Its fingerprints are linked exactly in another way: those within two bits have
a common neighbour at one bit, so each is listed under itself and its 64
neighbours, and all of one list are linked to its smallest. That takes 65 rows
per fingerprint however crowded the value is. (At an odd or larger distance the
lists hold all neighbours at half the distance, rounded up, and links are
verified.)

Components come from alternating large-star and small-star steps over tables
settled in the shared folder.

Defined cases: a null text counts as empty; texts without words have
fingerprint zero and are linked like any other; a text of fewer words than a
shingle has one shingle of all its words; a row without doc_id has a
fingerprint, links nothing, and belongs to the component of the documents with
its fingerprint, null if there is none.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakewarden.llm.common import settle, spare, table, texts

SHINGLE = 3
DISTANCE = 2
PARTITIONS = 3
CROWD = 64          # fingerprints of one partition value that are still compared with each other
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    words = text.encode().translate(LOWER).split()  # bytes split at exactly the white space asked for
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    whole = b" ".join(words)
    if n == 1:
        return xxhash.xxh64_intdigest(whole, 42)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[: n - 1].tolist()]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(whole[a:b], 42) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())])
    ones = np.zeros(64, np.int64)
    data = np.frombuffer(hashes, np.uint8).reshape(n, 8)
    for at in range(0, n, 1 << 16):  # unpacked bits of a bounded number of shingles
        ones += np.unpackbits(data[at : at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the 64 bits as a long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    rows = texts(docs)
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], T.StructField("fp", T.LongType())]))


def correlated_partitions(size: int, ones: np.ndarray, both: np.ndarray, parts: int = PARTITIONS) -> list[list[int]]:
    """Bit places of each partition, of about equal size.

    Each partition starts at the free bit that varies most and takes, one by
    one, the free bit most correlated with it.
    """
    share = ones / max(1, size)
    spread = np.sqrt(share * (1 - share))
    bond = np.abs(both / max(1, size) - np.outer(share, share)) / np.maximum(np.outer(spread, spread), 1e-9)
    free, out = set(range(64)), []
    for part in range(parts):
        size = 64 // parts + (part < 64 % parts)
        own = [max(free, key=lambda b: (spread[b], -b))]
        free.remove(own[0])
        while len(own) < size:
            take = max(free, key=lambda b: (bond[b, own].mean(), -b))
            own.append(take)
            free.remove(take)
        out.append(sorted(own))
    return out


def allocate(costs: Sequence[Sequence[float]], total: int) -> list[int]:
    """Threshold per partition (from -1) that add up to ``total`` at least cost.

    ``costs[i][t + 1]`` is the estimate for partition i at threshold t.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for own in costs:
        reached: dict[int, tuple[float, list[int]]] = {}
        for have, (cost, chosen) in best.items():
            for t, more in enumerate(own, start=-1):
                if have + t not in reached or cost + more < reached[have + t][0]:
                    reached[have + t] = (cost + more, [*chosen, t])
        best = reached
    return best[total][1]


def value(fp: Column, places: Sequence[int]) -> Column:
    mask = sum(1 << p for p in places)
    return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


def flips(places: Sequence[int], most: int) -> list[int]:
    """Masks of all ways to turn at most so many of the given bits, as signed longs."""
    masks = [sum(1 << p for p in chosen) for k in range(most + 1) for chosen in itertools.combinations(places, k)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def around(fp: Column, masks: Sequence[int]) -> Column:
    return F.transform(F.array(*[F.lit(m) for m in masks]), lambda m: fp.bitwiseXOR(m))


def correlations(nodes: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of fingerprints, how many have each bit, how many have both of two bits."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((64, 64), np.int64), 0
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            bits = ((fps[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
            both += np.rint(bits.T @ bits).astype(np.int64)
            n += len(fps)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(np.arange(4096), -1)), pa.array(np.append(both.ravel(), n))], ["cell", "n"]
        )

    cells = nodes.select("fp").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    found = {r["cell"]: r["n"] for r in cells}
    both = np.array([found.get(i, 0) for i in range(4096)], float).reshape(64, 64)
    return found.get(-1, 0), both.diagonal(), both


def _steer(nodes: DataFrame, distance: int) -> tuple[list[list[int]], list[int]]:
    """Partitions and their thresholds, from counts over all fingerprints."""
    size, ones, both = correlations(nodes)
    parts = correlated_partitions(size, ones, both)
    shared = [  # pairs of fingerprints with the same value, over all fingerprints
        nodes.groupBy(value(F.col("fp"), p).alias("v")).agg(F.count("*").cast("double").alias("n")).agg(F.sum(F.col("n") * F.least(F.col("n") - 1, F.lit(float(CROWD)))))
        .first()[0] or 0.0
        for p in parts
    ]
    costs = []
    for places, pairs in zip(parts, shared):
        near = [sum(1 for _ in itertools.combinations(places, k)) for k in range(distance + 1)]
        # A probe row costs like a candidate; turning bits multiplies probes, and candidates by as many values.
        costs.append([0.0] + [(size + pairs) * sum(near[: t + 1]) for t in range(distance + 1)])
    return parts, allocate(costs, distance - len(parts) + 1)


def links(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Linked nodes (a, b) with a < b, from rows (node, fp) of different fingerprints."""
    parts, thresholds = _steer(nodes, distance)
    near = lambda x, y: F.bit_count(x.bitwiseXOR(y)) <= distance
    found, crowded = None, None
    for places, most in zip(parts, thresholds):
        if most < 0:
            continue
        shown = nodes.withColumn("v", value(F.col("fp"), places))
        crowds = shown.groupBy("v").agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select("v")
        close = shown.join(crowds, "v", "left_anti")
        if most:  # partners of a crowded value may have another value
            crowds = crowds.select(F.explode(around(F.col("v"), flips(places, most))).alias("v")).distinct()
        thick = shown.join(crowds, "v", "left_semi").select("node", "fp")
        probe = close.select("node", "fp", F.explode(around(F.col("v"), flips(places, most))).alias("v")) if most else close
        pairs = (
            probe.select("v", F.col("node").alias("a"), F.col("fp").alias("fa"))
            .join(close.select("v", F.col("node").alias("b"), F.col("fp").alias("fb")), "v")
            .where((F.col("a") < F.col("b")) & near(F.col("fa"), F.col("fb")))
            .select("a", "b")
        )
        found = pairs if found is None else found.unionByName(pairs)
        crowded = thick if crowded is None else crowded.unionByName(thick)
    half = (distance + 1) // 2
    listed = crowded.distinct().select("node", "fp", F.explode(around(F.col("fp"), flips(range(64), half))).alias("v"))
    if 2 * half == distance:  # any two of one list are within the distance
        heads = listed.groupBy("v").agg(F.min("node").alias("head"), F.collect_set("node").alias("all")).where(F.size("all") > 1)
        lists = heads.select(F.col("head").alias("a"), F.explode("all").alias("b")).where("a < b")
    else:
        both = listed.select("v", F.col("node").alias("a"), F.col("fp").alias("fa")).join(
            listed.select("v", F.col("node").alias("b"), F.col("fp").alias("fb")), "v"
        )
        lists = both.where((F.col("a") < F.col("b")) & near(F.col("fa"), F.col("fb"))).select("a", "b")
    return found.unionByName(lists).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of an edge (a, b): the smallest node that edges lead to."""
    state = settle(edges.select(F.col("b").alias("u"), F.col("a").alias("v")), "edges")  # u > v
    mark = None
    while True:
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        state = settle(small.unionByName(low.select("u", F.col("m").alias("v"))).where("u > v").distinct(), "edges")
        now = tuple(state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            return state.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
        mark = now


def grouped(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fp and component_id of every row."""
    marked = settle(fingerprints(docs, shingle), "prints")
    nodes = settle(marked.groupBy("fp").agg(F.min("doc_id").alias("node")).where("node is not null"), "nodes")
    roots = components(links(nodes, distance))
    placed = nodes.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("component_id"))
    return marked.join(placed, "fp", "left").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each component with all its columns: the one whose doc_id names it.

    Rows without doc_id stay if no document with one has their fingerprint, one
    for each fingerprint; of rows with the same doc_id one stays.
    """
    found = grouped(docs, shingle, distance)
    stay = found.where("doc_id = component_id").select("doc_id").distinct()
    rows = [F.col(f"`{c}`") for c in docs.columns]
    named = docs.where("doc_id is not null").join(stay, "doc_id", "left_semi").select(*rows).dropDuplicates(["doc_id"])
    if not found.where("doc_id is null and component_id is null").take(1):
        return named
    fp, text = spare(docs, "fp"), F.col("text")
    shown = F.udf(lambda t: int(np.uint64(fingerprint(t or "", shingle)).view(np.int64)), "long")
    lone = found.where("doc_id is null and component_id is null").select(F.col("fp").alias(fp)).distinct()
    nameless = docs.where("doc_id is null").withColumn(fp, shown(text)).dropDuplicates([fp]).join(lone, fp, "left_semi")
    return named.unionByName(nameless.select(*rows))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = grouped(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES = {"op6_simhash": op6_simhash}
ORACLES: dict[str, str] = {}
