"""Near copies: SimHash, then exact similarity; five-word shingle sets with Jaccard 0.8 or more.

SimHash comes first, by the generalised pigeonhole of ``simhash`` as in
op6_simhash: a document's fingerprint over its five-word shingles is partitioned,
probed and verified on its bits, and every pair that this links is verified on
the whole sets. A similarity of 0.8 lies near ten of 64 bits, too far to probe
for, so what the prints do not link is left to the sets themselves, and only
between documents that are still in different components.

Pigeonhole on sets: if two sets are similar enough, then in one order of all
shingles their first n - ceil(0.8 n) + 1 shingles have one in common. These
prefixes meet in a join; a pair that can still reach the similarity at the
places where it meets is a candidate, and each candidate is verified on the
whole sets. So recall and precision are one, but for collisions of 64 bits.

The order puts shingles that repeat last, the most frequent at the very end,
so that common passages meet only where a text has little else. Their counts
come from batches of documents; they steer the order alone, and any order
gives the same links.

Before two documents become a candidate, bitmaps of their sets are compared in
the task that has them in one list: each shingle flips one of 1,024 bits, so the
bits that differ are at most the shingles that differ, and a pair over the limit
in bits is over it in shingles. Nothing similar is lost by that. What is left is
mostly similar, and many links of a crowd say the same: neighbours in each list
are verified first, then of each document the nearest ones in other components,
and last all pairs whose documents are still in different components.

A list is never held whole. Shingles known to be frequent are dealt to several
tasks by documents, lists stream by and are numbered in blocks, and a list of
several blocks is compared block with block, each pair of blocks on its own.

Defined cases: letters A-Z count as small; a null text counts as empty; texts
without words are copies of each other; a text of fewer words than a shingle
has one shingle of all its words; rows of one doc_id are one document, near to
what any of its texts is near to, and the one of them with the least text, then
the least other columns as JSON, stays; rows without doc_id link nothing and
stay, the least in the same order for each set, if no document with a doc_id has
it.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T

from lakewarden.llm.common import settle, spare, texts
from lakewarden.llm.simhash import DISTANCE, LOWER, components, fingerprints, links

WORDS = 5
OF, PART = 5, 4        # similarity: PART / OF
BITS = 1024            # of the bitmap of a set
BLOCK = 2048           # rows of a list that are compared at once
SALTED = 16_384        # counted rows of a shingle per task that gets them
WHOLE = -1             # deal of a list that one task gets
NEIGHBOURS = 2         # of a list that are verified first
REPEATED = 8           # counted this often, a shingle goes behind the others
NEAREST = 1            # by bitmap, verified second
MOST_RANKED = 300_000  # shingles whose counts steer the order


def shingles(text: str) -> np.ndarray:
    """Hashes of the distinct shingles, ascending."""
    words = text.encode().translate(LOWER).split()  # bytes split at exactly the white space asked for
    n = max(1, len(words) - WORDS + 1)
    whole = b" ".join(words)
    digest = xxhash.xxh64_digest
    if n == 1:
        return np.frombuffer(digest(whole, 42), np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[: n - 1].tolist()]
    hashes = b"".join([digest(whole[a:b], 42) for a, b in zip(starts, (ends[WORDS - 1 :] - 1).tolist())])
    return np.unique(np.frombuffer(hashes, np.uint64))


def alike(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return OF * both >= PART * (len(x) + len(y) - both)


def set_key(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def bitmap(found: np.ndarray) -> bytes:
    """One bit per place, turned once by each shingle that falls on it."""
    return np.packbits(np.bincount((found % BITS).astype(np.int64), minlength=BITS) & 1).tobytes()


def mark(key: bytes) -> int:
    """A set's key as a number, short enough to be carried in every row of a list."""
    return int.from_bytes(key[:8], "little", signed=True)


def survey(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, set, mark, bits) of every document, and rows (shingle, n) of those that repeat within a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t) for t in batch.column(1).to_pylist()]
            if not sets:
                continue
            found, n = np.unique(np.concatenate(sets), return_counts=True)
            found, n = found[n > 1].view(np.int64), n[n > 1]
            none, more = len(sets), len(found)
            ids = pa.concat_arrays([batch.column(0), pa.nulls(more, batch.column(0).type)])
            keys = [set_key(s) for s in sets]
            named = [pa.array(keys + [None] * more, pa.binary()), pa.array([mark(k) for k in keys] + [None] * more, pa.int64()),
                     pa.array([bitmap(s) for s in sets] + [None] * more, pa.binary())]
            seen = pa.concat_arrays([pa.nulls(none, pa.int64()), pa.array(found)])
            counts = pa.concat_arrays([pa.nulls(none, pa.int64()), pa.array(n, pa.int64())])
            yield pa.RecordBatch.from_arrays([ids, *named, seen, counts], ["doc_id", "set", "mark", "bits", "shingle", "n"])

    rows = texts(docs)
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL("set binary, mark long, bits binary, shingle long, n long")]))


def prefixes(docs: DataFrame, ranked: DataFrame) -> DataFrame:
    """(shingle, deal, node, mark, n, left): shingles of each document's prefix, the size of its set, and how many are left from there.

    ``deal`` spreads a shingle counted often over several tasks; others are WHOLE.
    """
    last = ranked.toArrow()
    keys, counts = last["shingle"].to_numpy().view(np.uint64), last["n"].to_numpy()
    order = np.argsort(keys)
    shared = docs.sparkSession.sparkContext.broadcast((keys[order], counts[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = shared.value
        for batch in batches:
            heads, often, sizes, marks = [], [], [], []
            for text in batch.column(1).to_pylist():
                own = shingles(text)
                name = mark(set_key(own))
                times = np.zeros(len(own), np.int64)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                    times = np.where(keys[at] == own, counts[at], 0)
                took = np.argsort(times, kind="stable")[: len(own) - -(-PART * len(own) // OF) + 1]
                heads.append(own[took])
                deals = 1 + times[took] // SALTED
                often.append(np.where(deals > 1, name % deals, WHOLE))
                sizes.append(len(own))
                marks.append(name)
            if not heads:
                continue
            took = np.array([len(h) for h in heads])
            place = np.arange(took.sum()) - np.repeat(np.cumsum(took) - took, took)
            n = np.repeat(np.array(sizes), took)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(heads).view(np.int64)), pa.array(np.concatenate(often), pa.int32()),
                 batch.column(0).take(pa.array(np.repeat(np.arange(len(took)), took))), pa.array(np.repeat(np.array(marks, np.int64), took)),
                 pa.array(n, pa.int32()), pa.array(n - place, pa.int32())], ["shingle", "deal", "node", "mark", "n", "left"])

    rows = texts(docs.where("doc_id is not null"))
    kind = T.StructField("node", rows.schema["doc_id"].dataType)
    made = T.StructType([*T.StructType.fromDDL("shingle long, deal int"), kind, *T.StructType.fromDDL("mark long, n int, left int")])
    return rows.mapInArrow(run, made)


def in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of their lists, with the number of their block; without those alone in their list or equal to the row before."""
    held, done = None, 0  # rows of the list that may go on, and the blocks of it given out

    def given(rows: pa.RecordBatch, blocks: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*rows.columns, pa.array(blocks.astype(np.int32))], [*rows.schema.names, "block"])

    for batch in itertools.chain(batches, [None]):
        rows = held if batch is None else batch if held is None else pa.concat_batches([held, batch])
        if rows is None or not rows.num_rows:
            continue
        key, deal, name = (rows.column(i).to_numpy() for i in (0, 1, 3))
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (deal[1:] != deal[:-1]) | (name[1:] != name[:-1])])
        rows, key, deal = rows.filter(pa.array(fresh)), key[fresh], deal[fresh]
        starts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (deal[1:] != deal[:-1])]))
        size = np.diff(np.append(starts, len(key)))
        place = np.arange(len(key)) - np.repeat(starts, size)
        blocks = place // BLOCK + np.where(np.arange(len(key)) < size[0], done, 0)
        stays = (np.repeat(size, size) > 1) | (deal != WHOLE) | (blocks > 0)
        ends = len(key)
        full = 0 if batch is None else int(size[-1] - 1) // BLOCK
        if batch is not None:  # the last list may go on: its full blocks are given out, a row or more waits
            ends = int(starts[-1]) + full * BLOCK
        out = np.flatnonzero(stays[:ends])
        if len(out):
            yield given(rows.take(pa.array(out)), blocks[out])
        held = rows.slice(ends)
        done = int(blocks[starts[-1]]) + full


def shown_bits(column: pa.Array) -> np.ndarray:
    """Bitmaps as rows of 64-bit words."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), BITS // 64)


def reachable(n, left, m, right):
    """Whether two sets that meet first with so many shingles left can be similar enough."""
    return (OF + PART) * np.minimum(left, right) >= PART * (n + m)


def differ(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bits in which bitmaps differ: at most the shingles that their sets do not share."""
    return np.bitwise_count(x ^ y).sum(axis=-1).astype(np.int64)


def whole(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Sorted rows cut only between groups that agree in the first columns, with the borders of the groups; none is larger than two blocks."""
    held = None
    for batch in itertools.chain(batches, [None]):
        rows = held if batch is None else batch if held is None else pa.concat_batches([held, batch])
        if rows is None or not rows.num_rows:
            continue
        at = np.stack([rows.column(i).to_numpy() for i in range(keys)])
        edges = np.concatenate([[0], np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1, [rows.num_rows] if batch is None else []]).astype(np.int64)
        if len(edges) > 1:
            yield rows.slice(0, int(edges[-1])), edges
        held = rows.slice(int(edges[-1])) if batch is not None else None


def first_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of neighbours in each block, whose order is another one in each list."""
    for rows, edges in whole(batches, 3):
        group = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
        node, n, left, bits = rows.column(3), rows.column(4).to_numpy(), rows.column(5).to_numpy(), shown_bits(rows.column(6))
        for step in range(1, NEIGHBOURS + 1):
            one = np.flatnonzero(group[:-step] == group[step:])
            two = one + step
            ok = reachable(n[one], left[one], n[two], left[two])
            one, two = one[ok], two[ok]
            ok = (OF + PART) * differ(bits[one], bits[two]) <= (OF - PART) * (n[one] + n[two])
            yield pa.RecordBatch.from_arrays([node.take(pa.array(one[ok])), node.take(pa.array(two[ok]))], ["a", "b"])


def other_pairs(nearest: int | None):
    """Pairs of each two blocks of a list whose documents are in different components; of each document the nearest by bitmap, or all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, edges in whole(batches, 3):
            node, n, left, bits = rows.column(3), rows.column(4).to_numpy(), rows.column(5).to_numpy(), shown_bits(rows.column(6))
            block, roots = rows.column(7).to_numpy(), rows.column(8).dictionary_encode().indices.to_numpy()
            los, his = rows.column(1).to_numpy(), rows.column(2).to_numpy()
            one, two = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
                root = roots[lo:hi]
                if (root == root[0]).all():
                    continue
                known, own, size = np.unique(root, return_inverse=True, return_counts=True)
                most = size.argmax()
                for i in np.flatnonzero(own != most).tolist():  # each pair has one outside the largest component
                    ok = (own != own[i]) & ((own == most) | (np.arange(hi - lo) > i))
                    if los[lo] != his[lo]:
                        ok &= block[lo:hi] != block[lo + i]
                    at = lo + np.flatnonzero(ok)
                    at = at[reachable(n[at], left[at], n[lo + i], left[lo + i])]
                    far = differ(bits[at], bits[lo + i])
                    close = np.flatnonzero((OF + PART) * far <= (OF - PART) * (n[at] + n[lo + i]))
                    if nearest is not None and len(close) > nearest:
                        close = close[np.argsort(far[close], kind="stable")[:nearest]]
                    one.append(np.full(len(close), lo + i)), two.append(at[close])
            yield pa.RecordBatch.from_arrays([node.take(pa.array(np.concatenate(one))), node.take(pa.array(np.concatenate(two)))], ["a", "b"])

    return run


def block_pairs(lists: DataFrame) -> DataFrame:
    """Each row of ``lists`` (shingle, at = number of its block) once for every two blocks of its list that it is in: lo and hi."""
    several = lists.groupBy("shingle").agg(F.min("at").alias("x"), F.max("at").alias("y")).where("x <> y").select("shingle")
    every = lists.join(several, "shingle", "left_semi").select("shingle", "at").distinct()
    other = every.groupBy("shingle").agg(F.collect_list("at").alias("blocks"))  # a block stands for BLOCK rows
    both = lists.join(other, "shingle", "left").withColumn("other", F.explode(F.coalesce("blocks", F.array("at"))))
    return both.withColumn("lo", F.least("at", "other")).withColumn("hi", F.greatest("at", "other")).drop("blocks", "other")


def in_order(pairs: DataFrame) -> DataFrame:
    return pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lru_cache(512)(shingles)
        for batch in batches:
            keep = [alike(own(x), own(y)) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    needed = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    read = settle(texts(docs).join(needed, "doc_id", "left_semi"), "near-texts")
    both = pairs.join(read.select(F.col("doc_id").alias("a"), F.col("text").alias("one")), "a").join(
        read.select(F.col("doc_id").alias("b"), F.col("text").alias("two")), "b")
    return settle(both.select("a", "b", "one", "two").mapInArrow(run, pairs.schema), "near-links").distinct()


def print_pairs(docs: DataFrame) -> DataFrame:
    """Pairs (a, b) that SimHash links: those of one print each with the first, and the first ones of prints within ``DISTANCE`` bits."""
    marked = settle(fingerprints(docs.where("doc_id is not null"), WORDS), "near-prints")
    nodes = settle(marked.groupBy("fp").agg(F.min("doc_id").alias("node")), "near-nodes")
    equal = marked.join(nodes, "fp").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    return in_order(equal.unionByName(links(nodes, DISTANCE)))


def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose documents are in different components."""
    for side in ("a", "b"):
        pairs = pairs.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root")), side, "left")
    return pairs.where(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).select("a", "b")


def edges(docs: DataFrame, seen: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, whose components are those of all near copies."""
    named = seen.where("set is not null and doc_id is not null").select("doc_id", "set")
    heads = named.groupBy("set").agg(F.min("doc_id").alias("a"), F.count("*").alias("n")).where("n > 1")
    equal = named.join(heads, "set").where("doc_id > a").select("a", F.col("doc_id").alias("b"))
    bits = seen.where("set is not null").select("mark", "bits").groupBy("mark").agg(F.first("bits").alias("bits"))  # one set, one bitmap
    counted = seen.where("shingle is not null").groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= REPEATED)
    rows = prefixes(docs, counted.orderBy(F.desc("n"), "shingle").limit(MOST_RANKED))
    node = rows.schema["node"].dataType
    pair = T.StructType([T.StructField("a", node), T.StructField("b", node)])
    made = T.StructType([*rows.schema, T.StructField("block", T.IntegerType())])
    dealt = rows.repartition("shingle", "deal").sortWithinPartitions("shingle", "deal", "n", "mark", "node")
    lists = settle(dealt.mapInArrow(in_blocks, made), "near-lists").withColumn("at", (F.col("deal") + 1).cast("long") * 2**32 + F.col("block"))
    beside = lists.join(bits, "mark").select("shingle", "deal", "block", "node", "n", "left", "bits", "mark")
    order = F.xxhash64("mark", "shingle")
    near = beside.repartition("shingle", "deal", "block").sortWithinPartitions("shingle", "deal", "block", order, "node").mapInArrow(first_pairs, pair)
    found = equal.unionByName(verified(settle(print_pairs(docs), "near-pairs"), docs))
    found = found.unionByName(verified(settle(apart(in_order(near), components(found)), "near-pairs"), docs))
    for nearest in (NEAREST, None):
        placed = lists.join(components(found), "node", "left").withColumn("root", F.coalesce("root", "node"))
        span = placed.groupBy("shingle").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("rows"), F.min("at").alias("p"), F.max("at").alias("q"))
        short = (F.col("rows") <= NEIGHBOURS + 1) & (F.col("p") == F.col("q"))  # all pairs of such lists have been seen
        open_ = span.where((F.col("x") != F.col("y")) & ~short).select("shingle")
        left = settle(placed.join(open_, "shingle", "left_semi"), "near-mixed")
        both = block_pairs(left).join(bits, "mark").select("shingle", "lo", "hi", "node", "n", "left", "bits", "at", "root")
        more = both.repartition("shingle", "lo", "hi").sortWithinPartitions("shingle", "lo", "hi").mapInArrow(other_pairs(nearest), pair)
        found = found.unionByName(verified(settle(in_order(more), "near-pairs"), docs))
    return found


def least(rows: DataFrame, *keys: str) -> DataFrame:
    """Of the rows with equal keys the one with the least text, then the least other columns as JSON."""
    name = spare(rows, "place")
    order = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy("text", F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns])))
    return rows.withColumn(name, F.row_number().over(order)).where(F.col(name) == 1).drop(name)


def keep_one(docs: DataFrame) -> DataFrame:
    """Of the documents that near copies lead to from each other the one with the smallest doc_id, with all its columns."""
    seen = settle(survey(docs), "near-sets")
    found = seen.where("set is not null").select("doc_id", "set")
    gone = settle(components(edges(docs, seen)).where("node <> root").select(F.col("node").alias("doc_id")), "near-gone")
    kept = docs.where("doc_id is not null").join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    if found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").take(1):
        kept = least(kept, "doc_id")
    if not found.where("doc_id is null").take(1):
        return kept
    key = spare(docs, "set")
    shown = F.udf(lambda t: set_key(shingles(t or "")), "binary")
    taken = found.where("doc_id is not null").select(F.col("set").alias(key)).distinct()
    nameless = least(docs.where("doc_id is null").withColumn(key, shown("text")), key).join(taken, key, "left_anti")
    return kept.unionByName(nameless.select(*kept.columns))
