"""Mixing sources to target weights: Pfair scheduling.

Each source's rows, in an order by hash, form blocks. Slots follow each other;
each takes one block. With weight w, block j (from 1) of a source is released
at slot floor((j - 1) / w) and due by slot ceil(j / w); of the released blocks
the one due first goes next. With weights that add up to one every block meets
its window, so after any number of slots a source is less than one block away
from its share.

Weights are multiples of 1 / resolution, so the schedule repeats after that
many slots. The driver works out one cycle, whatever the number of rows, and
the tasks place each block by its cycle and its place in the cycle. When a
source has no block left, a new phase begins with the weights of the others
scaled up; all rows are placed.

Rows of a source are ranked in pieces of bounded size by their hash, with the
counts of the pieces before added, so that a source with a third of all rows is
spread like any other.

Defined cases: a null source is a source of its own; a null text counts as
empty; rows that are equal in doc_id and text may take each other's place; a
source with weight zero, or not among given weights, follows at the end, in
order of name; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lakewarden.llm.common import spare, table

BLOCK = 16            # rows
RESOLUTION = 1000     # slots of a cycle, at least
PIECE = 2_000         # rows ranked in one group
MOST_SOURCES = 5_000  # what the driver schedules: at most so many sources
SHARE = 0.5           # without given weights: weight in proportion to rows to this power


def whole_weights(weights: Mapping, slots: int) -> dict:
    """Slots per cycle of each source in proportion to its weight, at least one, adding up to ``slots``."""
    total = sum(weights.values())
    exact = {s: w / total * slots for s, w in weights.items()}
    out = {s: max(1, math.floor(x)) for s, x in exact.items()}
    order = sorted(exact, key=lambda s: (out[s] - exact[s], str(s)))
    while sum(out.values()) < slots:
        for s in order[: slots - sum(out.values())]:
            out[s] += 1
    while sum(out.values()) > slots:  # least ones were raised to one
        s = max(out, key=lambda s: (out[s] - exact[s] if out[s] > 1 else -math.inf, str(s)))
        out[s] -= 1
    return out


def cycle(slots: Mapping) -> dict:
    """For each source the slots of its blocks within a cycle: earliest deadline first among the released."""
    length = sum(slots.values())
    order = {s: i for i, s in enumerate(sorted(slots, key=str))}
    waiting = [(0, order[s], s, 1) for s in slots]  # release, tie, source, block
    heapq.heapify(waiting)
    ready: list = []
    out: dict = {s: [] for s in slots}
    for slot in range(length):
        while waiting and waiting[0][0] <= slot:
            _, tie, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-j * length // slots[s]), tie, s, j))
        _, tie, s, j = heapq.heappop(ready)
        out[s].append(slot)
        if j < slots[s]:
            heapq.heappush(waiting, (j * length // slots[s], tie, s, j + 1))
    return out


def phases(blocks: Mapping, weights: Mapping, resolution: int) -> list[tuple]:
    """(source, phase, first block, last block, first slot, cycle length, slots in a cycle, places) of all sources."""
    left = {s: n for s, n in blocks.items() if n > 0}
    done = {s: 0 for s in left}
    out, start, phase = [], 0, 0
    active = {s: weights[s] for s in left if weights.get(s, 0) > 0}
    while active:
        length = max(resolution, 2 * len(active))
        slots = whole_weights(active, length)
        places = cycle(slots)
        # The phase ends with the last block of the source that runs out first.
        end = min((left[s] - 1) // slots[s] * length + places[s][(left[s] - 1) % slots[s]] for s in active) + 1
        for s in active:
            full, rest = divmod(end, length)
            took = full * slots[s] + sum(p < rest for p in places[s])
            if took:
                out.append((s, phase, done[s], done[s] + took - 1, start, length, slots[s], places[s]))
            left[s] -= took
            done[s] += took
        active = {s: w for s, w in active.items() if left[s] > 0}
        start, phase = start + end, phase + 1
    for s in sorted((s for s in left if weights.get(s, 0) <= 0), key=str):  # weight zero: one after the other
        out.append((s, phase, 0, left[s] - 1, start, 1, 1, [0]))
        start, phase = start + left[s], phase + 1
    return out


SCHEDULE = (
    "source string, phase int, first long, last long, start long, length long, slots long, places array<long>"
)


def mix(docs: DataFrame, weights: Mapping | None = None, block: int = BLOCK, resolution: int = RESOLUTION, seed: int = 0) -> DataFrame:
    """Rows of ``docs`` with one more struct column ``mix``: block, phase, release, deadline, slot, offset.

    ``weights`` maps sources to target weights (by default their rows to the
    power of ``SHARE``). Release and deadline count from the start of the phase,
    in slots. Order by slot and offset to read the mixture.
    """
    spark = docs.sparkSession
    made = ("source_key", "place_hash", "piece", "rank", "before", "block", "mix")
    key, place, piece, rank, before, blk, mixed = (spare(docs, n) for n in made)
    source = F.coalesce(F.col("source").cast("string"), F.lit("\x00null"))
    rows = docs.withColumn(key, source).withColumn(place, F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")))
    sizes = {r[0]: r[1] for r in rows.groupBy(key).count().limit(MOST_SOURCES + 1).collect()}
    if len(sizes) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources; map them to fewer first")
    if weights is None:
        weights = {s: n**SHARE for s, n in sizes.items()}
    else:
        weights = {"\x00null" if s is None else str(s): w for s, w in weights.items()}
    blocks = {s: -(-n // block) for s, n in sizes.items()}
    plan = spark.createDataFrame(phases(blocks, weights, resolution), SCHEDULE)  # at most sources x phases rows
    pieces = max([1, *(-(-n // PIECE) for n in sizes.values())])

    rows = rows.withColumn(piece, F.floor((F.shiftrightunsigned(place, 1).cast("double") / F.lit(float(1 << 63))) * pieces))
    counts = rows.groupBy(key, piece).agg(F.count("*").alias("n"))
    ahead = Window.partitionBy(key).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(key, piece, F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias(before))
    inside = Window.partitionBy(key, piece).orderBy(place, "doc_id", "text")
    ranked = rows.withColumn(rank, F.row_number().over(inside)).join(offsets, [key, piece])
    ranked = ranked.withColumn(rank, F.col(rank) + F.col(before) - 1).withColumn(blk, F.floor(F.col(rank) / block))

    p = {c: F.col(f"plan.{c}") for c in plan.columns}
    found = ranked.alias("rows").join(
        plan.alias("plan"), (F.col(key) == p["source"]) & F.col(blk).between(p["first"], p["last"])
    )
    j = F.col(blk) - p["first"]
    slot = p["start"] + F.floor(j / p["slots"]) * p["length"] + F.get(p["places"], (j % p["slots"]).cast("int"))
    info = F.struct(
        F.col(blk).alias("block"), p["phase"].alias("phase"),
        F.floor(j * p["length"] / p["slots"]).alias("release"), F.ceil((j + 1) * p["length"] / p["slots"]).alias("deadline"),
        slot.alias("slot"), (F.col(rank) % block).alias("offset"),
    )
    return found.select(*[F.col(f"rows.`{c}`") for c in docs.columns], info.alias(mixed))


def mixed_order(docs: DataFrame, weights: Mapping | None = None, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` in the order of the mixture, in files that follow each other."""
    name = spare(docs, "mix")
    return mix(docs, weights, block).sort(f"{name}.slot", f"{name}.offset").select(*[F.col(f"`{c}`") for c in docs.columns])


def placed(docs: DataFrame, weights: Mapping | None = None, block: int = BLOCK) -> DataFrame:
    """doc_id and text of every row with its place in the mixture, slot and offset, which no other row has.

    The place depends on the rows alone and not on the files they come from, so
    it is that of ``mixed_order`` also where the files have been read in another order.
    """
    return mix(docs.select("doc_id", "source", "text"), weights, block).select("doc_id", "text", "mix.slot", "mix.offset")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return done.select("doc_id", "source", "mix.*")


QUERIES = {"op1_mixing": op1_mixing}
ORACLES: dict[str, str] = {}
