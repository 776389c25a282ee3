"""Alert cooldown: an alert is dropped while its rule's last sent alert is too recent.

Whether an alert is sent depends on which one was sent before, so the sent
alerts of a rule are a chain along time: each leads to the first alert at or
after its own time plus the cooldown. The chain is found by pointer doubling:

1. Alerts are cut by rank, as ranges of (rule, time), into pieces of about equal
   size, so neither a large rule nor a burst within a second meets in one task.
   Inside a piece every alert is led along its chain to the time from which the
   rule may send again when the chain leaves the piece.
2. The alert with which each such time enters a later piece is found by one
   sorted pass over both, again cut by rank.
3. From entry to entry the leads are doubled, two steps becoming one, while the
   entries reached from the first alert of each rule are marked: the rounds grow
   with the logarithm of the pieces.
4. Each piece that is entered marks its sent alerts from there.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from lakewarden.functions.columns import micros
from lakewarden.session import settled

# The functions below travel to the tasks whole, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

COOLDOWN_SECONDS = 30 * 60
KEY = ["__rule", "__us"]


def _runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Start and end of each stretch of equal neighbours."""
    edges = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    bounds = [0, *edges.tolist(), len(keys)]
    yield from zip(bounds[:-1], bounds[1:])


def leave(times: np.ndarray, cooldown: int) -> np.ndarray:
    """When a rule that sends at each of the sorted times may send again behind the last of them."""
    ahead = np.searchsorted(times, times + cooldown, side="left")
    last = np.where(ahead < len(times), ahead, np.arange(len(times)))
    while True:
        further = last[last]
        if (further == last).all():
            return times[last] + cooldown
        last = further


def chain(times: np.ndarray, first: int, cooldown: int) -> list[int]:
    """Places of the alerts that are sent from the first one at or after a time."""
    out, at = [], int(np.searchsorted(times, first, side="left"))
    while at < len(times):
        out.append(at)
        at = int(np.searchsorted(times, times[at] + cooldown, side="left"))
    return out


def _by_rule(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted rows, those of a rule together."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        for lo, hi in _runs(pdf["__rule"].to_numpy()) if len(pdf) else ():
            part = pdf.iloc[lo:hi]
            if held and held[0]["__rule"].iat[0] != part["__rule"].iat[0]:
                yield pd.concat(held)
                held = []
            held.append(part)
    if held:
        yield pd.concat(held)


def _leave(cooldown: int):
    """Sorted alerts of a piece with the piece's number and when the rule may send again behind it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        piece = TaskContext.get().partitionId()
        for own in _by_rule(batches):
            yield own.assign(__piece=piece, __leave=leave(own["__us"].to_numpy(), cooldown))

    return run


def _mark(cooldown: int):
    """The sent alerts of pieces; the row of a piece that has ``__enter`` says from when."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _by_rule(batches):
            for lo, hi in _runs(rows["__piece"].to_numpy()):
                own = rows.iloc[lo:hi]
                first = own["__enter"].max()
                if pd.notna(first):
                    yield own.iloc[chain(own["__us"].to_numpy(), int(first), cooldown)][[*KEY, "__tie"]]

    return run


def first_at_or_after(times: DataFrame, points: DataFrame, pieces: int | None = None) -> DataFrame:
    """For each of ``times`` (__rule, __us) the first of ``points`` at or after it: ``__next``, null if there is none.

    Both are sorted together and cut by rank; a piece without a later point
    takes the head of the next one that has one. The cut is written once, as
    ranges may fall elsewhere when they are taken again.
    """
    both = times.select(*KEY, F.lit(False).alias("__point")).unionByName(points.select(*KEY, F.lit(True).alias("__point")))
    order = [*KEY, "__point"]
    dealt = both.repartitionByRange(pieces, *order) if pieces else both.repartitionByRange(*order)
    cut = settled(dealt.withColumn("__piece", F.spark_partition_id()), "alert-order")
    point = F.when(F.col("__point"), F.col("__us"))
    back = [F.col(c).desc() for c in order[1:]]
    inside = Window.partitionBy("__rule", "__piece").orderBy(*back).rowsBetween(Window.unboundedPreceding, 0)
    later = Window.partitionBy("__rule").orderBy(F.col("__piece").desc()).rowsBetween(Window.unboundedPreceding, -1)
    heads = cut.groupBy("__rule", "__piece").agg(F.min(point).alias("__head")).select(  # one row per rule and piece
        "__rule", "__piece", F.last("__head", ignorenulls=True).over(later).alias("__after"))
    found = cut.withColumn("__own", F.last(point, ignorenulls=True).over(inside)).where(~F.col("__point"))
    return found.join(heads, ["__rule", "__piece"]).select(*KEY, F.coalesce("__own", "__after").alias("__next"))


def reached(leads: DataFrame, firsts: DataFrame) -> DataFrame:
    """(__rule, __us) of all nodes that leads (__rule, __us, __next) reach from the first ones, by doubling."""
    leads, marked = settled(leads, "alert-leads"), firsts
    while leads.take(1):  # a step twice as long each time, until none is left inside the chains
        new = marked.join(leads, KEY).select("__rule", F.col("__next").alias("__us"))
        marked = settled(marked.unionByName(new).distinct(), "alert-marks")
        on = leads.select("__rule", F.col("__us").alias("__next"), F.col("__next").alias("__then"))
        leads = settled(leads.join(on, ["__rule", "__next"]).select("__rule", "__us", F.col("__then").alias("__next")), "alert-leads")
    return marked


def cooldown(
    alerts: DataFrame, rule: str, ts: str, tie: str,
    cooldown_s: int = COOLDOWN_SECONDS, pieces: int | None = None,
) -> DataFrame:
    """Alerts that are sent; of those at the same time the one with the smallest ``tie``.

    An alert without rule, time or tie can be neither compared nor sent, and
    rows equal in all three are one alert. ``pieces`` is how many tasks the
    alerts are cut into (the session's shuffle partitions if not given).
    """
    wait = cooldown_s * 1_000_000
    named = alerts.withColumns({"__rule": F.col(rule).cast("string"), "__us": micros(F.col(ts)), "__tie": F.col(tie)})
    named = named.where(F.col("__rule").isNotNull() & F.col("__us").isNotNull() & F.col("__tie").isNotNull())
    points = named.groupBy(*KEY).agg(F.min("__tie").alias("__tie"))
    dealt = points.repartitionByRange(pieces, *KEY) if pieces else points.repartitionByRange(*KEY)
    kind = points.schema["__tie"].dataType.simpleString()
    cut = settled(dealt.sortWithinPartitions(*KEY).mapInPandas(
        _leave(wait), f"__rule string, __us long, __tie {kind}, __piece int, __leave long"), "alerts")

    # One rule in one piece has one way out: its chains rarely stay apart, and each is a lead to a later piece.
    firsts = cut.groupBy("__rule").agg(F.min("__us").alias("__us"))
    ways = cut.select("__rule", F.col("__leave").alias("__us")).distinct()
    next_of = first_at_or_after(ways, cut, pieces).where(F.col("__next").isNotNull())
    entries = next_of.select("__rule", F.col("__next").alias("__us")).distinct().unionByName(firsts).distinct()
    leads = cut.join(entries, KEY).select("__rule", "__us", F.col("__leave").alias("__way")).join(
        next_of.withColumnRenamed("__us", "__way"), ["__rule", "__way"]).select(*KEY, "__next")
    entered = reached(leads, firsts).withColumn("__enter", F.col("__us"))

    walked = cut.join(entered, KEY, "left").select("__rule", "__piece", "__us", "__tie", "__enter")
    sent = walked.repartition("__rule", "__piece").sortWithinPartitions("__rule", "__piece", "__us").mapInPandas(
        _mark(wait), f"__rule string, __us long, __tie {kind}")
    return named.join(sent, [*KEY, "__tie"]).dropDuplicates([*KEY, "__tie"]).select(*[F.col(f"`{c}`") for c in alerts.columns])


def alert_history(sent: DataFrame, rule: str, ts: str) -> DataFrame:
    """Last fired time and number of sent alerts per rule."""
    return sent.groupBy(rule).agg(F.max(ts).alias("last_fired"), F.count("*").alias("sent"))
