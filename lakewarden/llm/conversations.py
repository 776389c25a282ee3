"""Conversation structure repair by rank-convergence parallel Viterbi.

The cheapest edits of a conversation follow from the costs of finishing it,
taken backwards row by row (``turns``). A long conversation is cut into chunks
that all start at once, from a guessed vector of costs behind their last row.
Fix-up passes then hand each chunk the vector that its successor came to: a
chunk whose guess differs from it by more than a constant runs again, until its
costs differ from the earlier ones by a constant only, and passes repeat until
no guess is wrong. The costs so stitched together drive the trace of the least
audit: each chunk tells where every entry state leads, these small maps are
composed from chunk to chunk, and each chunk then writes its own edits.

* Order. One range shuffle by conversation, turn, role and text; equal rows are
  counted together before it. No task needs a whole conversation: a partition
  is read as a stream and cut into chunks of bounded rows and bytes. A
  conversation that begins and ends in one partition's chunk is finished there.
* Rows seen earlier are told by 128-bit hashes: within a partition as it
  streams, across partitions by a shuffle of those hashes only.
* Chunks are composed per partition, then across partitions.
* SHA-256 can only be taken in order: the lines of a conversation of several
  chunks stream through one task, chunk by chunk, without being held.

Defined cases: null conv_id, turn, role and text count as one space where they
are text; rows of null conv_id are one conversation; null turns come first and
count for no gap; rows of the same turn are taken by role, then text, copies
adjacent; a conversation without rows after damage has zeros, an empty audit
and the hash of an empty text; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from lakewarden.llm import turns
from lakewarden.llm.common import settle, table
from lakewarden.llm.turns import BLANK, DUPLICATE, FINE, TERMINAL, TRUNCATED

CHUNK_ROWS = 1000
CHUNK_BYTES = 4 << 20
HELD = 500  # finished conversations given out together
SPACE = " \t\n\x0b\x0c\r"
RESULT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
RESULT_DDL = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
CHUNK_DDL = "part int, no int, codes binary, roles array<string>, texts array<string>, seen array<binary>, low long, high long, turns long"
PIECE_DDL = ("k long, blank long, duplicate long, truncated long, illegal long, first string, last string, low long, high long, "
             "turns long, cost long, audit string, lines long, body binary")


def shown(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, n: each row as the damage leaves it, n times; of dropped rows the conv_id alone, with n = 0."""
    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    seen = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), shown("role").alias("role"), shown("text").alias("text"), kind.alias("kind"))
    kind = F.col("kind")
    return seen.select(
        "conv_id",
        F.when(kind != 0, F.col("turn")).alias("turn"),
        F.when(kind == 0, "").when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind.isin(0, 1), "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("n"),
    )


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal rows of a batch as one, so that a row repeated over and over does not reach one task row by row."""
    for batch in batches:
        keys = batch.schema.names[:-1]
        found = pa.Table.from_batches([batch]).group_by(keys).aggregate([("n", "sum")]).select([*keys, "n_sum"]).rename_columns(batch.schema.names)
        yield from found.cast(batch.schema).to_batches()


def fault(role: str, text: str, seen: set[bytes]) -> tuple[int, bytes | None]:
    """The first fault of a row, and the hash by which a later row is known to repeat it."""
    body = text.rstrip(SPACE)
    if not body:
        return BLANK, None
    name = xxhash.xxh3_128_digest(f"{len(role)}:{role}{text}".encode())
    if name in seen:
        return DUPLICATE, None
    seen.add(name)
    return (FINE if body[-1] in ".!?" else TRUNCATED), name


class Chunk:
    """Consecutive rows of one conversation."""

    def __init__(self):
        self.codes, self.roles, self.texts, self.seen = bytearray(), [], [], []
        self.bytes = self.turns = 0
        self.low = self.high = None

    def add(self, turn: int | None, role: str, text: str, kind: int, name: bytes | None) -> None:
        self.codes.append(turns.code(role, kind))
        self.roles.append(role)
        self.texts.append(text if kind < DUPLICATE else "")  # such rows never stay
        self.seen.append(name)
        self.bytes += len(self.texts[-1])
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = (turn if self.low is None else self.low), turn

    def full(self) -> bool:
        return len(self.codes) >= CHUNK_ROWS or self.bytes >= CHUNK_BYTES


def tally(codes: bytes) -> list[int]:
    faults = [turns.fault_of(c) for c in codes]
    return [faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED)]


def illegal(roles: list[str]) -> int:
    return sum(a[:1] + b[:1] not in turns.LEGAL for a, b in zip(roles, roles[1:]))


def finished(chunk: Chunk) -> list:
    """The result of a conversation that is this chunk."""
    audit, lines, cost = turns.edited(bytes(chunk.codes), chunk.roles, chunk.texts, TERMINAL, turns.START, True)
    gaps = 0 if chunk.low is None else chunk.high - chunk.low + 1 - chunk.turns
    return [gaps, *tally(chunk.codes), illegal(chunk.roles), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()]


def cut(rows: DataFrame) -> DataFrame:
    """Results of conversations that one chunk holds, and the chunks of the others (``no`` is not null)."""
    kind = rows.schema["conv_id"]
    schema = T.StructType([kind, *T.StructType.fromDDL(RESULT_DDL), *T.StructType.fromDDL(CHUNK_DDL)])
    arrow = rows.limit(0).select("conv_id").toArrow().schema.field(0).type
    strings, binaries = pa.list_(pa.string()), pa.list_(pa.binary())
    types = [arrow, *[pa.int64()] * 6, pa.string(), pa.string(), pa.int32(), pa.int32(), pa.binary(), strings, strings, binaries, *[pa.int64()] * 3]
    names = schema.names

    def batch(out: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        done: list[list] = []
        conv, chunk, seen, no, edge = None, None, set(), 0, True

        def piece() -> pa.RecordBatch:
            return batch([[conv, *[None] * 8, part, no, bytes(chunk.codes), chunk.roles, chunk.texts, chunk.seen, chunk.low, chunk.high, chunk.turns]])

        for rows_in in batches:
            for own, turn, role, text, n in zip(*(c.to_pylist() for c in rows_in.columns)):
                if chunk is None or own != conv:
                    if chunk is not None:
                        if edge or no:
                            yield piece()
                        else:
                            done.append([conv, *finished(chunk), *[None] * 9])
                        edge = False
                    conv, chunk, seen, no = own, Chunk(), set(), 0
                for copy in range(n):
                    if chunk.full():
                        yield piece()
                        chunk, no = Chunk(), no + 1
                    chunk.add(turn, role, text, *fault(role, text, seen))
            if len(done) >= HELD:
                yield batch(done)
                done = []
        if done:
            yield batch(done)
        if chunk is not None:
            yield piece()

    ordered = rows.repartitionByRange("conv_id", "turn", "role", "text").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(run, schema)


def numbered(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chunks with their place k in the conversation and whether they are its last, and the conversations of several partitions.

    At most two conversations of a partition go on in another, so the second
    table, and a conversation's list of partitions, are bounded by their number.
    """
    per = chunks.groupBy("key", "part").agg(F.count("*").alias("m"))
    whole = Window.partitionBy("key")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = per.select("key", "part", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("off"), F.sum("m").over(whole).alias("total"), F.count("*").over(whole).alias("parts"))
    k = F.col("off") + F.col("no")
    placed = chunks.join(spans, ["key", "part"]).select("key", "part", "no", k.alias("k"), (k == F.col("total") - 1).alias("last"), "codes")
    return placed, spans.where("parts > 1").select("key").distinct()


def repeats(chunks: DataFrame, several: DataFrame) -> DataFrame:
    """Places (key, part, no, places) of rows that an earlier partition has already."""
    names = chunks.join(F.broadcast(several), "key").select("key", "part", "no", F.posexplode("seen").alias("place", "name")).where("name is not null")
    first = F.min("part").over(Window.partitionBy("key", "name"))  # one row per partition at most
    later = names.withColumn("first", first).where("part > first")
    return later.groupBy("key", "part", "no").agg(F.collect_list("place").alias("places"))


@F.pandas_udf(T.BinaryType())
def marked(codes: pd.Series, places: pd.Series) -> pd.Series:
    def one(own: bytes, at) -> bytes:
        out = bytearray(own)
        for p in at if at is not None else ():
            out[p] = out[p] - turns.fault_of(out[p]) + DUPLICATE
        return bytes(out)

    return pd.Series([one(c, p) for c, p in zip(codes, places)])


def vector(value: bytes) -> turns.Vector:
    return tuple(value)  # type: ignore[return-value]


@F.pandas_udf(T.BinaryType())
def run_back(codes: pd.Series, behind: pd.Series) -> pd.Series:
    return pd.Series([bytes(turns.back(c, vector(b))) for c, b in zip(codes, behind)])


@F.pandas_udf(T.BinaryType())
def run_again(codes: pd.Series, old: pd.Series, before: pd.Series, new: pd.Series) -> pd.Series:
    return pd.Series([bytes(turns.fixed_up(c, vector(o), vector(b), vector(n))) for c, o, b, n in zip(codes, old, before, new)])


def converged(chunks: DataFrame) -> DataFrame:
    """The chunks with ``behind``, the costs behind their last row up to a constant."""
    guess = F.when(F.col("last"), F.lit(bytes(TERMINAL))).otherwise(F.lit(bytes(turns.GUESS)))
    costs = settle(chunks.withColumn("behind", guess).withColumn("before", run_back("codes", "behind")), "turn-costs")
    while True:
        given = costs.where("k > 0").select("key", (F.col("k") - 1).alias("k"), F.col("before").alias("new"))
        met = costs.join(given, ["key", "k"], "left")
        wrong = F.coalesce(F.col("new") != F.col("behind"), F.lit(False))
        if not met.where(wrong).take(1):
            return costs.drop("before")
        again = met.where(wrong).withColumn("before", run_again("codes", "behind", "before", "new")).withColumn("behind", F.col("new"))
        costs = settle(again.unionByName(met.where(~wrong)).select(*costs.columns), "turn-costs")


@F.pandas_udf(T.StringType())
def leads(codes: pd.Series, behind: pd.Series) -> pd.Series:
    return pd.Series([turns.exits(c, vector(b)) for c, b in zip(codes, behind)])


@F.pandas_udf(T.ArrayType(T.StringType()))
def entries(maps: pd.Series, start: pd.Series) -> pd.Series:
    """The state before each of the maps, followed from a first one."""

    def one(own, state: str) -> list[str]:
        out = []
        for m in own:
            out.append(state)
            state = m[int(state)]
        return out

    return pd.Series([one(m, s) for m, s in zip(maps, start)])


def entered(chunks: DataFrame) -> DataFrame:
    """The chunks with the state in which the cheapest edits enter them."""
    own = chunks.select("key", "part", F.struct("k", leads("codes", "behind").alias("map")).alias("at"))
    per = settle(own.groupBy("key", "part").agg(F.array_sort(F.collect_list("at")).alias("list")), "turn-maps")
    whole = F.aggregate("list", F.lit("0123"), lambda so_far, x: F.call_function("translate", so_far, F.lit("0123"), x["map"]))
    parts = per.select("key", F.struct("part", whole.alias("map")).alias("at")).groupBy("key").agg(F.array_sort(F.collect_list("at")).alias("list"))

    def followed(lists: DataFrame, start: Column, name: str) -> DataFrame:
        states = lists.withColumn("state", entries(F.col("list.map"), start))
        return states.select("key", *[c for c in ("part",) if c in lists.columns], F.explode(F.arrays_zip(F.col(f"list.{name}").alias(name), "state")).alias("x")).select(
            "key", *[c for c in ("part",) if c in lists.columns], f"x.{name}", "x.state")

    first = followed(parts, F.lit(str(turns.START)), "part").withColumnRenamed("state", "start")
    each = followed(per.join(first, ["key", "part"]), F.col("start"), "k")
    return chunks.join(each.select("key", "k", "state"), ["key", "k"])


def pieces(chunks: DataFrame, known: DataFrame) -> DataFrame:
    """What each chunk adds to its conversation: edits, lines, counts and what borders need."""
    kind = chunks.schema["conv_id"]
    schema = T.StructType([kind, T.StructField("key", T.StringType()), *T.StructType.fromDDL(PIECE_DDL)])
    needed = known.select("key", "part", "no", "k", "last", F.col("codes").alias("final"), "behind", "state")
    both = chunks.join(needed, ["key", "part", "no"]).select(
        "conv_id", "key", "k", "last", "final", "behind", "state", "roles", "texts", "low", "high", "turns")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs, text = pa.int64(), pa.string()
        types = [longs, longs, longs, longs, longs, text, text, longs, longs, longs, longs, text, longs, pa.binary()]
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                row = one.to_pylist()[0]
                audit, lines, cost = turns.edited(row["final"], row["roles"], row["texts"], vector(row["behind"]), int(row["state"]), row["last"])
                ends = (row["roles"][0][:1], row["roles"][-1][:1]) if row["roles"] else (None, None)
                out = [row["k"], *tally(row["final"]), illegal(row["roles"]), *ends, row["low"], row["high"], row["turns"], cost, audit, len(lines), "\n".join(lines).encode()]
                yield pa.RecordBatch.from_arrays([one.column(0), one.column(1), *[pa.array([v], t) for v, t in zip(out, types)]], schema.names)

    return both.mapInArrow(run, schema)


def stitched(parts: DataFrame) -> DataFrame:
    """The result of each conversation from its pieces in order; they stream by, only the audit grows."""
    schema = T.StructType([parts.schema["conv_id"], *T.StructType.fromDDL(RESULT_DDL)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, conv = None, None
        types = [*[pa.int64()] * 6, pa.string(), pa.string()]

        def result() -> pa.RecordBatch:
            gaps = 0 if low is None else high - low + 1 - distinct
            out = [gaps, *sums, "".join(audit), digest.hexdigest()]
            return pa.RecordBatch.from_arrays([conv, *[pa.array([v], t) for v, t in zip(out, types)]], schema.names)

        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                row = one.drop_columns(["conv_id"]).to_pylist()[0]
                if row["key"] != key:
                    if key is not None:
                        yield result()
                    key, conv = row["key"], one.column(0)
                    sums, audit, digest, lines, last, low, high, distinct = [0] * 5, [], hashlib.sha256(), 0, None, None, None, 0
                border = last is not None and row["first"] is not None and last + row["first"] not in turns.LEGAL
                more = [row["blank"], row["duplicate"], row["truncated"], row["illegal"] + border, row["cost"]]
                sums = [a + b for a, b in zip(sums, more)]
                audit.append(row["audit"])
                if row["lines"]:
                    digest.update(b"\n" + row["body"] if lines else row["body"])
                    lines += row["lines"]
                last = last if row["last"] is None else row["last"]
                if row["low"] is not None:
                    distinct += row["turns"] - (row["low"] == high)
                    low, high = (row["low"] if low is None else low), row["high"]
        if key is not None:
            yield result()

    return parts.repartition("key").sortWithinPartitions("key", "k").mapInArrow(run, schema)


def repaired(rows: DataFrame) -> DataFrame:
    """conv_id and RESULT for rows (conv_id, turn, role, text, n)."""
    found = settle(cut(rows.mapInArrow(counted, rows.schema)), "turn-chunks")
    done = found.where("no is null").select("conv_id", *RESULT)
    key = F.coalesce(F.concat(F.lit(":"), F.col("conv_id").cast("string")), F.lit(""))
    chunks = found.where("no is not null").withColumn("key", key)
    placed, several = numbered(chunks)
    flagged = placed.join(repeats(chunks, several), ["key", "part", "no"], "left").withColumn("codes", marked("codes", "places")).drop("places")
    return done.unionByName(stitched(pieces(chunks, entered(converged(flagged)))))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(damaged(table(spark, sf_dir, "conversations")))


QUERIES = {"op12_conversations": op12_conversations}
ORACLES: dict[str, str] = {}
