"""Byte-level BPE encoding and decoding.

Two-tier lookup. A minimal perfect hash over the vocabulary resolves every
pre-token that is a vocabulary entry as it stands. The rest are merged: bytes
form a linked list, a heap holds the neighbouring pairs that are entries, and
the pair of lowest rank, leftmost first, is joined until none is left.

The minimal perfect hash is of the hash-and-displace kind: keys fall into
buckets, and each bucket, largest first, takes the first displacement that
puts all its keys on free slots; a key alone in its bucket names a slot. A
lookup computes one slot and compares the key kept there.

Texts are cut and encoded in the tasks that read them; nothing is shuffled.
Tables of the vocabulary go to the tasks (its size is that of the file). A
worker keeps the pre-tokens it has met, up to a fixed number.

Defined cases: a null text counts as empty and has no ids; an empty text
decodes to no bytes; every row gives one row, repeated doc_ids too.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession, types as T

from lakewarden.llm.common import table, texts

KEPT = 400_000  # pre-tokens a worker remembers before it starts anew
BUCKET = 3      # keys per bucket of the perfect hash, on average
TRIES = 256     # displacements tried at once


def read_ranks(path: str) -> dict[bytes, int]:
    """Vocabulary entries and their ranks from a file of "base64 rank" lines."""
    with open(path, "rb") as file:
        return {base64.b64decode(entry): int(rank) for entry, rank in (line.split() for line in file if line.strip())}


class PerfectHash:
    """Minimal perfect hash over a fixed set of byte strings, giving each its value."""

    def __init__(self, values: dict[bytes, int]):
        keys = list(values)
        self.size = max(1, len(keys))
        self.buckets = max(1, len(keys) // BUCKET)
        hashes = [xxhash.xxh3_64_intdigest(k) for k in keys]
        members: dict[int, list[int]] = {}
        for i, h in enumerate(hashes):
            members.setdefault(h % self.buckets, []).append(i)
        self.shift = [0] * self.buckets
        slots = np.full(self.size, -1)
        many = {b: own for b, own in members.items() if len(own) > 1}
        for bucket, own in sorted(many.items(), key=lambda x: -len(x[1])):
            base = np.array([hashes[i] >> 32 for i in own])[:, None]
            step = np.array([hashes[i] & 0x7FFFFFFF | 1 for i in own])[:, None]
            first = 0
            while True:  # try displacements, a block at a time
                places = (base + np.arange(first, first + TRIES) * step) % self.size
                row = np.sort(places, axis=0)
                fits = (slots[places] < 0).all(axis=0) & (row[1:] != row[:-1]).all(axis=0)
                if fits.any():
                    break
                first += TRIES
            at = int(fits.argmax())
            self.shift[bucket] = first + at
            slots[places[:, at]] = own
        free = iter(np.flatnonzero(slots < 0).tolist())
        for bucket, own in members.items():
            if len(own) == 1:  # a lone key names its slot
                slot = next(free)
                self.shift[bucket], slots[slot] = -1 - slot, own[0]
        self.keys = [keys[i] if i >= 0 else None for i in slots.tolist()]
        self.values = [values[k] if k is not None else -1 for k in self.keys]

    def get(self, key: bytes) -> int:
        """The key's value, -1 if it is not in the set."""
        h = xxhash.xxh3_64_intdigest(key)
        shift = self.shift[h % self.buckets]
        slot = -1 - shift if shift < 0 else ((h >> 32) + shift * (h & 0x7FFFFFFF | 1)) % self.size
        return self.values[slot] if self.keys[slot] == key else -1


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token that is no entry itself: lowest rank first, leftmost first among equals."""
    n = len(piece)
    end = list(range(1, n + 1))      # of the part that starts at i
    before = list(range(-1, n - 1))  # start of the part in front
    alive = [True] * n
    get = ranks.get
    heap = []
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            heap.append((rank, i, i + 2))
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i] if alive[i] else n
        if not alive[i] or middle >= n or end[middle] != stop:
            continue  # one of the two parts has changed since
        alive[middle] = False
        end[i] = stop
        if stop < n:
            before[stop] = i
            rank = get(piece[i : end[stop]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[stop]))
        left = before[i]
        if left >= 0:
            rank = get(piece[left:stop])
            if rank is not None:
                heapq.heappush(heap, (rank, left, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Codec:
    """Encoder and decoder of one vocabulary; also the memory of the pre-tokens met so far."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, kept: int = KEPT):
        self.ranks, self.pattern, self.kept = ranks, pattern, kept
        self.whole = PerfectHash(ranks)
        entries = {rank: entry for entry, rank in ranks.items()}
        top = max(entries, default=-1) + 1
        self.lengths = np.array([len(entries.get(i, b"")) for i in range(top)], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1].astype(np.int64)
        self.flat = np.frombuffer(b"".join(entries.get(i, b"") for i in range(top)), np.uint8)
        self.ready()

    def ready(self) -> None:
        self.met: dict[str, bytes] = {}
        self.cut = regex.compile(self.pattern).findall

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("met", "cut")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.ready()

    def _piece(self, token: str) -> bytes:
        raw = token.encode()
        rank = self.whole.get(raw)
        ids = [rank] if rank >= 0 else merge(raw, self.ranks)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        tokens = self.cut(text)
        met = self.met
        try:
            return b"".join([met[t] for t in tokens])
        except KeyError:
            if len(met) > self.kept:
                met.clear()
            for t in set(tokens).difference(met):
                met[t] = self._piece(t)
            return b"".join([met[t] for t in tokens])

    def decode(self, ids: bytes) -> bytes:
        at = np.frombuffer(ids, "<u4").astype(np.int64)
        lengths = self.lengths[at]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.starts[at] - ends + lengths, lengths) + np.arange(total)].tobytes()


def codec(spark: SparkSession, ranks: dict[bytes, int], pattern: str):
    """Broadcast of a codec; its size is fixed by the vocabulary."""
    return spark.sparkContext.broadcast(Codec(ranks, pattern))


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int | None, str]]:
    return zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())


def encode(docs: DataFrame, shared) -> DataFrame:
    """doc_id and ids (packed little-endian unsigned 32-bit integers) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            packed = [own.encode(text) for _, text in _rows(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["doc_id", "ids"])

    rows = texts(docs)
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], T.StructField("ids", T.BinaryType())]))


def decode(encoded: DataFrame, shared) -> DataFrame:
    """doc_id and raw (bytes) of rows (doc_id, ids); null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            raw = [own.decode(ids or b"") for _, ids in _rows(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["doc_id", "raw"])

    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], T.StructField("raw", T.BinaryType())]))


DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(docs: DataFrame, shared) -> DataFrame:
    """Encode and decode in one pass: doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            counts, ids_sha, raw_sha = [], [], []
            for _, text in _rows(batch):
                ids = own.encode(text)
                counts.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                raw_sha.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(raw_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = texts(docs)
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL(DIGEST)]))


def tokenised(docs: DataFrame, shared, more: Sequence[str] = ()) -> DataFrame:
    """doc_id, n_tokens, ids as an array, and whether decoding gives the text again; ``more`` columns go along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            packed = [own.encode(text) for _, text in _rows(batch)]
            intact = [own.decode(ids) == text.encode() for ids, (_, text) in zip(packed, _rows(batch))]
            at = np.cumsum([0, *[len(p) // 4 for p in packed]])
            ids = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.frombuffer(b"".join(packed), "<i4")))
            counts = pa.array(np.diff(at), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), counts, ids, pa.array(intact, pa.bool_()), *batch.columns[2:]],
                ["doc_id", "n_tokens", "ids", "intact", *batch.schema.names[2:]])

    rows = texts(docs, *more)
    made = T.StructType.fromDDL("n_tokens long, ids array<int>, intact boolean")
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], *made, *rows.schema.fields[2:]]))


def production(spark: SparkSession):
    """The codec of the queries: the 50k vocabulary for many languages, read on the driver."""
    import public_tokenizers

    return codec(spark, read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), production(spark))


QUERIES = {"op2_byte_bpe": op2_byte_bpe}
ORACLES: dict[str, str] = {}
