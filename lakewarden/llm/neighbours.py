"""Approximate nearest neighbours over shifted space-filling curves.

Vectors are turned and projected to a few axes, shifted, and put in order along
a Hilbert curve; several turns and shifts give several orders. Each order is cut
by ranges of its key into pieces. A query looks at its own piece and the
neighbouring ones on either side; what it meets there, on any curve, is ranked
by the exact distance of the original vectors. Every row is on every curve.

Pieces are a fixed share of the rows, so recall does not fall as tables grow;
a piece is split into groups of bounded size, and a group passes only the
nearest of its rows for each query. Equal vectors are one entry with as many
ids as an answer can need, so a vector that a third of the rows share is met
once.

The cuts between pieces come from at most ``FIT_ROWS`` keys of each curve, the
turns from a seed.

Defined cases: vectors that are null, zero, or hold null or non-finite
components take no part, neither as queries nor as candidates; vectors are
compared with vectors of their own length only; rows without id take no part;
a query never gets its own id, also if rows repeat; ties go to the smaller id;
with fewer candidates than asked for, all of them are returned.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from lakewarden.llm.common import settle, table
from lakewarden.llm.hilbert import hilbert_keys

NEAREST = 10
CURVES = 10
AXES, BITS = 8, 6
PIECES = 20         # of a curve
LEAST = 64          # keys of a piece, at least; a small table has fewer pieces
REACH = 2           # pieces looked at on either side of a query's own
FIT_ROWS = 20_000   # keys from which the cuts between pieces are taken
GROUP = 5_000       # vectors of a piece compared in one group
BLOCK = 64          # queries compared at once
SEED = 7


def _turn(length: int, curve: int) -> tuple[np.ndarray, np.ndarray]:
    """Axes and shift of a curve, the same wherever they are made."""
    draw = np.random.default_rng([SEED, length, curve])
    turn, _ = np.linalg.qr(draw.normal(size=(length, max(1, length))))
    return turn[:, :AXES], draw.uniform(0, 0.5, min(AXES, length))


def curve_keys(vectors: np.ndarray, curve: int) -> np.ndarray:
    """Places of unit-length directions on one curve."""
    turn, shift = _turn(vectors.shape[1], curve)
    low = vectors @ turn  # within -1..1
    spread = np.sqrt(1 / vectors.shape[1])
    cells = ((np.tanh(low / (2 * spread)) + 1) / 2 + shift) / 1.5 * ((1 << BITS) - 1)
    return hilbert_keys(cells.astype(np.int64), BITS)


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, vector) of the rows that take part, components as doubles."""
    whole = F.forall(F.col("vector"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        rows.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
        .where(F.col("id").isNotNull() & (F.size("vector") > 0))
        .where(F.coalesce(whole, F.lit(False)) & F.exists("vector", lambda x: x != 0))
    )


def entries(points: DataFrame, keep: int) -> DataFrame:
    """Different vectors with their smallest ids, at most ``keep`` of each."""
    ranked = points.distinct().withColumn("n", F.row_number().over(Window.partitionBy("vector").orderBy("id")))
    return ranked.where(F.col("n") <= keep).groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def with_keys(found: DataFrame) -> DataFrame:
    """Entries with an array of one key per curve; the norm is kept out of the key's directions."""

    @F.pandas_udf("array<long>")
    def keys(column: pd.Series) -> pd.Series:
        out: list = [None] * len(column)
        sizes = column.map(len).to_numpy()
        for size in np.unique(sizes):
            mine = np.flatnonzero(sizes == size)
            x = np.stack(column.iloc[mine].to_list())
            x = x / np.abs(x).max(axis=1, keepdims=True)
            x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
            both = np.stack([curve_keys(x, c) for c in range(CURVES)], axis=1)
            for row, own in zip(mine, both):
                out[row] = own
        return pd.Series(out)

    return found.withColumn("keys", keys("vector"))


def cuts(keyed: DataFrame) -> dict[int, np.ndarray]:
    """For each length of vectors the inner borders of the pieces, one row per curve."""
    sample = keyed.orderBy(F.xxhash64("vector")).limit(FIT_ROWS).select(F.size("vector").alias("size"), "keys").collect()
    out = {}
    for size in {r["size"] for r in sample}:
        keys = np.sort(np.array([r["keys"] for r in sample if r["size"] == size], np.int64), axis=0)
        pieces = max(1, min(PIECES, len(keys) // LEAST))
        out[size] = keys[(np.arange(1, pieces) * len(keys)) // pieces].T
    return out


def with_pieces(keyed: DataFrame, borders: dict[int, np.ndarray], reach: int) -> DataFrame:
    """A row for each curve and piece that an entry is in, or that lies within ``reach`` of it."""

    @F.pandas_udf("array<struct<curve:int,piece:int>>")
    def places(keys: pd.Series, size: pd.Series) -> pd.Series:
        def one(own, length: int) -> list[dict]:
            cut = borders.get(length)
            if cut is None or not cut.shape[1]:
                return [{"curve": 0, "piece": 0}]
            at = [int(np.searchsorted(c, k, "right")) for c, k in zip(cut, own)]
            most = cut.shape[1]
            return [{"curve": c, "piece": q} for c, p in enumerate(at) for q in range(max(0, p - reach), min(most, p + reach) + 1)]

        return pd.Series([one(k, int(n)) for k, n in zip(keys, size)])

    return keyed.withColumn("size", F.size("vector")).withColumn("at", F.explode(places("keys", F.size("vector"))))


def _nearest(limit: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        ask = group["query"].notna().to_numpy()
        rows, queries = group[~ask], group[ask]
        none = pd.DataFrame({"query": pd.Series(dtype="int64"), "id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        if not len(rows) or not len(queries):
            return none
        x = np.stack(rows["vector"].to_list())
        ids = rows["ids"].to_list()
        asked = np.stack(queries["vector"].to_list())
        names = queries["query"].astype("int64").to_list()
        squares, few = (x * x).sum(axis=1), min(limit + 1, len(x))
        out = []
        for at in range(0, len(asked), BLOCK):
            block = asked[at : at + BLOCK]
            size = (block * block).sum(axis=1)[:, None] + squares
            rough = size - 2 * block @ x.T  # finds who may be near; distances are taken anew
            edge = np.partition(rough, few - 1, axis=1)[:, few - 1]
            for i, query in enumerate(names[at : at + BLOCK]):
                near = np.flatnonzero(rough[i] <= edge[i] + 1e-9 * size[i])
                far = np.sqrt(((x[near] - block[i]) ** 2).sum(axis=1))
                flat = sorted((d, int(v)) for d, k in zip(far.tolist(), near) for v in ids[k] if v != query)[:limit]
                out += [(query, v, d) for d, v in flat]
        return pd.DataFrame(out, columns=["query", "id", "score"]) if out else none

    return run


def nearest(rows: DataFrame, queries: DataFrame, vec_id: str, vector: str, limit: int = NEAREST) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` the nearest found among ``rows``."""
    found = settle(with_keys(entries(usable(rows, vec_id, vector), limit + 1)), "curves")
    borders = cuts(found)
    groups = max(1, -(-found.count() // (PIECES * GROUP)))
    asked = with_keys(usable(queries, vec_id, vector).distinct())

    own = with_pieces(found, borders, 0).select(
        "vector", "ids", F.lit(None).cast("long").alias("query"), "size", "at", F.pmod(F.xxhash64("vector"), F.lit(groups)).alias("part")
    )
    ask = with_pieces(asked, borders, REACH).select(
        "vector", F.lit(None).cast("array<long>").alias("ids"), F.col("id").alias("query"), "size", "at",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("part"),
    )
    both = own.unionByName(ask).select("vector", "ids", "query", "size", "at.curve", "at.piece", "part")
    met = both.groupBy("size", "curve", "piece", "part").applyInPandas(_nearest(limit), "query long, id long, score double")
    best = Window.partitionBy("query").orderBy("score", "id")
    return (
        met.groupBy("query", "id").agg(F.min("score").alias("score"))
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= limit)
        .select(F.col("query").alias("query_id"), F.col("rank").cast(T.IntegerType()), F.col("id").alias("vec_id"), "score")
    )


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where(F.col("vec_id") % 100 == 0), "vec_id", "embedding")


QUERIES = {"op8_neighbours": op8_neighbours}
ORACLES: dict[str, str] = {}
