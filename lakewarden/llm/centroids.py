"""Centroid clustering of quantised vectors by bisector tournament.

Vectors become whole numbers, floor(64 x) per component, so that every
comparison is exact. For two centroids a < b the bisector decides: with normal
2 (b - a) and threshold |b|^2 - |a|^2, a vector x is nearer to b exactly when
normal . x exceeds the threshold; a tie keeps the smaller number. Normals and
thresholds of all pairs are computed once per round; a vector then plays one
sign test per further centroid against the winner so far, and the distance is
taken for the final winner alone. As "nearer, then smaller number" is one total
order, k - 1 tests find what comparing all distances would.

Each round is one pass over the vectors: a task sums its own vectors per
cluster and gives out at most k rows, Spark adds them up, and k centroids reach
the driver. The start is found with one top-k over hashes.

Defined cases: vectors that are null, of another length, or hold null or
non-finite components take no part; every row with such a vector is returned,
repeated ones each; a null vec_id is hashed as an empty text but comes after all
others in the start; of rows whose vec_id repeat, the smaller vector comes
first; with fewer vectors than centroids each is one; empty clusters keep their
centroid; an empty table gives an empty result. Components of 2^21 or more in
absolute value have squared distances beyond a long, and fail with an error
that says so.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakewarden.llm.common import settle, table

CLUSTERS = 16
ROUNDS = 3
LENGTH = 64
SCALE = 64
SEED = 1
MOST = 2**27  # of a scaled component: 64 squares of twice this fit a long


def whole_numbers(vector: Column) -> Column:
    """floor(64 x) of each component; an error beyond what a long distance can hold."""
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))
    too_far = F.exists(vector, lambda x: F.abs(x.cast("double")) >= MOST / SCALE)
    return F.when(too_far, F.raise_error(F.lit("a component is too large for squared distances in a long"))).otherwise(
        F.transform(scaled, lambda x: x.cast("long")))


def usable(rows: DataFrame, vec_id: str, vector: str, length: int = LENGTH) -> DataFrame:
    """vec_id and x: the vectors of full length without null, NaN or infinite components, as whole numbers."""
    broken = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    kept = rows.where((F.size(vector) == length) & ~broken)
    return kept.select(F.col(vec_id).alias("vec_id"), whole_numbers(F.col(vector)).alias("x"))


def start(rows: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors whose hashed ids are smallest."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = rows.select(F.col("vec_id").isNull().alias("last"), name.alias("name"), "x").orderBy("last", "name", "x").limit(clusters)
    return np.array([r["x"] for r in first.collect()], np.int64).reshape(-1, LENGTH)


@dataclass(frozen=True)
class Bisectors:
    """Of each pair of centroids the normal and threshold of their bisector."""

    centroids: np.ndarray
    normals: np.ndarray
    thresholds: np.ndarray

    @classmethod
    def of(cls, centroids: np.ndarray) -> "Bisectors":
        squares = (centroids**2).sum(axis=1)
        return cls(centroids, 2 * (centroids[None] - centroids[:, None]), squares[None] - squares[:, None])

    def winners(self, x: np.ndarray) -> np.ndarray:
        """The nearest centroid of each row, ties to the smaller number, by k - 1 sign tests."""
        best = np.zeros(len(x), np.int64)
        for other in range(1, len(self.centroids)):  # the winner so far always has the smaller number
            side = np.einsum("ij,ij->i", x, self.normals[best, other]) - self.thresholds[best, other]
            best[side > 0] = other
        return best


def vectors_of(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, LENGTH)


def summed(rows: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Of each cluster that has vectors their number and their exact sum."""
    bisectors = Bisectors.of(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(centroids), np.int64)
        total = np.zeros((len(centroids), LENGTH), object)  # exact at any number of rows
        for batch in batches:
            x = vectors_of(batch)
            own = bisectors.winners(x)
            count += np.bincount(own, minlength=len(centroids))
            part = np.zeros((len(centroids), LENGTH), np.int64)
            np.add.at(part, own, x)
            total += part
        used = np.flatnonzero(count)
        sums = [[str(v) for v in total[c]] for c in used.tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(count[used]), pa.array(sums, pa.list_(pa.string()))], ["cluster", "n", "sums"])

    parts = rows.mapInArrow(run, "cluster int, n long, sums array<string>")
    added = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(LENGTH)]
    return {r["cluster"]: (r["n"], [int(r[f"s{i}"]) for i in range(LENGTH)]) for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *added).collect()}


def centred(rows: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """The centroids after so many rounds."""
    centroids = start(rows, clusters, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = centroids.copy()
        for cluster, (n, sums) in summed(rows, centroids.copy()).items():
            centroids[cluster] = [s // n for s in sums]
    return centroids


def assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and squared distance of every vector."""
    bisectors = Bisectors.of(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = vectors_of(batch)
            own = bisectors.winners(x)
            far = ((x - bisectors.centroids[own]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.int32()), pa.array(far)], ["vec_id", "cluster", "distance"])

    return rows.mapInArrow(run, T.StructType([rows.schema["vec_id"], *T.StructType.fromDDL("cluster int, distance long")]))


def clustered(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """Of every usable vector its cluster, squared distance, inertia of the cluster and of all, and its centroid's hash."""
    own = usable(rows, vec_id, vector)
    centroids = centred(own)
    hashes = [(c, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids.tolist())]
    found = settle(assigned(own, centroids), "clusters") if hashes else assigned(own.limit(0), np.zeros((1, LENGTH), np.int64))
    per = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # one row per cluster
    rows_of = [(c, per.get(c, 0), sum(per.values()), h) for c, h in hashes]
    notes = rows.sparkSession.createDataFrame(rows_of, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(notes), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


_QUANTISED = f"""kept as (select vec_id, list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as x
from embeddings where len(embedding) = {LENGTH} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
c0 as (select cast(row_number() over (order by vec_id is null, sha256('{SEED}:' || coalesce(cast(vec_id as varchar), '')), x) - 1 as integer) as cluster, x as c
from kept qualify cluster < {CLUSTERS})"""


def _assigned(centroids: str) -> str:
    far = f"list_sum(list_transform(range(1, {LENGTH + 1}), lambda i: (x[i] - c[i]) * (x[i] - c[i])))"
    return f"""(select n, vec_id, x, arg_min(cluster, far * {CLUSTERS} + cluster) as cluster, min(far) as distance from (
select n, vec_id, x, cluster, cast({far} as bigint) as far from (select row_number() over () as n, * from kept) cross join {centroids}) group by n, vec_id, x)"""


def _round(before: str, after: str) -> str:
    mean = "(s - (((s % n) + n) % n)) // n"
    return f"""{after} as (select o.cluster, coalesce(m.c, o.c) as c from {before} o left join (
select cluster, list(cast({mean} as bigint) order by i) as c from (
select cluster, i, sum(x[i]) as s, count(*) as n from (select cluster, x, unnest(range(1, {LENGTH + 1})) as i from {_assigned(before)}) group by cluster, i)
group by cluster) m on o.cluster = m.cluster)"""


ORACLE = f"""with {_QUANTISED},
{", ".join(_round(f"c{i}", f"c{i + 1}") for i in range(ROUNDS))},
final as (select vec_id, cluster, distance from {_assigned(f"c{ROUNDS}")})
select vec_id, f.cluster as cluster, distance, cast(sum(distance) over (partition by f.cluster) as bigint) as cluster_inertia,
cast(sum(distance) over () as bigint) as inertia, sha256(array_to_string(c, ',')) as centroid_sha256
from final f join c{ROUNDS} c on f.cluster = c.cluster"""

QUERIES = {"op13_centroids": op13_centroids}
ORACLES = {"op13_centroids": ORACLE}
