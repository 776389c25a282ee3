"""Centroid clustering against a plain version that compares all distances."""

import hashlib
import math
import random

import numpy as np

from conftest import SF
from lakewarden.llm import centroids


def plain(rows, clusters=16, rounds=3):
    kept = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in order[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centres = [[sum(col) // len(groups[k]) for col in zip(*groups[k])] if k in groups else c for k, c in enumerate(centres)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    total = {k: sum(f for _, c, f in found if c == k) for k in range(clusters)}
    return sorted(((-1 if i is None else i), k, f, total[k], sum(total.values()), hashlib.sha256(",".join(map(str, centres[k])).encode()).hexdigest())
                  for i, k, f in found)


def rows_of(df):
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in df.collect())


def table(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    for name in ("x", "cluster", "distance", "n", "c"):
        df = df.withColumn(name, df.vec_id)
    return df


def test_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert rows_of(centroids.op13_centroids(spark, SF)) == plain(rows)


def test_odd_vectors_ties_and_copies(spark):
    draw = random.Random(4)
    grid = [(i, [draw.choice([-1.0, 0.0, 1.0]) for _ in range(3)] + [0.5] * 61) for i in range(80)]  # many equal distances
    odd = [(500, None), (501, []), (502, [1.0] * 63), (503, [1.0] * 65), (504, [None] + [1.0] * 63), (505, [float("nan")] + [1.0] * 63),
           (506, [float("inf")] * 64), (507, [0.0] * 64), (None, [2.0] * 64), (3, [-0.01] * 64), (3, [-0.01] * 64), (3, [3.0] * 64)]
    for kind in ("float", "double"):
        rows = [(i, v) for i, v in grid + odd]
        want = plain([(i, None if v is None else [None if x is None else float(np.float32(x)) if kind == "float" else x for x in v]) for i, v in rows])
        assert rows_of(centroids.clustered(table(spark, rows, kind), "vec_id", "embedding")) == want


def test_few_and_none(spark):
    few = [(i, [float(i)] * 64) for i in range(5)]
    assert rows_of(centroids.clustered(table(spark, few), "vec_id", "embedding")) == plain(few)
    none = centroids.clustered(table(spark, []), "vec_id", "embedding")
    assert none.count() == 0 and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_sign_tests_keep_the_smaller_number():
    draw = np.random.default_rng(2)
    for k in (1, 2, 7, 16):
        centres, x = draw.integers(-2, 3, (k, 64)), draw.integers(-2, 3, (300, 64))
        centres[:, 2:] = x[:, 2:] = 0
        far = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
        assert (centroids.Bisectors.of(centres).winners(x) == far.argmin(axis=1)).all()
