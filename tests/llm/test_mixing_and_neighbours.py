"""Mixing to weights, and neighbours on space-filling curves."""

import collections
import itertools
import random

import numpy as np
import pytest

from lakewarden.llm import mixing, neighbours
from lakewarden.llm.hilbert import hilbert_keys
from odd import clashing, docs  # noqa: F401


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 5, "b": 1}, {"a": 1, "b": 1, "c": 1}, {"a": 0.5, "b": 0.3, "c": 0.15, "d": 0.05}])
def test_every_prefix_is_within_one_block(weights):
    slots = mixing.whole_weights(weights, 60)
    assert sum(slots.values()) == 60
    order = {p: s for s, places in mixing.cycle(slots).items() for p in places}
    assert sorted(order) == list(range(60))
    had = collections.Counter()
    for n in range(60):
        had[order[n]] += 1
        assert all(abs(had[s] - slots[s] / 60 * (n + 1)) < 1 for s in slots)


def test_whole_weights_add_up():
    draw = random.Random(1)
    for n in (1, 3, 40):
        weights = {f"s{i}": draw.random() ** 6 + 1e-9 for i in range(n)}
        got = mixing.whole_weights(weights, 100)
        assert sum(got.values()) == 100 and min(got.values()) >= 1


def mixed(docs, sizes, **more):
    rows = [(i, f"t{i}", s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    df = docs([(i, t) for i, t, _ in rows]).drop("source").join(
        docs([(0, None)]).sparkSession.createDataFrame([(i, s) for i, _, s in rows], "doc_id long, source string"), "doc_id"
    )
    return mixing.mix(df, **more).collect()


def test_all_rows_are_placed_by_weight(docs):
    sizes = {"hot": 700, "b": 150, "c": 90, None: 60}
    weights = {"hot": 0.4, "b": 0.3, "c": 0.2, None: 0.1}
    got = mixed(docs, sizes, weights=weights, block=4, resolution=20)
    assert len(got) == 1000 and len({r.doc_id for r in got}) == 1000
    assert len({(r.mix.slot, r.mix.offset) for r in got}) == 1000
    owners = collections.defaultdict(set)
    for r in got:
        owners[r.mix.slot].add(r.source)
    assert sorted(owners) == list(range(len(owners))) and all(len(o) == 1 for o in owners.values())
    first = max(r.mix.slot for r in got if r.mix.phase == 0) + 1
    had = collections.Counter()
    for n in range(first):
        had[next(iter(owners[n]))] += 1
        assert all(abs(had[s] - w * (n + 1)) < 1 for s, w in weights.items())
    assert all(r.mix.release <= r.mix.slot < r.mix.deadline for r in got if r.mix.phase == 0)


def test_small_pieces_rank_alike(docs, monkeypatch):
    monkeypatch.setattr(mixing, "PIECE", 7)
    got = mixed(docs, {"a": 300, "b": 50}, block=4)
    for s, n in (("a", 300), ("b", 50)):
        places = sorted(r.mix.block * 4 + r.mix.offset for r in got if r.source == s)
        assert places == list(range(n))


def test_mixing_odd_tables(docs, clashing):
    assert mixing.mix(docs([])).count() == 0
    assert mixing.mixed_order(clashing).columns == clashing.columns and mixing.mixed_order(clashing).count() == clashing.count()
    same = docs([(1, "a")] * 30 + [(None, None)] * 5)
    assert mixing.mix(same).count() == 35
    got = mixed(docs, {"a": 40, "b": 40, "z": 9}, weights={"a": 1, "b": 1, "y": 3}, block=4)
    tail = max(r.mix.slot for r in got if r.source != "z")
    assert all(r.mix.slot > tail for r in got if r.source == "z")


def test_curve_steps_from_cell_to_neighbouring_cell():
    cells = np.array(list(itertools.product(range(8), repeat=3)))
    keys = hilbert_keys(cells, 3)
    path = cells[np.argsort(keys)]
    assert sorted(keys) == list(range(512)) and (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def vectors(n, length, seed=0):
    draw = np.random.default_rng(seed)
    return (draw.normal(size=(n, length)) + draw.normal(size=(12, length))[draw.integers(0, 12, n)]).astype(np.float32)


def exact(x, ids, i, limit):
    far = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
    return [(int(ids[j]), far[j]) for j in np.lexsort((ids, far)) if j != i][:limit]


def test_recall_and_exact_scores(spark):
    x, ids = vectors(3000, 24).astype(float), np.arange(3000) * 5
    rows = spark.createDataFrame([(int(i), v.tolist(), 1, 2) for i, v in zip(ids, x)], "vec_id long, embedding array<float>, ids int, keys int")
    x = x.astype(np.float32).astype(float)
    got = collections.defaultdict(list)
    for r in neighbours.nearest(rows, rows.where("vec_id % 100 = 0"), "vec_id", "embedding").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    hits = 0
    for i in range(0, 3000, 20):
        want = exact(x, ids, i, 10)
        mine = sorted(got[ids[i]])
        assert [r for r, _, _ in mine] == list(range(1, 11)) and [(s, v) for _, v, s in mine] == sorted((s, v) for _, v, s in mine)
        hits += len({v for v, _ in want} & {v for _, v, _ in mine})
        far = {int(k): d for k, d in zip(ids, np.sqrt(((x - x[i]) ** 2).sum(axis=1)))}
        assert all(abs(far[v] - s) < 1e-9 for _, v, s in mine)
    assert hits / (150 * 10) >= 0.9


def test_odd_vectors_take_no_part(spark):
    good = [(i, [float(i), 1.0, 2.0]) for i in range(0, 5)]
    odd = [(100, None), (200, [0.0, 0.0, 0.0]), (300, [float("nan"), 1.0, 1.0]), (400, [1.0, None, 1.0]), (500, [float("inf"), 0.0, 1.0]), (None, [1.0, 1.0, 1.0]), (600, [])]
    rows = spark.createDataFrame(good + odd + [(700, [1.0, 2.0])] + [(1, [1.0, 1.0, 2.0])], "vec_id long, embedding array<double>")
    got = neighbours.nearest(rows, rows.where("vec_id % 100 = 0"), "vec_id", "embedding").collect()
    assert [(r.query_id, r.vec_id) for r in sorted(got, key=lambda r: r.rank)] == [(0, 1), (0, 2), (0, 3), (0, 4)]
    assert neighbours.nearest(rows.limit(0), rows.limit(0), "vec_id", "embedding").count() == 0


def test_a_vector_that_many_rows_share(spark):
    x = vectors(200, 8, 1).tolist()
    rows = spark.createDataFrame([(i, x[0] if i % 3 == 0 else x[i % 200]) for i in range(900)], "vec_id long, embedding array<double>")
    got = neighbours.nearest(rows, rows.where("vec_id = 300"), "vec_id", "embedding").orderBy("rank").collect()
    assert [r.vec_id for r in got] == list(range(0, 30, 3)) and all(r.score == 0 for r in got)
