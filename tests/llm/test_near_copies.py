"""Near copies of the pipeline against brute force over pairs spread over similarities up to one."""

import random

import numpy as np
import pyarrow as pa
import pytest

import brute
import corpus_pipeline
from lakewarden.llm import near_copies, simhash
from odd import ODD, clashing, docs  # noqa: F401


def sets(text):
    words = brute.WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def near(x, y):
    return 5 * len(x & y) >= 4 * len(x | y)


def spread(seed=9, bases=60):
    """Texts with words changed in scattered places, and a passage that many texts share."""
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 8))) for _ in range(3000)]
    common = [draw.choice(words) for _ in range(90)]
    out = []
    for base in range(bases):
        own = [draw.choice(words) for _ in range(draw.randint(6, 300))]
        own = common + own[: draw.randint(5, 40)] if base % 3 == 0 else own
        for _ in range(5):
            copy = list(own)
            for _ in range(draw.randint(0, max(1, len(own) // 40))):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            out.append((7 * len(out) + 3, " ".join(w.upper() if draw.random() < 0.1 else w for w in copy)))
    return out


@pytest.mark.parametrize("repeated,neighbours,block,salted", [(8, 2, 2048, 16384), (2, 1, 3, 4), (10**9, 2, 1, 10**9), (2, 1, 7, 3)])
def test_stage_keeps_one_of_each_component(spark, docs, monkeypatch, repeated, neighbours, block, salted):
    monkeypatch.setattr(near_copies, "BLOCK", block)
    monkeypatch.setattr(near_copies, "SALTED", salted)
    monkeypatch.setattr(near_copies, "REPEATED", repeated)
    monkeypatch.setattr(near_copies, "NEIGHBOURS", neighbours)
    rows = spread()
    own = {i: sets(t) for i, t in rows}
    ratios = [len(own[a] & own[b]) / len(own[a] | own[b]) for a in own for b in own if a < b]
    assert all(any(lo <= r < lo + 0.05 for r in ratios) for lo in (0.7, 0.75, 0.8, 0.85, 0.9, 0.95))
    want = set(brute.classes(own, near).values())
    assert {r.doc_id for r in corpus_pipeline.without_near_copies(spark, docs(rows), "").collect()} == want


def test_simhash_links_what_is_near_in_bits(spark, docs, monkeypatch):
    """Prints within 2 bits are in one component of the candidates, and the stage takes the similar ones from there."""
    draw = random.Random(4)
    rows = []
    for base in range(12):
        own = ["".join(draw.choice("abcdefghij") for _ in range(6)) for _ in range(draw.randint(500, 1500))]
        for changed in (0, 1, 1, 2, 150):
            at = draw.sample(range(500), changed)
            copy = [w + "x" if i in at else w for i, w in enumerate(own)] if changed < 9 else own[changed:]
            rows.append((7 * len(rows) + 3, " ".join(copy)))
    prints = {i: simhash.fingerprint(t, 5) for i, t in rows}
    own = {i: sets(t) for i, t in rows}
    close = {(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2}
    assert len([p for p in close if own[p[0]] != own[p[1]]]) > 5
    pairs = near_copies.settle(near_copies.print_pairs(docs(rows)), "pairs")
    found = {(r.a, r.b) for r in pairs.collect()}
    reached = brute.classes({i: i for i in prints}, lambda x, y: (min(x, y), max(x, y)) in found)
    assert all(reached[a] == reached[b] for a, b in close)
    similar = {(r.a, r.b) for r in near_copies.verified(pairs, docs(rows)).collect()}
    assert similar == {(a, b) for a, b in found if near(own[a], own[b])}
    kept = set(brute.classes({i: i for i in prints}, lambda x, y: (min(x, y), max(x, y)) in similar or own[x] == own[y]).values())

    def nothing(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(3)[:0]] * 2, ["a", "b"])

    monkeypatch.setattr(near_copies, "first_pairs", nothing)
    monkeypatch.setattr(near_copies, "other_pairs", lambda nearest: nothing)
    assert {r.doc_id for r in near_copies.keep_one(docs(rows)).collect()} == kept and len(kept) < len(rows)


def test_odd_tables(docs, clashing):
    kept = near_copies.keep_one(clashing)
    assert kept.columns == clashing.columns
    assert kept.count() == len(set(brute.classes({i: sets(t) for i, t in ODD}, near).values()))
    assert near_copies.keep_one(docs([])).count() == 0
    odd = near_copies.keep_one(docs([(None, "a b c d"), (None, "A b c d"), (None, "q r s t"), (3, "q r s t"), (3, "u v")])).collect()
    assert sorted(str(r.doc_id) for r in odd) == ["3", "None"]
    for order in (1, -1):
        twice = near_copies.keep_one(docs([(3, "q r s t"), (3, "b b"), (3, "u v")][::order])).collect()
        assert [r.text for r in twice] == ["b b"]


def test_blocks_of_lists_in_any_batches(monkeypatch):
    """Every row of a list that has company once, in blocks of bounded size, however the rows arrive."""
    monkeypatch.setattr(near_copies, "BLOCK", 4)
    draw = random.Random(2)
    rows = sorted((draw.randrange(12) ** 2, draw.choice([-1, -1, 0, 1]) if k > 6 else -1, draw.randrange(40)) for k in range(30) for _ in range(draw.randint(1, 6)))
    key = [(s, d) for s, d, _ in rows]
    for size in (1, 2, 3, 5, 8, 1000):
        table = pa.table({"shingle": [r[0] for r in rows], "deal": pa.array([r[1] for r in rows], pa.int32()), "node": list(range(len(rows))),
                          "mark": [r[2] for r in rows], "n": pa.array([1] * len(rows), pa.int32()), "left": pa.array([1] * len(rows), pa.int32())})
        got = [r for b in near_copies.in_blocks(iter(table.to_batches(max_chunksize=size))) for r in b.to_pylist()]
        want = sorted({(s, d, m) for s, d, m in rows if d != -1 or len({x for a, b, x in rows if (a, b) == (s, d)}) > 1})
        assert sorted((r["shingle"], r["deal"], r["mark"]) for r in got) == want and len(key) > len(want)
        blocks = {}
        for r in got:
            blocks.setdefault((r["shingle"], r["deal"]), []).append(r["block"])
        assert all(sorted(b) == [i // 4 for i in range(len(b))] for b in blocks.values())


def test_bitmaps_never_differ_more_than_their_sets():
    draw = np.random.default_rng(1)
    for n in (0, 1, 50, 5000):
        x = np.unique(draw.integers(0, 2**63, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[: n // 2], draw.integers(0, 2**63, n // 3).astype(np.uint64)]))
        bits = near_copies.shown_bits(pa.array([near_copies.bitmap(x), near_copies.bitmap(y)]))
        assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= len(np.setxor1d(x, y))
