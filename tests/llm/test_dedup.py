"""Operators that compare texts with each other."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash

import brute
from lakewarden.llm import exact_dedup, passages, simhash, substring_dedup, suffix_dedup
from odd import ODD, clashing, docs  # noqa: F401


def passages_table(seed=5, rows=120):
    """Texts that share passages of lengths around the windows, with copies and repeats inside a text."""
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 9))) for _ in range(400)]
    shared = [" ".join(draw.choice(words) for _ in range(n)) for n in (19, 20, 21, 45, 80, 200, 60)]
    out = []
    for i in range(rows):
        text = ""
        for _ in range(draw.randint(0, 4)):
            kind = draw.random()
            if kind < 0.4:
                text += draw.choice(shared)
            elif kind < 0.5:
                text += shared[draw.randint(0, 3)][draw.randint(0, 40) :]
            else:
                text += " ".join(draw.choice(words) for _ in range(draw.randint(0, 60)))
            text += draw.choice([" ", "\n\n", "\t ", "  "])
        out.append((100 + 3 * i, text))
    return out + ODD + [(2004, "x " * 30), (2005, "y z " * 12)]


def test_exact_verdicts(docs):
    rows = [*ODD, *[(20 + i, f"copy\t{i % 2}") for i in range(40)], (70, "copy  1")]
    got = {r.doc_id: r for r in exact_dedup.verdicts(docs(rows)).collect()}
    want = brute.exact(rows)
    assert {i: (r.keep_id, r.group_size) for i, r in got.items()} == want
    assert all(r.kept == (r.keep_id == i) for i, r in got.items())


@pytest.mark.parametrize("bits", [1 << 26, 64 * 8])
def test_exact_rows_that_stay(docs, clashing, bits):
    """A filter that is full lets more rows into the shuffle and changes nothing."""
    kept = exact_dedup.keep_first(clashing, bits)
    assert kept.columns == clashing.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({k for k, _ in brute.exact(ODD).values()})
    rows = [(1, "a"), (1, "a"), (None, "a"), (None, "b"), (None, "b")]
    assert sorted((str(r.doc_id), r.text) for r in exact_dedup.keep_first(docs(rows), bits).collect()) == [("1", "a"), ("None", "b")]
    assert exact_dedup.keep_first(docs([]), bits).count() == exact_dedup.verdicts(docs([]), bits).count() == 0


def test_texts_are_shuffled_once(spark, docs, tmp_path):
    """The windows and the removal read one shuffle of the texts; the other scan is of the rows without doc_id, which do not shuffle."""
    docs(passages_table(rows=20)).write.parquet(str(tmp_path / "documents.parquet"))
    held = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        found = substring_dedup.op4_substring_dedup(spark, str(tmp_path))
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert plan.count("ReadSchema: struct<doc_id:bigint,text:string>") == 2


def test_rows_that_occur_once_do_not_shuffle(docs):
    rows = [(i, f"text {i}") for i in range(200)] + [(900, "text 7")]
    hashes = docs(rows).selectExpr("xxhash64(text) as h")
    maybe = exact_dedup.repeat_filter(hashes)
    assert hashes.where(maybe("h")).count() == 2


def test_substring_windows(docs):
    rows = passages_table()
    got = {r.doc_id: r for r in substring_dedup.remove(docs(rows)).collect()}
    for i, want in brute.substring(dict(rows), 20).items():
        assert (got[i].n_words, got[i].n_removed, brute.sha(got[i].kept)) == want, i


def test_suffix_windows(docs):
    rows = passages_table()
    want = brute.suffix(dict(rows), 200)
    got = {r.doc_id: r for r in suffix_dedup.remove(docs(rows)).collect()}
    for i, w in want.items():
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, brute.sha(bytes(got[i].kept))) == w, i


def test_hot_seeds_are_counted_to_the_same_end(docs, monkeypatch):
    rows = passages_table(rows=60)
    monkeypatch.setattr(suffix_dedup, "HOT", 2)
    got = {r.doc_id: r.n_removed for r in suffix_dedup.remove(docs(rows)).collect()}
    assert got == {i: w[1] for i, w in brute.suffix(dict(rows), 200).items()}


@pytest.mark.parametrize("operator", [substring_dedup.remove, suffix_dedup.remove])
def test_passage_operators_on_odd_tables(docs, clashing, operator):
    assert operator(docs([])).count() == 0
    assert operator(docs([(1, None), (2, "")])).count() == 2
    assert operator(clashing).count() == len(ODD)
    text = " ".join(map(str, range(300)))
    got = operator(docs([(None, text), (None, text), (5, text)])).collect()
    assert [r.n_removed for r in got] == [0, 0, 0]


def shared_ids():
    """Passages of which many stand under a few doc_ids, each text a document of its own, in the order of its hash."""
    draw = random.Random(8)
    rows = [(draw.choice([7, 9, i]), text) for i, text in passages_table(rows=60)]
    rows += [(7, "short"), (7, None), (9, " ".join(f"only{n}" for n in range(90)))]
    keyed = {(i, int.from_bytes(xxhash.xxh64(t or "", 42).digest(), "big", signed=True)): t for i, t in rows}
    return [(i, t) for (i, _), t in keyed.items()], keyed


def test_substring_windows_of_shared_ids(docs):
    rows, keyed = shared_ids()
    got = sorted((r.doc_id, r.n_words, r.n_removed, brute.sha(r.kept)) for r in substring_dedup.remove(docs(rows)).collect())
    assert got == sorted((i, *want) for (i, _), want in brute.substring(keyed, 20).items())


@pytest.mark.parametrize("hot", [2, 1000])
def test_suffix_windows_of_shared_ids(docs, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rows, keyed = shared_ids()
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, brute.sha(bytes(r.kept))) for r in suffix_dedup.remove(docs(rows)).collect())
    assert got == sorted((i, *want) for (i, _), want in brute.suffix(keyed, 200).items())


def test_ids_of_one_text_need_no_variant(docs):
    rows = passages.readable(docs([(1, "a"), (1, "a"), (2, "a"), (3, "b"), (3, "c"), (None, "a")])).collect()
    assert sorted((r.doc_id, r.variant == 0) for r in rows) == [(1, True), (1, True), (2, True), (3, False), (3, False)]
    assert len({r.variant for r in rows}) == 3


def test_index_matches_are_the_longest_common_prefixes():
    draw = random.Random(1)
    parts = ["".join(draw.choice("ab") for _ in range(draw.randint(1, 40))).encode() for _ in range(30)]
    for length in (3, 8):
        index = suffix_dedup.RunLengthIndex(parts, length)
        windows = [(p[i : i + length], s + i) for p, s in zip(parts, index.starts) for i in range(len(p) - length + 1)]
        seen = [w for w, _ in windows]
        want = {place for w, place in windows if seen.count(w) > 1}
        assert set(np.flatnonzero(index.marks()).tolist()) == want
    assert len(index.letters) < index.run_lengths.sum() == len(index.symbols)


def test_runs_cover_every_window_once():
    for units in (passages.Units(20, 5, True), passages.Units(200, 64, False)):
        for _, text in passages_table():
            raw = (text or "").encode()
            _, _, first, size = passages.runs_of(raw, units, passages.Tables())
            n = len(units.cut(raw)[1]) - units.window + 1
            assert np.concatenate([np.arange(a, a + s) for a, s in zip(first, size)] or [np.zeros(0)]).tolist() == list(range(max(0, n)))


def test_chunks_of_windows_change_nothing(docs, monkeypatch):
    rows = passages_table(rows=40)
    monkeypatch.setattr(passages, "CHUNK", 64)
    got = {r.doc_id: r.n_removed for r in suffix_dedup.remove(docs(rows)).collect()}
    assert got == {i: w[1] for i, w in brute.suffix(dict(rows), 200).items()}


def near_copies(seed=3):
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcdefgh") for _ in range(4)) for _ in range(500)]
    rows = []
    for group in range(8):
        base = [draw.choice(words) for _ in range(400)]
        for _ in range(12):
            text = list(base)
            for _ in range(draw.randint(0, 2)):
                text[draw.randrange(400)] = draw.choice(words)
            rows.append((len(rows) * 2, " ".join(text)))
    return rows


def test_simhash_components(docs):
    rows = near_copies() + [(5001 + 2 * n, t) for n, (_, t) in enumerate(ODD)]
    prints = {i: brute.fingerprint(t) for i, t in rows}
    want = brute.classes(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    got = {r.doc_id: r for r in simhash.grouped(docs(rows)).collect()}
    assert {i: r.fp & (1 << 64) - 1 for i, r in got.items()} == prints
    assert {i: r.component_id for i, r in got.items()} == want
    assert len(set(want.values())) < len(set(prints.values()))


@pytest.mark.parametrize("distance,crowd", [(2, 64), (2, 4), (1, 4), (3, 4)])
def test_crowded_values_lose_no_link(spark, monkeypatch, distance, crowd):
    draw = random.Random(3)
    fps = {0, 1, 3}
    for base in (draw.getrandbits(64) for _ in range(2)):
        for _ in range(80):
            x = base
            for _ in range(draw.randint(0, 4)):
                x ^= 1 << draw.randrange(64)
            fps.add(x)
    values = dict(enumerate(fps))
    signed = [(i, x - (1 << 64) if x >> 63 else x) for i, x in values.items()]
    monkeypatch.setattr(simhash, "CROWD", crowd)
    roots = simhash.components(simhash.links(spark.createDataFrame(signed, "node long, fp long"), distance))
    got = {r.node: r.root for r in roots.collect()}
    want = brute.classes(values, lambda a, b: (a ^ b).bit_count() <= distance)
    assert {i: got.get(i, i) for i in values} == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 202), (201, 202)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {i: got.get(i, i) for i in (5, 40, 120, 201, 202)} == {5: 0, 40: 0, 120: 100, 201: 200, 202: 200}


def groups(rows):
    return set(brute.classes({i: brute.fingerprint(t) for i, t in rows}, lambda a, b: (a ^ b).bit_count() <= 2).values())


def test_one_row_of_each_group_stays(docs, clashing):
    rows = near_copies()
    assert {r.doc_id for r in simhash.keep_one(docs(rows)).collect()} == groups(rows)
    kept = simhash.keep_one(clashing)
    assert kept.columns == clashing.columns and kept.count() == len(groups(ODD))
    assert simhash.keep_one(docs([])).count() == 0
    odd = simhash.keep_one(docs([(None, "a b c d"), (None, "a b c d"), (3, "q r s t u"), (3, "q r s t u")])).collect()
    assert sorted(str(r.doc_id) for r in odd) == ["3", "None"]


def test_thresholds_by_dynamic_programming():
    assert simhash.allocate([[0, 5, 100], [0, 50, 600], [0, 7, 90]], 0) == [0, 0, 0]
    assert sorted(simhash.allocate([[0, 5, 10], [0, 500, 6000], [0, 700, 9000]], 0)) == [-1, 0, 1]
    costs = [[0, 3, 9, 40], [0, 8, 9, 80], [0, 1, 30, 90]]
    best = min(
        sum(c[t + 1] for c, t in zip(costs, (a, b, d)))
        for a in range(-1, 3) for b in range(-1, 3) for d in range(-1, 3) if a + b + d == 1
    )
    assert sum(c[t + 1] for c, t in zip(costs, simhash.allocate(costs, 1))) == best


def test_runs_of_a_hot_seed_are_all_kept(spark):
    """A passage in most texts, beside seeds that occur twice or once: the same runs as without dealing hot seeds out."""
    common = " ".join(f"c{i}" for i in range(30))
    twice = [" ".join(f"t{k}_{i}" for i in range(25)) for k in range(40)]
    texts = [f"{common} own{k} {twice[k % 40]}" for k in range(80)] + [" ".join(f"u{k}_{i}" for i in range(30)) for k in range(20)]
    docs = passages.readable(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    units = passages.Units(20, substring_dedup.GRAM, True)
    every = [tuple(r) for r in passages.runs(docs, units).collect()]
    count = Counter(r[0] for r in every)
    want = sorted((s, run, d, v, at // passages.SIZES, at % passages.SIZES) for s, run, d, v, at in every if count[s] > 1)
    assert max(count.values()) >= 80 > len(every) / passages.HOT_SEEDS
    assert sorted(map(tuple, passages.repeated_runs(docs, units).collect())) == want
