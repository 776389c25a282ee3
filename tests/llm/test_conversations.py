"""Conversation repair against a plain version: a forward search over (cost, audit), row by row."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from conftest import SF
from lakewarden.llm import conversations, turns

FORM = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def damage(rows):
    """Rows (conv, turn, role, text) to {conv: rows in order}."""
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        own += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {c: sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())) for c, own in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(SPACE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """(cost, audit, lines) least, over every cut of the form; states are the role initials so far, shortened."""

    def state(initials):
        return initials if len(initials) < 2 else initials[-1]

    def put(table, key, value):
        if key not in table or value[:2] < table[key][:2]:
            table[key] = value

    def legal(s, c):
        return c == "s" and s == "" or c == "u" and s in ("", "s", "a") or c == "a" and s == "u"

    def insert(table):
        for _ in range(3):
            for s, (cost, audit, lines) in list(table.items()):
                for role in ("user", "assistant"):
                    if legal(s, role[0]):
                        put(table, role[0], (cost + 2, audit + "I", lines + [role + ":"]))
        return table

    table = insert({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, found):
        after = {}
        for s, (cost, audit, lines) in table.items():
            put(after, s, (cost + 3, audit + "D", lines))
            if fault in ("", "truncated"):
                extra = fault == "truncated"
                if legal(s, role[:1]):
                    put(after, role[0], (cost + extra, audit + "K", lines + [f"{role}:{text}"]))
                for new in ("user", "assistant"):
                    if legal(s, new[0]):
                        put(after, new[0], (cost + 2 + extra, audit + "R", lines + [f"{new}:{text}"]))
        table = insert(after)
    return min(v for s, v in table.items() if s in ("", "a"))


def plain(rows):
    out = []
    for conv, own in damage(rows).items():
        found = faults(own)
        known = [t for t, _, _ in own if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        bad = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, lines = cheapest(own, found)
        assert FORM.fullmatch("".join(x[0] for x in lines))
        out.append((str(conv), gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")), bad, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out)


def rows_of(df):
    return sorted((str(r[0]), *r[1:]) for r in df.select("conv_id", *conversations.RESULT).collect())


def drawn(seed, convs, most):
    draw = random.Random(seed)
    texts = ["Yes.", "No", "Why?", " ", "", "x.\n", "y \t", "Well!", None, "ok"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User", "user"]
    out = []
    for c in range(convs):
        for turn in range(draw.randint(1, most)):
            at = None if draw.random() < 0.05 else turn - draw.choice([0, 0, 0, 1])
            text = draw.choice(texts)
            out.append((None if c == 0 else c, at, draw.choice(roles), text and text if draw.random() < 0.4 else f"{turn} {text}"))
    return out + out[:3]


def table(spark, rows, partitions):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(partitions)
    for name in ("n", "kind", "key", "codes", "part"):
        df = df.withColumn(name, df.conv_id)
    return df


def test_exhaustive_search_agrees_with_the_plain_one():
    """All edits of short conversations, none left out."""
    for roles in itertools.product("sua?", repeat=3):
        for found in itertools.product(("", "truncated", "blank"), repeat=3):
            rows = [(i, r, f"{i}") for i, r in enumerate(roles)]
            best = []
            inserts = ["", "I", "II"]
            options = [("D",) if f == "blank" else ("K", "Ru", "Ra", "D") for f in found]
            for edits in itertools.product(*options):
                for gaps in itertools.product(inserts, repeat=4):
                    shape, audit, cost = "", "", 0
                    for i in range(4):
                        for _ in gaps[i]:  # an inserted row takes the one role that may follow
                            shape += "a" if shape[-1:] == "u" else "u"
                            audit, cost = audit + "I", cost + 2
                        if i < 3:
                            e = edits[i]
                            audit += e[0]
                            cost += {"K": 0, "R": 2, "D": 3}[e[0]] + (e != "D" and found[i] == "truncated")
                            shape += "" if e == "D" else rows[i][1] if e == "K" else e[1]
                    if FORM.fullmatch(shape):
                        best.append((cost, audit))
            assert min(best) == cheapest(rows, found)[:2]


@pytest.mark.parametrize("rows,size", [(1, 10), (2, 40), (7, 10**9)])
def test_chunks_of_any_size(spark, monkeypatch, rows, size):
    monkeypatch.setattr(conversations, "CHUNK_ROWS", rows)
    monkeypatch.setattr(conversations, "CHUNK_BYTES", size)
    made = drawn(rows, 30, 12) + [(77, i, random.Random(i).choice(["user", "assistant", "system"]), f"{i % 50}." if i % 3 else f"{i % 20}") for i in range(400)]
    got = rows_of(conversations.repaired(conversations.damaged(table(spark, made, 5))))
    assert got == plain(made)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(conversations.op12_conversations(spark, SF)) == plain(rows)


def test_odd_tables(spark):
    assert rows_of(conversations.repaired(conversations.damaged(table(spark, [], 1)))) == []
    dropped = next(i for i in range(100) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    kept = next(i for i in range(100) if zlib.crc32(f"{i}:0".encode()) % 20 > 4)
    odd = [(dropped, 0, "user", "gone."), (kept, 0, "user", "same.")] + [(kept, 0, "user", "same.")] * 50 + [(900, None, None, None), (901, None, "user", "a.")]
    assert rows_of(conversations.repaired(conversations.damaged(table(spark, odd, 3)))) == plain(odd)


def test_a_guess_is_mended_where_it_matters():
    """From any vector behind them, rows lead to the costs that running them anew gives, and most meet soon."""
    draw = random.Random(3)
    codes = bytes(turns.code(draw.choice(["user", "assistant", "system", "x"]), draw.choice([0, 0, 1, 2])) for _ in range(500))
    ends = {turns.TERMINAL, turns.GUESS}
    for c in codes[:60]:
        ends |= {turns.step(v, c)[0] for v in list(ends)}
    for old, new in itertools.product(sorted(ends), repeat=2):
        assert turns.fixed_up(codes, old, turns.back(codes, old), new) == turns.back(codes, new)
