"""Least-cost edits that give a conversation its form, row by row, as small table look-ups.

The form is ``(s?(ua)+)?`` on role initials. Behind every row a conversation is
in one of four states (nothing yet, after the system row, after a user row,
after an assistant row). ``step`` takes the costs of finishing from each state
behind a row to those before it, and tells from each state which edits to make.
Costs differ by small numbers, so vectors less their minimum are few and every
step is computed once per process.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

FINE, TRUNCATED, DUPLICATE, BLANK = range(4)
INITIALS = "sua"  # of roles that may be kept; others count as one more
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
# Where a row of the next role in turn leads, and that role.
NEXT = ((USER, "user"), (USER, "user"), (ASSISTANT, "assistant"), (USER, "user"))
INSERT, REROLE, DELETE, UNENDED = 2, 2, 3, 1
LEGAL = frozenset(("su", "ua", "au"))

Vector = tuple[int, int, int, int]


class Move(NamedTuple):
    """What is done at a row in a state: edit letters, roles put in before it, role given to it, state behind it, cost."""

    letters: str
    inserted: tuple[str, ...]
    role: str | None
    state: int
    cost: int


def code(role: str, fault: int) -> int:
    """One small number for all of a row that matters to the costs."""
    at = INITIALS.find(role[:1]) if role else -1
    return (at + 1) * 4 + fault


def fault_of(code: int) -> int:
    return code % 4


def lowered(raw: list[int]) -> tuple[Vector, int]:
    least = min(raw)
    return tuple(v - least for v in raw), least  # type: ignore[return-value]


def _with_inserts(raw: list[int]) -> list[int]:
    for _ in STATES:
        raw = [min(raw[s], INSERT + raw[NEXT[s][0]]) for s in STATES]
    return raw


FAR = 99
TERMINAL: Vector = tuple(_with_inserts([0, FAR, FAR, 0]))  # type: ignore[assignment]
GUESS: Vector = (0, 0, 0, 0)


@lru_cache(None)
def step(behind: Vector, code: int) -> tuple[Vector, int, tuple[Move, ...]]:
    """Costs before a row (less their minimum), that minimum, and the move from each state.

    Of equal costs the edit with the smallest letter is taken; as each letter
    leads to one state, that gives the least of all cheapest texts of letters.
    """
    fault, initial = fault_of(code), " " + INITIALS
    extra = UNENDED if fault == TRUNCATED else 0

    def edits(s: int) -> dict[str, tuple[int, int, str | None]]:
        out: dict[str, tuple[int, int, str | None]] = {"D": (DELETE, s, None)}
        if fault < DUPLICATE:
            role = initial[code // 4]
            if role in KEPT[s]:
                out["K"] = (extra, KEPT[s][role], None)
            out["R"] = (REROLE + extra, *NEXT[s])
        return out

    options = [edits(s) for s in STATES]
    full = _with_inserts([min(c + behind[to] for c, to, _ in own.values()) for own in options])

    def move(s: int) -> Move:
        best = [letter for letter, (c, to, _) in options[s].items() if c + behind[to] == full[s]]
        if INSERT + full[NEXT[s][0]] == full[s]:
            best.append("I")
        letter = min(best)
        if letter == "I":
            to, role = NEXT[s]
            rest = move(to)
            return Move("I" + rest.letters, (role, *rest.inserted), rest.role, rest.state, INSERT + rest.cost)
        c, to, role = options[s][letter]
        return Move(letter, (), role, to, c)

    moves = tuple(move(s) for s in STATES)
    return (*lowered(full), moves)


def back(codes: bytes, behind: Vector) -> Vector:
    """Costs before the first of these rows."""
    for c in reversed(codes):
        behind = step(behind, c)[0]
    return behind


def fixed_up(codes: bytes, old: Vector, before: Vector, new: Vector) -> Vector:
    """Costs before the first row from ``new`` ones behind the last, where ``old`` ones gave ``before``.

    Both are followed together only until they differ by a constant: from there
    on the earlier result holds.
    """
    for c in reversed(codes):
        if old == new:
            return before
        old, new = step(old, c)[0], step(new, c)[0]
    return new


def moves_of(codes: bytes, behind: Vector) -> list[tuple[Move, ...]]:
    """The moves at each row from each state, given the costs behind the last one."""
    out = []
    for c in reversed(codes):
        behind, _, moves = step(behind, c)
        out.append(moves)
    return out[::-1]


def exits(codes: bytes, behind: Vector) -> str:
    """The state behind the last row for each state before the first, as digits."""
    moves = moves_of(codes, behind)
    at = list(STATES)
    for own in moves:
        at = [own[s].state for s in at]
    return "".join(map(str, at))


def ending(state: int) -> tuple[str, ...]:
    """Roles put in behind the last row of a conversation."""
    out: tuple[str, ...] = ()
    while state not in (START, ASSISTANT):
        state, role = NEXT[state]
        out += (role,)
    return out


def edited(codes: bytes, roles: list[str], texts: list[str], behind: Vector, state: int, last: bool) -> tuple[str, list[str], int]:
    """Letters of the edits, the lines that remain, and their cost, from a state before the first row."""
    letters, lines, cost = [], [], 0
    for moves, role, text in zip(moves_of(codes, behind), roles, texts):
        move = moves[state]
        letters.append(move.letters)
        lines += [r + ":" for r in move.inserted]
        if not move.letters.endswith("D"):
            lines.append(f"{move.role or role}:{text}")
        state, cost = move.state, cost + move.cost
    if last:
        more = ending(state)
        letters.append("I" * len(more))
        lines += [r + ":" for r in more]
        cost += INSERT * len(more)
    return "".join(letters), lines, cost
