"""Plain versions of the operators' contracts, for small tables."""

import collections
import hashlib
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def joined(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(spans))


def exact(rows):
    """doc_id -> (keep_id, size) of texts that are equal up to white space."""
    groups = collections.defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    return {d: (min(g), len(g)) for g in groups.values() for d in g}


def substring(docs, window):
    words = {i: WORD.findall(t or "") for i, t in docs.items()}
    first = {}
    for i in sorted(words):
        for p in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][p : p + window]), (i, p))
    out = {}
    for i, w in words.items():
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < (i, p):
                gone |= set(range(p, p + window))
        out[i] = (len(w), len(gone), sha(" ".join(x for q, x in enumerate(w) if q not in gone)))
    return out


def suffix(docs, length):
    raw = {i: (t or "").encode() for i, t in docs.items()}
    seen = collections.Counter(x[p : p + length] for x in raw.values() for p in range(len(x) - length + 1))
    out = {}
    for i, x in raw.items():
        flags = bytearray(len(x))
        for p in range(len(x) - length + 1):
            if seen[x[p : p + length]] > 1:
                flags[p : p + length] = b"\1" * length
        spans = sum(1 for q in range(len(x)) if flags[q] and not (q and flags[q - 1]))
        out[i] = (len(x), sum(flags), spans, sha(bytes(y for y, z in zip(x, flags) if not z)))
    return out


def fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = WORD.findall(lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, linked):
    """Smallest key that links lead to, for each key of ``values``."""
    root = {k: k for k in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(values)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if linked(values[a], values[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def secrets(text):
    assign = re.compile(r"((?:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
    spans = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m.group(2)) >= 12]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    return spans + [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 16]


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def pii(text):
    spans = []
    for rank, (kind, pattern) in enumerate(PII.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0
            fits = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and luhn,
                "phone": lambda: 10 <= len(digits) <= 15,
            }[kind]()
            if fits:
                spans.append((m.start(), rank, kind, m.end()))
    return spans
