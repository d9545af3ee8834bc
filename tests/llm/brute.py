"""Plain versions of the corpus operators, for small tables."""

from __future__ import annotations

import collections
import hashlib
import math
import re

WORD = re.compile("[^\x20\x09-\x0d]+")
_LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def components(rows, size=5, percent=80):
    sets = {}
    for d, t in rows:
        w = WORD.findall((t or "").translate(_LOWER))
        sets[d] = {tuple(w[j : j + size]) for j in range(max(1, len(w) - size + 1))} if w else set()
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for d, s in sets.items():
        for g in s:
            holders[g].append(d)
    for d, s in sets.items():
        for x, both in collections.Counter(x for g in s for x in holders[g] if x < d).items():
            if 100 * both >= percent * (len(s) + len(sets[x]) - both):
                a, b = find(d), find(x)
                parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d)) for d in sets}


def repeats(rows, length=100):
    first = {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            first.setdefault(b[i : i + length], (d, i))
    out = {}
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < (d, i):
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[d] = (len(b), sum(gone), runs, sha(bytes(x for x, y in zip(b, gone, strict=True) if not y)))
    return out


def windows(rows, length=13):
    first = {}
    texts = {d: WORD.findall(t or "") for d, t in rows}
    for d in sorted(texts):
        for i in range(len(texts[d]) - length + 1):
            first.setdefault(tuple(texts[d][i : i + length]), d)
    out = {}
    for d, w in texts.items():
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if first[tuple(w[i : i + length])] < d:
                gone[i : i + length] = [True] * length
        out[d] = (len(w), sum(gone), " ".join(x for x, y in zip(w, gone, strict=True) if not y))
    return out


_PII = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
)


def luhn(digits: str) -> bool:
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def personal(text) -> str:
    out = []
    for order, (kind, pattern) in enumerate(_PII):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False, "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if fine:
                out.append((m.start(), order, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def jump(key: int, shards: int) -> int:
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def thue_morse(n: int = 1024) -> tuple[str, str]:
    """A word of a and b, and its complement: they agree under every polynomial hash modulo 2**64 with an odd base."""
    a = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return a, a.translate(str.maketrans("ab", "ba"))


def bootstrap(edges, least_known=3, least_share=0.8):
    """Accepted patterns by kind, from distinct (pattern, entity, kind or None), until a round makes nothing new known."""
    own = collections.defaultdict(set)
    for p, e, _ in edges:
        own[p].add(e)
    known = {(e, k) for _, e, k in edges if k}
    while True:
        accepted = {}
        for p, es in own.items():
            best = []
            for kind in {k for _, k in known}:
                n = sum((e, kind) in known for e in es)
                if n >= least_known and n / len(es) >= least_share:
                    best.append((n / len(es) * math.log2(n + 1), kind))
            if best:
                accepted[p] = max(best)[1]
        grown = known | {(e, k) for p, k in accepted.items() for e in own[p]}
        if grown == known:
            return accepted
        known = grown
