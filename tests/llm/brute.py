"""Plain Python versions of the operators, over lists of (id, text)."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WHITE = re.compile("[\x20\x09-\x0d]")
WORD = re.compile(r"[^\W_]+")
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def near_duplicates(docs):
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders, shared = defaultdict(list), Counter()
    for i, found in sets.items():
        for shingle in found:
            holders[shingle].append(i)
    for ids in holders.values():
        for n, right in enumerate(ids):
            for left in ids[:n]:
                shared[left, right] += 1
    for (left, right), n in shared.items():
        if 100 * n >= 75 * (len(sets[left]) + len(sets[right]) - n):
            a, b = top(left), top(right)
            parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), top(i), top(i) == i) for i in sets}


def exact_duplicates(docs):
    groups = defaultdict(list)
    for i, text in docs:
        groups[WHITE.sub("", text or "")].append((-len(text or ""), i))
    out = {}
    for body, rows in groups.items():
        for _, i in rows:
            out[i] = (min(rows)[1], len(rows), i == min(rows)[1], hashlib.sha256(body.encode()).hexdigest())
    return out


def base_spans(text):
    text = text or ""
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(spans)]


def overlaps(docs, items, window=20, percent=75):
    """Every alignment that shares three words in a row, or with items under 11 words one: a stretch that passes always
    holds such a run."""
    words = {i: WORD.findall((t or "").lower()) for i, t in items}
    runs = {i: 3 if len(found) >= 11 else 1 for i, found in words.items()}
    places = defaultdict(list)
    for i, found in words.items():
        for at in range(len(found) - runs[i] + 1):
            places[tuple(found[at:at + runs[i]])].append((i, at))
    out = {}
    for doc, text in docs:
        found = WORD.findall((text or "").lower())
        shifts = {(i, p - at) for run in (1, 3) for p in range(len(found) - run + 1) for i, at in places.get(tuple(found[p:p + run]), ())}
        for i, shift in shifts:
            size = min(window, len(words[i]))
            same = [0 <= at + shift < len(found) and found[at + shift] == w for at, w in enumerate(words[i])]
            best = max((sum(same[k:k + size]), -(k + shift)) for k in range(len(same) - size + 1))
            if best[0] * 100 >= percent * size:
                out[doc, i] = max(out.get((doc, i), (0, 0, 0)), (*best, size))
    return {pair: (n, size, -start) for pair, (n, start, size) in out.items()}
