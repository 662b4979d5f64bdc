"""The operators' results in plain Python, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def near_classes(docs, k, percent):
    sets = {}
    for doc_id, text in docs:
        w = WORD.findall(low(text))
        sets[doc_id] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    common = Counter((a, b) for ids in holders.values() for n, a in enumerate(ids) for b in ids[n + 1 :])
    for (a, b), c in common.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in sets}


def leaks(docs, items, width=10):
    words = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for item_id, text in items:
        w = words.findall(low(text))
        k = min(width, len(w))
        for j in range(len(w) - k + 1 if w else 0):
            windows[tuple(w[j : j + k])].add(str(item_id))
    out = {}
    for doc_id, text in docs:
        w, hit, found = words.findall(low(text)), set(), set()
        for k in {len(x) for x in windows}:
            for j in range(len(w) - k + 1):
                if names := windows.get(tuple(w[j : j + k])):
                    found |= names
                    hit.update(range(j, j + k))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc_id] = (len(w), len(hit), len(found), digest, bool(hit))
    return out


def base_spans(text):
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, "assign", m.end()) for m in re.finditer(assign, text, re.I | re.A) if len(m[2]) >= 12]
    for place, (kind, pattern, least) in enumerate((("access", "AKIA[A-Z0-9]+", 18), ("hex", "[0-9a-f]+", 16)), 1):
        found += [(m.start(), place, kind, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]
