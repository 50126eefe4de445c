"""Plain Python versions of what the operators compute."""

import re


def words(text):
    return re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())


def shingles(text, k):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def components(rows, k, percent):
    """{doc_id: (size, smallest id)} of (doc_id, text) rows."""
    sets = [(i, shingles(t, k)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for n, (_, s) in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(n)
    seen = set()
    for ns in holders.values():
        for i, a in enumerate(ns):
            for b in ns[i + 1:]:
                if (a, b) in seen:
                    continue
                seen.add((a, b))
                x, y = sets[a][1], sets[b][1]
                if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)) and 100 * len(x & y) >= percent * len(x | y):
                    p, q = find(sets[a][0]), find(sets[b][0])
                    parent[max(p, q)] = min(p, q)
    return {i: (len(s), find(i)) for i, s in sets}
