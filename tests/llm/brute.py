"""Plain Python versions of the operators, for small tables."""

import re
from collections import defaultdict


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0d]+", lower(text)) if w]


def shingles(text):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def roots(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def near_components(rows):
    """Place in the list to the smallest doc_id of its component."""
    sets = [shingles(t) for _, t in rows]
    holders, pairs = defaultdict(list), set()
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    shared = defaultdict(int)
    for x, held in holders.items():
        for k, i in enumerate(held):
            for j in held[k + 1:]:
                shared[i, j] += 1
    for (i, j), n in shared.items():
        if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
            pairs.add((i, j))
    found = roots([(i, i) for i in range(len(rows))] + list(pairs))
    best = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            best[found[i]] = min(best.get(found[i], d), d)
    return [best.get(found[i]) for i in range(len(rows))], [len(s) for s in sets]
