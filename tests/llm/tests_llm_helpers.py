"""Brute force that several tests share."""

import re
from collections import Counter


def words(text):
    return (text or "").encode().lower().split()


def brute_components(rows, k=3, num=85, den=100):
    """doc_id to (size of the shingle set, smallest id reachable)."""
    sets = [(i, frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if (w := words(t)) else frozenset()) for i, t in rows]
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, r in sets[:a]:
            if None not in (i, j) and s and r and den * len(s & r) >= num * len(s | r):
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), top(i)) for i, s in sets if i is not None}


def brute_leaks(rows, items, least=0.8):
    """(doc_id, item_id) of every window of the item's size that is similar enough."""

    def shingles(t):
        w = re.findall(r"[0-9a-z_\u0080-\U0010ffff]+", (t or "").lower())
        return [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []

    own = {i: shingles(u) for i, u in items}
    out = set()
    for d, t in rows:
        s = shingles(t)
        have = set(s)
        for i, u in own.items():
            if not u or not have & set(u):
                continue
            want = Counter(u)
            for a in range(max(1, len(s) - len(u) + 1)):
                both = sum((Counter(s[a : a + len(u)]) & want).values())
                if both / (len(s[a : a + len(u)]) + len(u) - both) >= least:
                    out.add((d, i))
                    break
    return out
