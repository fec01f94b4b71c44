"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import string
from collections import defaultdict

ASCII_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def substring_dedup(rows, window=50):
    first, out = {}, {}
    for d in sorted(d for d, _ in rows):
        w = words(dict(rows)[d])
        gone = [False] * len(w)
        mine = [tuple(w[i : i + window]) for i in range(len(w) - window + 1)]
        for i, k in enumerate(mine):
            if first.get(k, d) < d:
                gone[i : i + window] = [True] * window
        for k in mine:
            first.setdefault(k, d)
        out[d] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    return out


def line_dedup(rows, threshold=80):
    places, first = [], {}
    for d, t in sorted(rows):
        for p, line in enumerate((t or "").lower().split("\n")):
            line = re.sub("[\t\x0b\x0c\r]", " ", line)
            if line.strip(" "):
                places.append((d, p, line))
                first.setdefault(line, (d, p))
    sets = {x: {t for t in x.split(" ") if t} for x in first}
    links = defaultdict(set)
    for a in sets:
        for b in sets:
            if a != b and 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                links[a].add(b)
    removed, n_links = defaultdict(list), defaultdict(int)
    for d, p, line in places:
        n_links[d] += len(links[line])
        if (d, p) > first[line] or any(first[o] < (d, p) for o in links[line]):
            removed[d].append(p)
    return {d: (removed[d], n_links[d]) for d, _ in rows}


def shingles(text, k):
    w = words((text or "").translate(ASCII_LOWER))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def near_duplicates(rows, k, threshold=80):
    sets = {d: shingles(t, k) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def exact_groups(rows):
    """Of each normalised text: ids."""
    groups = defaultdict(list)
    for d, t in rows:
        groups[(t or "").translate(ASCII_LOWER)].append(d)
    return groups


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
