"""Plain re-statements of the operators, for small inputs."""

from __future__ import annotations

import bisect
import re
from collections import Counter
from itertools import combinations

import numpy as np

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def reachable(n, links):
    """The smallest index reachable from each of ``n`` points."""
    up = list(range(n))

    def find(a):
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        return a

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return [find(i) for i in range(n)]


def smallest_reachable(ids, links):
    roots = reachable(len(ids), links)
    least = {}
    for i, root in zip(ids, roots, strict=True):
        least[root] = i if root not in least else min((least[root], i), key=lambda x: (x is None, x))
    return [least[root] for root in roots]


def shingles(text, size=5):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, 1)))


def jaccard_classes(rows):
    sets = [shingles(text) for _, text in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    found = smallest_reachable([i for i, _ in rows], links)
    return [(i, len(s), c) for (i, _), s, c in zip(rows, sets, found, strict=True)]


def similar_vectors(rows, cosine=0.95):
    def sound(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    links = []
    for i, (_, v) in enumerate(rows):
        for j, (_, w) in enumerate(rows[:i]):
            if sound(v) and sound(w) and len(v) == len(w):
                a, b = np.array(v, float), np.array(w, float)
                if a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= cosine:
                    links.append((i, j))
    counts = Counter(x for link in links for x in link)
    found = smallest_reachable([i for i, _ in rows], links)
    return [(i, counts[k], c, i == c) for k, ((i, _), c) in enumerate(zip(rows, found, strict=True))]


def line_dedup(rows, min_docs=10):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    held = Counter(k for _, text in rows for k in {key(x) for x in (text or "").split("\n")})
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if not key(x) or held[key(x)] < min_docs]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return out


def best_fit_count(lengths, capacity):
    rooms, count = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, length)
        if at == len(rooms):
            count += 1
            room = capacity
        else:
            room = rooms.pop(at)
        if room > length:
            bisect.insort(rooms, room - length)
    return count


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, repeated, len(covered)


def url_tokens(url):
    host, path, query = re.match(r"[^:]*://([^/?#]*)([^?#]*)(?:\?([^#]*))?", url).groups(default="")
    parts = re.split(r"[/._-]", re.sub("[0-9]+", "0", path.lower()))
    names = [n.split("=")[0] for n in query.split("&")]
    tokens = {f"host={t}" for t in host.lower().split(".") if t}
    return tokens | {f"path={t}" for t in parts if t} | {f"query={t}" for t in names if t}


def mined_rules(rows, min_support=0.002, min_confidence=0.7, least_bad=5):
    """All token combinations of ``(url, bad)`` rows counted one by one; those with a rule inside go."""
    held, bad = Counter(), Counter()
    for url, label in rows:
        tokens = sorted(url_tokens(url))
        for size in range(1, len(tokens) + 1):
            for rule in combinations(tokens, size):
                held[rule] += 1
                bad[rule] += label
    good_enough = [r for r, n in bad.items() if n >= max(least_bad, min_support * len(rows)) and n >= min_confidence * held[r]]
    rules = {frozenset(r) for r in good_enough}
    return sorted(r for r in good_enough if not any(frozenset(c) in rules for k in range(1, len(r)) for c in combinations(r, k)))
