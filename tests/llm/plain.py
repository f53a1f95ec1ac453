"""Plain, slow versions of what the operators compute."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))


def shingles(text, size):
    w = words(text)
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def smallest_reachable(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def jaccard_components(texts: dict, size: int, threshold: int) -> dict:
    sets = {i: shingles(t, size) for i, t in texts.items()}
    holders = defaultdict(list)
    for i, s in sets.items():
        for token in s:
            holders[token].append(i)
    links = []
    for i, s in sets.items():
        common = Counter(j for token in s for j in holders[token] if j > i)
        links += [(i, j) for j, n in common.items() if 100 * n >= threshold * (len(s) + len(sets[j]) - n)]
    return smallest_reachable(texts, links)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits), 1):
        x = int(c) * (2 if i % 2 == 0 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


# The base patterns as they are stated.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            valid = {
                "email": lambda: True,
                "ip": lambda: all(int(x) <= 255 for x in m.group().split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 10 <= len(digits) <= 15,
            }[kind]()
            if valid:
                found.append((m.start(), rank, kind, m.end()))
    return sorted(found)
