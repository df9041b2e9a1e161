"""Plain versions of the contracts, one text at a time, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

LOWER = {c: c + 32 for c in range(65, 91)}
ITEM_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
WORD = re.compile("[^\x20\x09-\x0d]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(docs, items, size=13):
    """[(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)]"""
    windows = defaultdict(set)
    for item, text in items:
        words = ITEM_WORD.findall((text or "").translate(LOWER))
        w = min(size, len(words))
        for i in range(len(words) - w + 1 if w else 0):
            windows[tuple(words[i : i + w])].add(str(item))
    lengths = sorted({len(w) for w in windows})
    out = []
    for doc, text in docs:
        words = ITEM_WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if (key := tuple(words[i : i + n])) in windows:
                    found |= windows[key]
                    hit.update(range(i, i + n))
        bad = len(hit) > 0 and 20 * len(hit) >= len(words)
        out.append((doc, len(words), len(hit), len(found), sha(",".join(sorted(found))), bad))
    return out


def repeats(docs, size=35):
    """[(doc_id, n_words, n_removed, kept text)]"""
    all_words = [WORD.findall(text or "") for _, text in docs]
    counts = Counter(tuple(ws[i : i + size]) for ws in all_words for i in range(len(ws) - size + 1))
    out = []
    for (doc, _), ws in zip(docs, all_words):
        gone = set()
        for i in range(len(ws) - size + 1):
            if counts[tuple(ws[i : i + size])] > 1:
                gone.update(range(i, i + size))
        out.append((doc, len(ws), len(gone), " ".join(w for i, w in enumerate(ws) if i not in gone)))
    return out


def shingles(text, n=5):
    ws = WORD.findall((text or "").translate(LOWER))
    if not ws:
        return frozenset()
    return frozenset(tuple(ws[i : i + n]) for i in range(max(1, len(ws) - n + 1)))


def components(docs, percent=75):
    """[(doc_id, n_shingles, component_id)], by an inverted index over all shingles."""
    sets = [shingles(text) for _, text in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    seen_at = defaultdict(list)
    first = {}
    for i, s in enumerate(sets):
        if not s:
            continue
        if s in first:
            parent[root(i)] = root(first[s])
            continue
        first[s] = i
        common = Counter(j for x in s for j in seen_at[x])
        for j, both in common.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                parent[root(i)] = root(j)
        for x in s:
            seen_at[x].append(i)
    least = {}
    for i, (doc, _) in enumerate(docs):
        r = root(i)
        least[r] = doc if r not in least else min(least[r], doc)
    return [(doc, len(sets[i]), least[root(i)]) for i, (doc, _) in enumerate(docs)]
