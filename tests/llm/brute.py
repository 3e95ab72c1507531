"""Plain versions of what the operators compute, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def license_places(text):
    own, places, labels = words(text), [], set()
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        parts = phrase.split()
        for i in range(len(own)):
            if own[i:i + len(parts)] == parts:
                places.append(i)
                labels.add(label)
    return len(own), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def contamination(text, items):
    windows = defaultdict(set)
    for item, passage in items:
        own = words(passage)
        size = min(10, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            windows[tuple(own[i:i + size])].add(item)
    own, hit, found = words(text), set(), set()
    for size in {len(w) for w in windows}:
        for i in range(len(own) - size + 1):
            if tuple(own[i:i + size]) in windows:
                hit.update(range(i, i + size))
                found |= windows[tuple(own[i:i + size])]
    names = sorted(str(x) for x in found if x is not None)
    return len(own), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)


def repeats(texts, length):
    raws = [(t or "").encode() for t in texts]
    count = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for raw in raws:
        gone = [False] * len(raw)
        for i in range(len(raw) - length + 1):
            if count[raw[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def passages(texts, length, least):
    """Per text the stretches covered by repeated strings of ``length`` bytes that hold ``least`` whole words."""
    raws = [(t or "").encode() for t in texts]
    count = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for raw in raws:
        covered = set()
        for i in range(len(raw) - length + 1):
            if count[raw[i:i + length]] > 1:
                covered.update(range(i, i + length))
        starts = sorted(i for i in covered if i - 1 not in covered)
        ends = sorted(i + 1 for i in covered if i + 1 not in covered)
        words = [m.span() for m in re.finditer(rb"[^ \t-\r]+", raw)]
        out.append([
            (a, b) for a, b in zip(starts, ends, strict=True) if sum(a <= x and y <= b for x, y in words) >= least
        ])
    return out


def shingle_set(text, width):
    own = (text or "").encode().lower().split()
    size = min(width, len(own))
    return frozenset(tuple(own[i:i + size]) for i in range(len(own) - size + 1)) if own else frozenset()


def grouped(ids, linked):
    """Least id of the component of each position; ``linked(i, j)`` tells whether two link."""
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                parent[find(i)] = find(j)
    least = {}
    for i, name in enumerate(ids):
        if name is not None:
            least[find(i)] = min(name, least.get(find(i), name))
    return [least.get(find(i)) for i in range(len(ids))]


def jaccard_components(rows, width, percent):
    sets = [shingle_set(t, width) for _, t in rows]

    def linked(i, j):
        a, b = sets[i], sets[j]
        return bool(a) and bool(b) and 100 * len(a & b) >= percent * len(a | b)

    return [len(s) for s in sets], grouped([i for i, _ in rows], linked)


def crc(raw):
    return zlib.crc32(raw)
