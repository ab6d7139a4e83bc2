"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k=5):
    w = SPACED.findall((text or "").translate(UPPER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def ngram_join(docs, percent=80):
    """{doc_id: (n_shingles, component_id)}"""
    s = [(d, shingles(t)) for d, t in docs]
    root = {d: d for d, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(s):
        for b, y in s[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {d: (len(x), find(d)) for d, x in s}


def decontam(docs, bench, k=13):
    """{doc_id: (n_words, n_hit, n_items, items_sha256, contaminated)}"""
    windows = defaultdict(set)
    for item, text in bench:
        w = tuple(PLAIN.findall((text or "").translate(UPPER)))
        for i in range(max(1, len(w) - k + 1) if w else 0):
            windows[w[i:i + k]].add(str(item))
    out = {}
    for d, text in docs:
        w = tuple(PLAIN.findall((text or "").translate(UPPER)))
        hit, items = set(), set()
        for m in {len(x) for x in windows}:
            for i in range(len(w) - m + 1):
                got = windows.get(w[i:i + m])
                if got:
                    hit |= set(range(i, i + m))
                    items |= got
        sha = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        out[d] = (len(w), len(hit), len(items), sha, len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def suffix_dedup(docs, k=50):
    """{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)}"""
    first = {}
    raw = [(d, (t or "").encode()) for d, t in docs]
    for d, b in raw:
        for i in range(len(b) - k + 1):
            s = b[i:i + k]
            first[s] = min(first.get(s, d), d)
    out = {}
    for d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - k + 1):
            if first[b[i:i + k]] < d:
                gone[i:i + k] = b"\1" * k
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
