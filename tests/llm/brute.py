"""Brute-force versions of the operators, on lists of (doc_id, text)."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LAST = 2**63 - 1


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def order(doc):
    return LAST if doc is None else doc


def long_repeats(docs, window=50):
    first = {}
    for doc, text in docs:
        b = (text or "").encode()
        for i in range(len(b) - window + 1):
            first[b[i:i + window]] = min(first.get(b[i:i + window], LAST), order(doc))
    out = []
    for doc, text in docs:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if first[b[i:i + window]] < order(doc):
                gone[i:i + window] = b"\1" * window
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((doc, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def word_repeats(docs, window=13):
    words = [re.findall("[^\x20\x09-\x0D]+", text or "") for _, text in docs]
    first = {}
    for (doc, _), ws in zip(docs, words):
        for i in range(len(ws) - window + 1):
            w = tuple(ws[i:i + window])
            first[w] = min(first.get(w, LAST), order(doc))
    out = []
    for (doc, _), ws in zip(docs, words):
        gone = [False] * len(ws)
        for i in range(len(ws) - window + 1):
            if first[tuple(ws[i:i + window])] < order(doc):
                gone[i:i + window] = [True] * window
        out.append((doc, len(ws), sum(gone), sha(" ".join(w for w, g in zip(ws, gone) if not g).encode())))
    return out


def line_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOW)


def repeated_lines(docs, min_docs=10, keep_first=False):
    seen, first = Counter(), {}
    for doc, text in docs:
        lines = (text or "").split("\n")
        seen.update({line_key(x) for x in lines} - {""})
        for i, x in enumerate(lines):
            first[line_key(x)] = min(first.get(line_key(x), (LAST, 0)), (order(doc), i))
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for i, x in enumerate(lines) if seen[line_key(x)] < min_docs
                or keep_first and first[line_key(x)] == (order(doc), i)]
        out.append((doc, len(lines), len(lines) - len(kept), sha("\n".join(kept).encode())))
    return out


def fingerprint(text, shingle=3):
    words = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, distance=3):
    """Smallest id reachable of each (id, fingerprint)."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= distance:
                parent[find(i)] = find(j)
    low = defaultdict(list)
    for i, (doc, _) in enumerate(prints):
        if doc is not None:
            low[find(i)].append(doc)
    return [(doc, f"{fp:016x}", min(low[find(i)], default=None)) for i, (doc, fp) in enumerate(prints)]


def bench_words(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def contamination(docs, items, window=10):
    out = []
    patterns = {}  # equal ones of several items are compared once
    for item, text in items:
        ws = bench_words(text)
        m = min(window, len(ws))
        for i in range(len(ws) - m + 1) if m else ():
            patterns.setdefault(tuple(ws[i:i + m]), set()).update({str(item)} if item is not None else set())
    for doc, text in docs:
        ws = tuple(bench_words(text))
        hit, found = set(), set()
        for p, of in patterns.items():
            for i in range(len(ws) - len(p) + 1):
                if ws[i:i + len(p)] == p:
                    hit |= set(range(i, i + len(p)))
                    found |= of
        out.append((doc, len(ws), len(hit), len(found), sha(",".join(sorted(found)).encode()), bool(hit)))
    return out
