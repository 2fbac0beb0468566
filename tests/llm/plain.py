"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def cover(flags_from, n, size):
    flags = [False] * n
    for k in flags_from:
        flags[k : k + size] = [True] * size
    return flags


def passages(rows, window):
    """(n_words, n_removed, kept text) of each (id, text)."""
    texts = [words(t) for _, t in rows]
    seen = Counter(tuple(w[k : k + window]) for w in texts for k in range(len(w) - window + 1))
    out = []
    for w in texts:
        gone = cover([k for k in range(len(w) - window + 1) if seen[tuple(w[k : k + window])] > 1], len(w), window)
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def as_it_stands(text, window, seen):
    """A text without the words of windows that `seen` counts twice and without the white space behind each such word."""
    found = list(WORD.finditer(text or ""))
    w = [m[0] for m in found]
    gone = cover([k for k in range(len(w) - window + 1) if seen[tuple(w[k : k + window])] > 1], len(w), window)
    ends = [m.start() for m in found[1:]] + [len(text or "")]
    lost = [(m.start(), e) for m, e, g in zip(found, ends, gone) if g]
    return "".join(c for i, c in enumerate(text or "") if not any(a <= i < b for a, b in lost))


def windows(rows, window):
    texts = [words(t) for _, t in rows]
    return Counter(tuple(w[k : k + window]) for w in texts for k in range(len(w) - window + 1))


def earlier(rows, length):
    """(n_bytes, n_removed, n_spans, kept bytes) of each (id, text)."""
    data = [(2**63 - 1 if i is None else i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in data:
        for k in range(len(b) - length + 1):
            s = b[k : k + length]
            first[s] = min(first.get(s, i), i)
    out = []
    for i, b in data:
        gone = cover([k for k in range(len(b) - length + 1) if first[b[k : k + length]] < i], len(b), length)
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(b), sum(gone), runs, bytes(c for c, g in zip(b, gone) if not g)))
    return out


def groups(n, linked):
    """For each of 0..n-1 the least number it is connected with."""
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            for j in range(n):
                if label[j] < label[i] and linked(i, j):
                    label[i], changed = label[j], True
    return label


def fingerprint(text, shingle=3):
    w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not w:
        return 0
    parts = [" ".join(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def sha(value):
    return hashlib.sha256(value.encode() if isinstance(value, str) else value).hexdigest()
