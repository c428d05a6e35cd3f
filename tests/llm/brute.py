"""Slow and plain versions of the operators, to test against."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ITEM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(0x41, 0x5B)}


def words(text):
    return SPACE.findall(text or "")


def sha(raw):
    return hashlib.sha256(raw if isinstance(raw, bytes) else raw.encode()).hexdigest()


def pieces(docs, tokenizer, end_id=2):
    """doc_id -> all ids."""
    return {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, end_id] for i, t in docs}


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def substring(docs, width=20):
    seen, out = set(), {}
    for i, t in sorted(docs):
        own = words(t)
        gone = [False] * len(own)
        for k in range(len(own) - width + 1):
            window = tuple(own[k : k + width])
            if window in seen:
                gone[k : k + width] = [True] * width
            seen.add(window)
        kept = [w for w, g in zip(own, gone, strict=True) if not g]
        out[i] = (len(own), len(own) - len(kept), sha(" ".join(kept)))
    return out


def statistics(text):
    own, text = words(text), text or ""
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    found = {}
    for k in range(len(own) - 2):
        found.setdefault(tuple(own[k : k + 3]), []).append(k)
    hit = {k + j for ks in found.values() if len(ks) > 1 for k in ks for j in range(3)}
    return (len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit),
            len(own) < 50 or 100 * len(hit) > 50 * len(own))


def shingles(text, size=5):
    own = words((text or "").translate(FOLD))
    if not own:
        return frozenset()
    if len(own) < size:
        return frozenset([tuple(own)])
    return frozenset(tuple(own[k : k + size]) for k in range(len(own) - size + 1))


def components(docs):
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            one, two = sets[a], sets[b]
            if one and two and 100 * len(one & two) >= 80 * len(one | two):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def contamination(docs, items, width=10):
    windows = {}
    for i, t in items:
        own = ITEM.findall((t or "").translate(FOLD))
        n = min(width, len(own))
        for k in range(len(own) - n + 1 if n else 0):
            windows.setdefault(tuple(own[k : k + n]), set()).add(str(i))
    sizes, out = {len(w) for w in windows}, {}
    for i, t in docs:
        own = ITEM.findall((t or "").translate(FOLD))
        hit, its = [False] * len(own), set()
        for n in sizes:
            for k in range(len(own) - n + 1):
                if found := windows.get(tuple(own[k : k + n])):
                    its |= found
                    hit[k : k + n] = [True] * n
        out[i] = (len(own), sum(hit), sorted(its))
    return out


def line_dedup(docs, least=10):
    key = lambda line: line.strip(" \t\n\r\x0b\x0c").translate(FOLD)
    holders = {}
    for i, t in docs:
        for line in (t or "").split("\n"):
            holders.setdefault(key(line), set()).add(i)
    out = {}
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or len(holders[key(x)]) < 2 or min(holders[key(x)]) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def byte_dedup(docs, width=50):
    seen, out = set(), {}
    for i, t in sorted(docs):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - width + 1):
            if raw[k : k + width] in seen:
                gone[k : k + width] = b"\1" * width
        seen.update(raw[k : k + width] for k in range(len(raw) - width + 1))
        spans = sum(1 for k in range(len(raw)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out[i] = (len(raw), len(raw) - len(kept), spans, sha(kept))
    return out
