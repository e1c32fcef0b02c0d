"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re

import xxhash


def ordered(rows):
    """Rows by (doc_id, text), nulls first: the order in which repeated windows count as earlier."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))


def _earlier_windows(units, size, seen):
    gone = [False] * len(units)
    for i in range(len(units) - size + 1):
        window = tuple(units[i : i + size])
        if window in seen:
            gone[i : i + size] = [True] * size
        else:
            seen.add(window)
    return gone


def windows(rows, size=20):
    seen, out = set(), []
    for doc_id, text in ordered(rows):
        words = (text or "").encode().split()
        gone = _earlier_windows(words, size, seen)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc_id, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def strings(rows, size=100):
    seen, out = set(), []
    for doc_id, text in ordered(rows):
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - size + 1):
            if raw[i : i + size] in seen:
                gone[i : i + size] = [True] * size
            else:
                seen.add(raw[i : i + size])
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return _WORD.findall((text or "").encode().lower())


def leaks(rows, items, size=10):
    wanted = {}
    for item_id, text in items:
        words = _words(text)
        n = min(size, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            wanted.setdefault(tuple(words[i : i + n]), set()).add(item_id)
    sizes = {len(w) for w in wanted}
    out = []
    for doc_id, text in rows:
        words, hit, found = _words(text), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                ids = wanted.get(tuple(words[i : i + n]))
                if ids:
                    hit.update(range(i, i + n))
                    found |= ids
        names = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(words), len(hit), names, bool(hit)))
    return out


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_components(points):
    """{point: representative} over links of at most three differing bits."""
    up = {p: p for p in points}

    def root(p):
        while up[p] != p:
            p = up[p]
        return p

    points = sorted(up)
    for i, a in enumerate(points):
        for b in points[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {p: root(p) for p in points}


def near_copies(rows):
    prints = [(doc_id, fingerprint(text)) for doc_id, text in rows]
    rep = near_components({f for _, f in prints})
    least = {}
    for doc_id, f in prints:
        if doc_id is not None:
            least[rep[f]] = min(least.get(rep[f], doc_id), doc_id)
    return [(doc_id, f"{f:016x}", least.get(rep[f])) for doc_id, f in prints]
