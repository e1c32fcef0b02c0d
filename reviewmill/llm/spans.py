"""Word and byte arrays of many texts at once, rolling hashes, and content-defined anchors of windows.

A window is a fixed number of consecutive units (words or bytes) of one text. Its
anchor is the k-gram inside it with the least hash, the leftmost of equals.
Two equal windows have their anchors at the same place, so whatever all
windows must be compared for can be looked up by anchors, of which there are
few: neighbouring windows mostly share one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

_MUL = np.uint64(0xD6E8FEB86659FD93)  # odd multipliers of a 64-bit mixer
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(32))) * _MUL
    x = (x ^ (x >> np.uint64(32))) * _MUL
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=1)
def byte_codes() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


#: Bytes that end a benchmark word become spaces, capitals become small letters.
WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
    for c in range(256)
)


def single_spaced(text: bytes) -> bytes:
    """Words between ASCII white space (space, \\x09-\\x0D), joined by one space."""
    return b" ".join(text.split())


@lru_cache(maxsize=1)
def _place_codes() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * _MUL) | np.uint64(1)


@dataclass
class Words:
    """Words of several single-spaced texts in one buffer."""

    data: bytes
    start: np.ndarray  # byte where a word starts
    end: np.ndarray
    text: np.ndarray  # which text it belongs to
    first: np.ndarray  # index of the first word of each text, one entry more than texts

    def hashes(self) -> np.ndarray:
        """64-bit hashes of the words, a sum over their bytes."""
        buffer = np.frombuffer(self.data, np.uint8)
        if not len(self.start):
            return np.array([], np.uint64)
        # A byte's code is multiplied by an odd number for its place in the word, then summed with what
        # stands between the words as zero; the sum is mixed.
        value = byte_codes()[buffer]
        place = np.arange(len(buffer), dtype=np.int64)
        place -= np.repeat(self.start, np.diff(np.r_[self.start, len(buffer)]))
        value *= _place_codes()[np.minimum(place, 255)] + (place >> 8).astype(np.uint64) * _MUL
        value[self.end[:-1]] = 0
        return mix(np.add.reduceat(value, self.start) + (self.end - self.start).astype(np.uint64))


def split_words(texts: list[bytes]) -> Words:
    """Words of texts that are single-spaced already."""
    counts = np.array([x.count(b" ") + 1 if x else 0 for x in texts], np.int64)
    data = b" ".join([x for x in texts if x])
    spaces = np.flatnonzero(np.frombuffer(data, np.uint8) == 0x20)
    if data:
        start, end = np.r_[0, spaces + 1], np.r_[spaces, len(data)]
    else:
        start = end = np.array([], np.int64)
    return Words(data, start, end, np.repeat(np.arange(len(texts)), counts), np.r_[0, np.cumsum(counts)])


def grams(units: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` unit hashes (polynomial, then mixed)."""
    n = len(units) - k + 1
    if n <= 0:
        return np.array([], np.uint64)
    # Doubling: the hash of 2m units comes from two hashes of m units.
    parts, done, powers, size, block = None, 0, _BASE, 1, units
    todo = k
    while todo:
        if todo & 1:
            piece = block[done : done + n]
            parts = piece.copy() if parts is None else parts * powers + piece
            done += size
        todo >>= 1
        if todo:
            block = block[: len(block) - size] * powers + block[size:]
            powers = np.multiply(powers, powers)
            size *= 2
    return mix(parts)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by doubling."""
    n, block, size = len(values) - width + 1, values, 1
    if n <= 0:
        return values[:0]
    while 2 * size <= width:
        block = np.minimum(block[: len(block) - size], block[size:])
        size *= 2
    return np.minimum(block[:n], block[width - size : width - size + n])


@dataclass
class Runs:
    """Runs of consecutive windows that share an anchor, over all texts of a buffer."""

    window: np.ndarray  # unit index of the run's first window
    count: np.ndarray  # how many windows
    anchor: np.ndarray  # unit index of the anchor
    gram: np.ndarray  # hash of the anchor's k-gram


def anchored_runs(units: np.ndarray, text: np.ndarray, length: int, k: int) -> Runs:
    """Anchors of all windows of ``length`` units that stay inside one text."""
    hashes = grams(units, k)
    width = length - k + 1
    if len(units) < length:
        none = np.array([], np.int64)
        return Runs(none, none, none, none.astype(np.uint64))
    places = max(1, int(len(hashes)).bit_length())
    low = np.uint64((1 << places) - 1)
    keyed = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    anchor = (sliding_least(keyed, width) & low).astype(np.int64)
    whole = np.flatnonzero(text[: len(anchor)] == text[length - 1 :])
    anchor, owner = anchor[whole], text[whole]
    if not len(whole):
        return Runs(whole, whole, whole, whole.astype(np.uint64))
    begins = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])])
    count = np.diff(np.r_[begins, len(whole)])
    return Runs(whole[begins], count, anchor[begins], hashes[anchor[begins]])


def covered(first: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    """Marks units in any of the half-open spans."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, last, -1)
    return np.cumsum(change[:-1]) > 0
