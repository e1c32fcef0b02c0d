"""Runs of periodically repeated words, found by longest common extensions over a difference cover.

A run is a stretch of words with least period q (words q apart are equal) of length at least
``max(LEAST, COPIES * q)`` that neither neighbour extends. ``find_runs`` lists the runs of every whole
text and gives the text without the repetitions: a word goes if a run holds it after that run's
first q words.

Words are split at ASCII white space and compared as they are. A step holds several texts as one row of
word numbers with a separator of its own between two texts.

* Harmonic grid: a run of period p has at least ``need = max(LEAST, COPIES * p) - p`` places i with equal
  words at i and i + p, so some place of a grid of step ``(need + 1) // 2`` is followed by at least
  ``need - step + 1`` equal places. The grid pairs of all periods are n log n many; nearly all
  differ within few words. Texts without a pair that stays equal are settled.
* Longest common extension: of the other texts only the suffixes at the places of a difference cover
  (5 residues of 21) are sorted, by prefix doubling from 21-word blocks. Two places are compared
  for at most 20 words until both are in the cover; the rest is a range minimum over the common
  prefixes of sorted neighbours, from a sparse table. A second structure over the reversed words extends
  to the left.
* A stretch found with several periods is named by the least one (periods of one stretch of this length
  are multiples of it).

Texts are independent: there is no shuffle. Memory follows the longest text: about 100 bytes per word of
a text that has runs, 20 of one that has none.

Defined cases: null and empty texts have no words, no runs and an empty collapsed text; rows with equal
or null ids get a row each; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from reviewmill.llm import common

LEAST, COPIES = 6, 4
#: A difference cover: every difference modulo 21 is that of two of these residues.
COVER, MODULUS = (3, 6, 7, 12, 14), 21
#: Grid pairs that are held at a time, and bytes of text that are split into words at a time.
PAIRS, SLICE = 1 << 20, 1 << 20
_SPACE = b" \t\n\x0b\x0c\r"


def _sync_table() -> np.ndarray:
    """Fewest steps from two places (by residue) until both are in the cover."""
    inside = np.isin(np.arange(MODULUS), COVER)
    out = np.empty((MODULUS, MODULUS), np.int64)
    for i in range(MODULUS):
        for j in range(MODULUS):
            out[i, j] = next(d for d in range(MODULUS) if inside[(i + d) % MODULUS] and inside[(j + d) % MODULUS])
    return out


_SYNC = _sync_table()
_PLACE = np.searchsorted(COVER, np.arange(MODULUS))


class Extensions:
    """Longest common extensions to the right in a row of numbers whose last one is found nowhere else."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        places = (np.arange(len(ids) // MODULUS + 1)[:, None] * MODULUS + np.array(COVER)).ravel()
        self.places = places[places < len(ids)]
        levels = self._ranks()
        self.rank = levels[-1]
        self.table = self._minima(self._neighbours(levels))

    def _ranks(self) -> list[np.ndarray]:
        """Ranks of the sampled suffixes by their first 21, 42, 84 … words, until all differ."""
        m, padded = len(self.places), np.r_[self.ids, np.zeros(MODULUS, self.ids.dtype)].astype(np.int64)
        if not m:
            return [np.empty(0, np.int32)]
        bits = int(padded.max()).bit_length() or 1
        per = 62 // bits
        keys = []
        for start in range(0, MODULUS, per):
            key = np.zeros(m, np.int64)
            for k in range(start, min(start + per, MODULUS)):
                key = (key << bits) | padded[self.places + k]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        new = np.zeros(m, bool)
        for key in keys:
            new[1:] |= np.diff(key[order]) != 0
        rank = np.empty(m, np.int32)
        rank[order] = np.cumsum(new)
        levels, step = [rank], len(COVER)
        while int(levels[-1].max()) < m - 1:
            rank = levels[-1].astype(np.int64)
            later = np.zeros(m, np.int64)
            later[: max(m - step, 0)] = rank[step:] + 1
            _, rank = np.unique(rank * (m + 1) + later, return_inverse=True)
            levels.append(rank.astype(np.int32))
            step *= 2
        return levels

    def _neighbours(self, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefixes of suffixes that follow each other in order, from the ranks of all levels."""
        m = len(self.places)
        order = np.empty(m, np.int64)
        order[levels[-1]] = np.arange(m)
        a, b = order[:-1].copy(), order[1:].copy()
        length = np.zeros(len(a), np.int64)
        for level in range(len(levels) - 1, -1, -1):
            same = np.flatnonzero((a < m) & (b < m))
            same = same[levels[level][a[same]] == levels[level][b[same]]]
            length[same] += MODULUS << level
            a[same] += len(COVER) << level
            b[same] += len(COVER) << level
        return (length + self._walk(self.places[order[:-1]] + length, self.places[order[1:]] + length, MODULUS)).astype(
            np.int32
        )

    def _walk(self, i: np.ndarray, j: np.ndarray, most) -> np.ndarray:
        """How many words from both places on are equal, ``most`` at most."""
        return walk(self.ids, i, j, most)

    @staticmethod
    def _minima(values: np.ndarray) -> list[np.ndarray]:
        table, size = [values], 1
        while 2 * size <= len(values):
            table.append(np.minimum(table[-1][:-size], table[-1][size:]))
            size *= 2
        return table

    def _sampled(self, at: np.ndarray) -> np.ndarray:
        return self.rank[at // MODULUS * len(COVER) + _PLACE[at % MODULUS]].astype(np.int64)

    def between(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common extensions of pairs of different places."""
        sync = _SYNC[i % MODULUS, j % MODULUS]
        out = self._walk(i, j, sync)
        far = np.flatnonzero(out == sync)
        if len(far):
            a, b = self._sampled(i[far] + sync[far]), self._sampled(j[far] + sync[far])
            low, high = np.minimum(a, b), np.maximum(a, b)
            level = np.frexp((high - low).astype(np.float64))[1] - 1
            for k in np.unique(level).tolist():
                here = level == k
                row = self.table[k]
                out[far[here]] += np.minimum(row[low[here]], row[high[here] - (1 << k)])
        return out


def walk(ids: np.ndarray, i: np.ndarray, j: np.ndarray, most) -> np.ndarray:
    """Equal words from pairs of places on, compared one by one up to ``most`` (a number or one per pair)."""
    most = np.broadcast_to(np.asarray(most), i.shape)
    out, alive, k = np.zeros(len(i), np.int64), np.flatnonzero(most > 0), 0
    while len(alive):
        alive = alive[ids[i[alive] + k] == ids[j[alive] + k]]
        k += 1
        out[alive] = k
        alive = alive[most[alive] > k]
    return out


def grid(start: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place, period, equal words asked for) of the grid pairs of all texts, some at a time."""
    for texts, periods in _periods(size):
        need = np.maximum(LEAST, COPIES * periods) - periods
        step = (need + 1) // 2
        room = size[texts] - periods  # places i with i + p inside the text
        points = (room - 1) // step + 1
        ends = np.cumsum(points)
        at, done = 0, 0
        while at < len(points):
            stop = max(int(np.searchsorted(ends, done + PAIRS, "right")), at + 1)
            some = points[at:stop]
            # One period of a very long text may have more points than fit.
            for low in range(0, int(some.max()), PAIRS):
                part = np.clip(some - low, 0, PAIRS)
                which = np.repeat(np.arange(at, stop), part)
                nth = np.arange(len(which)) - np.repeat(np.cumsum(part) - part, part) + low
                yield (
                    texts[which], start[texts[which]] + nth * step[which], periods[which], (need - step + 1)[which]
                )
            done, at = int(ends[stop - 1]), stop


def _periods(size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, period) for all periods that fit ``COPIES`` times, some at a time."""
    most = np.where(size >= LEAST, size // COPIES, 0)
    ends = np.cumsum(most)
    total = int(ends[-1]) if len(ends) else 0
    for low in range(0, total, PAIRS):
        nth = np.arange(low, min(low + PAIRS, total))
        text = np.searchsorted(ends, nth, "right")
        yield text, nth - (ends - most)[text] + 1


def runs_of(texts: list[np.ndarray]) -> list[np.ndarray]:
    """(start, length, period) rows by start, then period, of each row of word numbers (from 0)."""
    size = np.array([len(x) for x in texts], np.int64)
    out = [np.empty((0, 3), np.int64)] * len(texts)
    ids, start = _joined(texts)
    open_ = np.zeros(len(texts), bool)
    for text, i, p, asked in grid(start, size):
        fresh = ~open_[text]
        text, i, p, asked = text[fresh], i[fresh], p[fresh], np.minimum(asked[fresh], MODULUS)
        open_[text[walk(ids, i, i + p, asked) == asked]] = True
    chosen = np.flatnonzero(open_)
    if not len(chosen):
        return out
    ids, start = _joined([texts[k] for k in chosen])
    right, left = Extensions(ids), Extensions(ids[::-1])
    found = [np.empty((0, 3), np.int64)]
    for _, i, p, asked in grid(start, size[chosen]):
        few = np.minimum(asked, MODULUS)
        keep = np.flatnonzero(walk(ids, i, i + p, few) == few)
        i, p, asked = i[keep], p[keep], asked[keep]
        on = right.between(i, i + p)
        i, p, on = i[on >= asked], p[on >= asked], on[on >= asked]
        # In the reversed row the word before i stands at len - i.
        back = left.between(len(ids) - i, len(ids) - i - p)
        begin, end = i - back, i + p + on
        long = end - begin >= np.maximum(LEAST, COPIES * p)
        found.append(_least_periods(np.stack([begin[long], end[long], p[long]], axis=1)))
        if len(found) > 32:
            found = [_least_periods(np.concatenate(found))]
    rows = _least_periods(np.concatenate(found))
    owner = np.searchsorted(start, rows[:, 0], "right") - 1
    rows = np.stack([rows[:, 0] - start[owner], rows[:, 1] - rows[:, 0], rows[:, 2]], axis=1)
    order = np.lexsort((rows[:, 2], rows[:, 0], owner))
    rows, owner = rows[order], owner[order]
    cuts = np.searchsorted(owner, np.arange(len(chosen) + 1))
    for k, a, b in zip(chosen.tolist(), cuts[:-1].tolist(), cuts[1:].tolist()):
        out[k] = rows[a:b]
    return out


def _least_periods(rows: np.ndarray) -> np.ndarray:
    """One row per (begin, end), with the least period."""
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    return rows[np.flatnonzero(np.r_[True, (np.diff(rows[:, :2], axis=0) != 0).any(axis=1)])] if len(rows) else rows


def _joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All rows with a separator of its own before and after each, and where each row starts."""
    size = np.array([len(x) for x in texts], np.int64)
    start = np.cumsum(size + 1) - size
    top = max((int(x.max()) for x in texts if len(x)), default=0) + 1
    ids = np.empty(int(size.sum()) + len(texts) + 1, np.int32)
    for x, a in zip(texts, start.tolist()):
        ids[a : a + len(x)] = x
    ids[np.r_[0, start + size]] = top + np.arange(len(texts) + 1)
    return ids, start


def slices(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, about ``SLICE`` bytes at a time."""
    at = 0
    while at < len(text):
        end = at + SLICE
        while end < len(text) and text[end] not in _SPACE:
            end += 1
        yield text[at:end].split()
        at = end


def _numbers(text: bytes, names: dict[bytes, int]) -> np.ndarray:
    parts = [np.fromiter(map(names.__getitem__, words), np.int32, len(words)) for words in slices(text)]
    return np.concatenate(parts) if parts else np.empty(0, np.int32)


def collapsed(text: bytes, size: int, rows: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not len(rows):
        return b" ".join(b" ".join(words) for words in slices(text) if words)
    change = np.zeros(size + 1, np.int32)
    np.add.at(change, rows[:, 0] + rows[:, 2], 1)
    np.add.at(change, rows[:, 0] + rows[:, 1], -1)
    stay, at, out = np.cumsum(change[:-1]) == 0, 0, []
    for words in slices(text):
        kept = [words[k] for k in np.flatnonzero(stay[at : at + len(words)]).tolist()]
        if kept:
            out.append(b" ".join(kept))
        at += len(words)
    return b" ".join(out)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every text; runs are ordered by start, then period."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.steps(batches):
            texts = common.raw_texts(batch)
            names: dict[bytes, int] = defaultdict(count().__next__)
            numbers = [_numbers(x, names) for x in texts]
            names.clear()
            found = runs_of(numbers)
            rows = np.concatenate(found)
            lists = pa.ListArray.from_arrays(
                pa.array(np.cumsum([0, *map(len, found)]), pa.int32()),
                pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(3)], fields=list(_RUN)),
            )
            left = pa.array([collapsed(x, len(n), r) for x, n, r in zip(texts, numbers, found)], pa.binary())
            yield common.columns_to_batch(
                "doc_id,n_words,runs,collapsed", batch.column("doc_id"),
                pa.array([len(n) for n in numbers], pa.int64()), lists, left.cast(pa.string()),
            )

    shape = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, shape)
