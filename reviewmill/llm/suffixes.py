"""Removal of repeated byte strings with a partitioned, sparse suffix array.

Two equal strings of ``LENGTH`` bytes have their anchor (see ``spans``) at the same
place, so it is enough to sort the suffixes that start at anchors: if a string
occurs twice, two anchored suffixes share its part from the anchor on, and what
stands before the two anchors shares the rest. A suffix is sent with the bytes that its
windows need on both sides of the anchor. Suffixes whose anchor gram occurs once cannot match and are
left out by a count-min sketch that never undercounts (``windows.sketch``).

Splitters are taken from a bounded sample of suffixes and cut the suffixes into ranges
by their leading tokens (eight bytes each, ``LEAD`` tokens make the anchor gram). A range is sorted in
one task by multikey quicksort. Neighbours' common prefixes then give, for each
prefix length, the classes of equal prefixes; the same is done for what stands before the
anchors. A string is the pair of a left and a right class, and all but the earliest in
a pair are repeats.

Suffixes with the same leading tokens always meet in one range, unless these tokens are so frequent that
they hold more than a range of the sample. Such a run would cross range boundaries, so it is not
sorted: its strings are compared across all boundaries by value (128 bits of the string, 96
of them kept). Repeats inside a map task are settled before anything is sent, so a passage in a third of all
documents brings one row per task.

Defined cases: a null text counts as empty; a text under ``LENGTH`` bytes keeps all; rows with equal or null
ids are documents of their own, in the order of their texts (see ``keyed``); an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import common, spans, windows
from reviewmill.llm.keyed import KEY, with_key

LENGTH, GRAM = 100, 32
#: Tokens of eight bytes that splitters look at.
LEAD = GRAM // 8
#: Sampled suffixes that the splitters come from, and suffixes of a range.
SAMPLE, RANGE_ROWS = 20_000, 60_000
_RIGHT, _LEFT = 104, 72  # bytes kept on both sides of an anchor, whole tokens
#: Segments up to this size are sorted on all tokens at once.
_SMALL = 4096


def runs_of(batch: pa.RecordBatch, length: int = LENGTH, gram: int = GRAM) -> tuple:
    """All texts' bytes, where each text starts, the text of each byte, and the anchored runs of windows."""
    data, bounds = common.flat_bytes(common.raw_texts(batch))
    text = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
    return data, bounds, text, spans.anchored_runs(spans.byte_codes()[data], text, length, gram)


def _grams(batch: pa.RecordBatch) -> np.ndarray:
    return runs_of(batch)[3].gram


def tokens_of(rows: np.ndarray) -> np.ndarray:
    """Rows of bytes as rows of big-endian tokens, whose order is the order of the bytes."""
    return np.ascontiguousarray(rows).view(">u8").astype(np.uint64)


def multikey_quicksort(tokens: np.ndarray) -> np.ndarray:
    """Order of the rows of ``tokens``: three-way partition on one token, equal parts go on with the next."""
    out, stack = [], [(np.arange(len(tokens)), 0)]
    while stack:
        part, depth = stack.pop()
        if depth == tokens.shape[1] or len(part) < 2:
            out.append(part)
        elif len(part) <= _SMALL:
            out.append(part[np.lexsort(tokens[part, depth:].T[::-1])])
        else:
            column = tokens[part, depth]
            pivot = np.sort(column[:: max(1, len(column) // 9)])[4]
            less, more = column < pivot, column > pivot
            stack.append((part[more], depth))
            stack.append((part[~(less | more)], depth + 1))
            stack.append((part[less], depth))
    return np.concatenate(out) if out else np.arange(0)


def common_prefix(rows: np.ndarray) -> np.ndarray:
    """Bytes that each row shares with the row before it; 0 for the first."""
    if not len(rows):
        return np.array([], np.int64)
    differ = rows[1:] != rows[:-1]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return np.r_[0, shared]


def _side(data: np.ndarray, at: np.ndarray, limit: np.ndarray, width: int, step: int) -> np.ndarray:
    """``width`` bytes from each place on (step 1) or before it, backwards (step -1); zero beyond the limit."""
    out = np.zeros((len(at), width), np.uint8)
    for k in range(width):
        place = at + k if step > 0 else at - 1 - k
        inside = place < limit if step > 0 else place >= limit
        out[inside, k] = data[place[inside]]
    return out


def repeats_in_range(
    content: list[bytes], off: np.ndarray, count: np.ndarray, key: np.ndarray, at: np.ndarray, length: int = LENGTH
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, first place, how many) of the windows in these rows whose string also starts earlier in them.

    Row i holds the bytes from its first window (at ``at``) to the end of its last of ``count``; the anchor is
    ``off`` bytes in.
    """
    data, bounds = common.flat_bytes(content)
    anchor = bounds[:-1] + off
    right = _side(data, anchor, bounds[1:], _RIGHT, 1)
    order = multikey_quicksort(tokens_of(right))
    shared = common_prefix(right[order])
    # Rows whose anchor gram nobody else has cannot match.
    group = np.cumsum(shared < GRAM)
    crowd = np.bincount(group)[group] > 1
    order, shared = order[crowd], shared[crowd]
    n = len(order)
    if not n:
        none = np.array([], np.int64)
        return none, none, none
    off, count, key, at = off[order], count[order], key[order], at[order]
    left = _side(data, anchor[order], bounds[:-1][order], _LEFT, -1)
    left_order = multikey_quicksort(tokens_of(left))
    left_shared = common_prefix(left[left_order])
    # Earlier means smaller key, or the same key and an earlier place; windows of one distance compare by anchors.
    earlier = np.empty(n, np.int64)
    earlier[np.lexsort((at + off, key))] = np.arange(n)
    lost = np.zeros((n, LENGTH - GRAM + 2), np.int8)  # window number in its row
    for before in range(length - GRAM + 1):
        # Windows that start ``before`` bytes ahead of the anchor.
        number = off - before
        rows = np.flatnonzero((number >= 0) & (number < count))
        if len(rows) < 2:
            continue
        right_class = np.cumsum(shared < length - before)
        left_class = np.empty(n, np.int64)
        left_class[left_order] = np.cumsum(left_shared < before)
        both = (right_class << 32 | left_class)[rows]
        nth = np.lexsort((earlier[rows], both))
        same = np.r_[False, both[nth][1:] == both[nth][:-1]]
        late = rows[nth[same]]
        lost[late, number[late]] = 1
    edges = np.diff(np.pad(lost, ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(edges == 1)
    _, last = np.nonzero(edges == -1)
    return key[row], at[row] + first, last - first


def _candidates(batch: pa.RecordBatch, sketch: np.ndarray, bits: int):
    """Runs of windows whose anchor gram is estimated to occur more than once."""
    data, bounds, text, runs = runs_of(batch)
    wanted = windows.estimated_repeated(runs.gram, sketch, bits)
    first, count, anchor = runs.window[wanted], runs.count[wanted], runs.anchor[wanted]
    return data, bounds, text, first, count, anchor


def _leading(data: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """The leading tokens of suffixes, as fixed-size byte strings (an anchor gram never leaves its text)."""
    rows = data[anchor[:, None] + np.arange(GRAM)] if len(anchor) else np.zeros((0, GRAM), np.uint8)
    return np.ascontiguousarray(rows).view(f"S{GRAM}").ravel()


def _splitters(docs: DataFrame, merged: bytes, bits: int) -> tuple[np.ndarray, set[bytes]]:
    """Splitters between ranges, and the leading tokens that fill a range of the sample on their own."""
    shared = docs.sparkSession.sparkContext.broadcast(merged)
    total = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    # About this many suffixes if all were candidates; the sample of documents is small enough to give SAMPLE of them.
    suffixes = max(1, 2 * total // (LENGTH - GRAM + 2))
    share = min(1.0, 4 * SAMPLE / suffixes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(shared.value, np.uint8)
        for batch in common.steps(batches):
            data, _, _, _, _, anchor = _candidates(batch, table, bits)
            lead = _leading(data, anchor)
            yield common.columns_to_batch("lead", pa.array([x.ljust(GRAM, b"\0") for x in lead.tolist()], pa.binary()))

    some = docs.filter(F.pmod(F.xxhash64(KEY), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    found = some.select("text").mapInArrow(run, "lead binary")
    # One number per lead keeps the sample small even if one long text is in it.
    kept = found.orderBy(F.xxhash64("lead", F.monotonically_increasing_id())).limit(SAMPLE)
    sample = sorted(bytes(r["lead"]) for r in kept.collect())
    ranges = max(1, min(len(sample) // 20, -(-suffixes // RANGE_ROWS)))
    cuts = [sample[len(sample) * i // ranges] for i in range(1, ranges)]
    crowded = {a for a, b in zip(cuts, cuts[1:]) if a == b}
    return np.array(sorted(set(cuts)), f"S{GRAM}"), crowded


_ROWS = "bucket int, kind int, content binary, h1 long, h2 int, off int, n int, key long, at int"


def _rows(docs: DataFrame, merged: bytes, cuts: np.ndarray, crowded: set[bytes], bits: int) -> DataFrame:
    """Kind 0: suffixes for their range; 1: strings of crowded leading tokens by value; 2: settled repeats."""
    shared = docs.sparkSession.sparkContext.broadcast(merged)
    ranges = len(cuts) + 1
    hot = np.array(sorted(crowded), f"S{GRAM}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(shared.value, np.uint8)
        for batch in common.steps(batches):
            data, bounds, text, first, count, anchor = _candidates(batch, table, bits)
            raw, digest = data.tobytes(), xxhash.xxh3_128_digest
            lead = _leading(data, anchor)
            spread = np.isin(lead, hot) if len(hot) else np.zeros(len(lead), bool)
            keys = np.asarray(batch.column(KEY))[text[first]] if len(first) else np.array([], np.int64)
            place, off = first - bounds[text[first]], anchor - first
            yield from suffix_rows(raw, lead, ~spread, first, count, off, keys, place)
            if spread.any():
                at = np.flatnonzero(spread)
                one = np.repeat(first[at], count[at]) + (
                    np.arange(int(count[at].sum())) - np.repeat(np.cumsum(count[at]) - count[at], count[at])
                )
                h = np.frombuffer(b"".join([digest(raw[a : a + LENGTH]) for a in one.tolist()]), np.int64).reshape(-1, 2)
                key, pos = np.repeat(keys[at], count[at]), one - np.repeat(bounds[text[first[at]]], count[at])
                h1, h2 = h[:, 0], (h[:, 1] & np.int64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
                order, new = windows.earliest(h1, h2, key, pos)
                yield from batch_of(
                    np.where(new, h1[order] % ranges, key[order] % ranges), np.where(new, 1, 2),
                    pa.nulls(len(order), pa.binary()), h1[order], h2[order], np.zeros(len(order)),
                    np.ones(len(order)), key[order], pos[order],
                )

    def suffix_rows(raw, lead, wanted, first, count, off, keys, place):
        pick = np.flatnonzero(wanted)
        stop = first + count - 1 + LENGTH
        content = [raw[a:b] for a, b in zip(first[pick].tolist(), stop[pick].tolist())]
        # The same bytes with the same anchor twice in this step: the later one is a repeat throughout.
        mark = np.array([hash(c) for c in content], np.int64)
        order, new = windows.earliest(mark, off[pick], keys[pick], place[pick])
        late = np.ones(len(pick), bool)
        late[order[new]] = False
        # A hash is no proof: a repeat must equal the row it is settled by.
        leader = np.empty(len(pick), np.int64)
        leader[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else order
        for i in np.flatnonzero(late).tolist():
            late[i] = content[i] == content[int(leader[i])]
        bucket = np.searchsorted(cuts, lead[pick], side="right") if len(cuts) else np.zeros(len(pick), np.int64)
        yield from batch_of(
            np.where(late, keys[pick] % ranges, bucket), np.where(late, 2, 0),
            pa.array([None if x else c for x, c in zip(late.tolist(), content)], pa.binary()),
            np.zeros(len(pick)), np.zeros(len(pick)), off[pick], count[pick], keys[pick], place[pick],
        )

    def batch_of(bucket, kind, content, h1, h2, off, n, key, at):
        kinds = (np.int32, np.int32, None, np.int64, np.int32, np.int32, np.int32, np.int64, np.int32)
        cols = [c if k is None else np.asarray(c).astype(k) for c, k in zip((bucket, kind, content, h1, h2, off, n, key, at), kinds)]
        for a in range(0, len(cols[0]), 100_000):
            yield common.columns_to_batch("bucket,kind,content,h1,h2,off,n,key,at", *(c[a : a + 100_000] for c in cols))

    return docs.select(KEY, "text").mapInArrow(run, _ROWS)


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats of one range after the other, from rows in order of their range."""
    held: list[pa.RecordBatch] = []
    bucket = None
    for batch in windows.with_end(batches):
        if batch is None:
            if held:
                yield from _one_range(pa.Table.from_batches(held))
            return
        buckets = np.asarray(batch.column("bucket"))
        cuts = np.r_[0, np.flatnonzero(np.diff(buckets)) + 1, len(buckets)]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if a == b:
                continue
            if held and buckets[a] != bucket:
                yield from _one_range(pa.Table.from_batches(held))
                held = []
            bucket = buckets[a]
            held.append(batch.slice(a, b - a))


def _one_range(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    kind = rows.column("kind").to_numpy()
    col = {c: rows.column(c).to_numpy() for c in ("h1", "h2", "off", "n", "key", "at")}
    settled = kind == 2
    if settled.any():
        yield common.columns_to_batch("key,at,n", *(col[c][settled] for c in ("key", "at", "n")))
    by_value = np.flatnonzero(kind == 1)
    if len(by_value):
        order, new = windows.earliest(*(col[c][by_value] for c in ("h1", "h2", "key", "at")))
        late = by_value[order[~new]]
        yield common.columns_to_batch("key,at,n", *(col[c][late] for c in ("key", "at", "n")))
    pick = np.flatnonzero(kind == 0)
    if len(pick):
        content = rows.column("content").take(pa.array(pick)).to_pylist()
        key, at, n = repeats_in_range(
            content, col["off"][pick].astype(np.int64), col["n"][pick].astype(np.int64), col["key"][pick],
            col["at"][pick].astype(np.int64),
        )
        yield common.columns_to_batch("key,at,n", key, at.astype(np.int32), n.astype(np.int32))


def repeated_strings(docs: DataFrame, bits: int = windows.SKETCH_BITS) -> DataFrame:
    """(key, at, n): runs of ``n`` consecutive places where a string starts that also starts earlier."""
    merged = windows.sketch_of(docs, _grams, bits)
    cuts, crowded = _splitters(docs, merged, bits)
    rows = _rows(docs, merged, cuts, crowded, bits)
    dealt = rows.repartition(max(1, len(cuts) + 1), "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(_settle, "key long, at int, n int")


def removal(docs: DataFrame, bits: int = windows.SKETCH_BITS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.steps(batches):
            out = []
            found = batch.column("runs").to_pylist()
            for text, runs in zip(common.raw_texts(batch), found):
                kept, removed, parts = cut_out(text, runs)
                out.append((len(text), removed, parts, hashlib.sha256(kept).hexdigest()))
            n, removed, parts, digest = zip(*out)
            yield common.columns_to_batch(
                "doc_id,n_bytes,n_removed,n_spans,kept_sha256", batch.column("doc_id"), pa.array(n, pa.int64()),
                pa.array(removed, pa.int64()), pa.array(parts, pa.int64()), pa.array(digest, pa.string()),
            )

    keyed = with_key(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    found = repeated_strings(keyed, bits)
    # A run of places is one number: place and length side by side.
    packed = F.shiftleft(F.col("at").cast("long"), 32) + F.col("n")
    runs = found.groupBy(F.col("key").alias(KEY)).agg(F.collect_list(packed).alias("runs"))
    joined = keyed.join(runs, KEY, "left").select("doc_id", "text", "runs")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cut_out(text: bytes, runs: list[int] | None, length: int = LENGTH) -> tuple[bytes, int, int]:
    """What is left of a text, how many bytes went, and in how many maximal runs."""
    if not runs:
        return text, 0, 0
    packed = np.asarray(runs, np.int64)
    first = packed >> 32
    gone = spans.covered(first, first + (packed & 0xFFFFFFFF) - 1 + length, len(text))
    parts = int(np.count_nonzero(np.diff(np.r_[False, gone].astype(np.int8)) == 1))
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int(gone.sum()), parts
