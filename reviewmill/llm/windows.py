"""Removal of repeated word windows, with a count-min sketch in front of the exact grouping.

First pass: every task adds the anchors of its word windows (see ``spans``) to a
count-min sketch; the sketches of all tasks are added up. A counter never
undercounts, and a window that occurs twice brings its anchor twice, so a
window with an anchor estimated at one cannot be repeated. Second pass: only
windows whose anchor is estimated as repeated are hashed (128 bits of the words, 96
of them kept) and grouped exactly; all but the earliest of a group are removed.
A false alarm of the sketch costs a row and changes nothing.

A task settles its own repeats first: of the equal windows it has seen only the
earliest is sent on, the others are removed anyway. So a passage that a third of
all documents share brings one row per task to the grouping.

The sketch has a fixed size (``SKETCH_BITS``), so what is broadcast does not grow. With
far more anchors than counters it lets more windows through to the exact grouping.

Defined cases: null and empty texts have no words; texts under ``WINDOW`` words have no
window; rows with equal or null ids are documents of their own, in the order
of their texts (see ``keyed``); an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import common, spans
from reviewmill.llm.keyed import KEY, with_key

WINDOW, GRAM = 20, 10
#: Counters per row of the sketch (as a power of two) and rows; counters take 2 bits once merged.
SKETCH_BITS, SKETCH_ROWS = 26, 2
#: Name of the column that carries a document's repeated windows.
STARTS = "_llm_window_starts"
#: Counters per slice of a sketch on its way to being merged.
_SLICE_BITS = 16


def _cells(gram: np.ndarray, bits: int, row: int) -> np.ndarray:
    return (spans.mix(gram + np.uint64(row * 0x632BE59BD9B4E019)) >> np.uint64(64 - bits)).astype(np.int64)


def _runs(batch: pa.RecordBatch, window: int, gram: int) -> tuple[spans.Words, spans.Runs]:
    words = spans.split_words([spans.single_spaced(x) for x in common.raw_texts(batch)])
    return words, spans.anchored_runs(words.hashes(), words.text, window, gram)


def _counted(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The counters that were hit, in order, and how often (2 stands for more)."""
    found, times = np.unique(cells, return_counts=True)
    return found, np.minimum(times, 2).astype(np.uint8)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    cells = np.concatenate([c for c, _ in parts])
    order = np.argsort(cells, kind="stable")
    cells, times = cells[order], np.concatenate([t for _, t in parts])[order].astype(np.int64)
    first = np.flatnonzero(np.diff(cells, prepend=-1))
    return cells[first], np.minimum(np.add.reduceat(times, first), 2).astype(np.uint8) if len(first) else times[:0]


def sketch_of(docs: DataFrame, grams_of: Callable[[pa.RecordBatch], np.ndarray], bits: int = SKETCH_BITS) -> bytearray:
    """The merged sketch of the anchors that ``grams_of`` finds: two bits per counter (0, 1, 2 or more), row after row."""
    width, slice_bits = 1 << bits, min(_SLICE_BITS, bits)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press, size = zstandard.ZstdCompressor(level=1), 1 << slice_bits
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in common.steps(batches):
            found = grams_of(batch)
            held += [_counted(_cells(found, bits, row) + row * width) for row in range(SKETCH_ROWS)]
            if len(held) > 64:
                held = [_summed(held)]
        if not held:
            return
        # Only the counters that this task has touched are kept; a slice is spread out to be packed.
        cells, times = _summed(held)
        cuts = np.flatnonzero(np.diff(cells >> slice_bits, prepend=-1))
        for at in range(0, len(cuts), 256):
            some = cuts[at : at + 256].tolist()
            packed = []
            for i, start in enumerate(some, at):
                stop = int(cuts[i + 1]) if i + 1 < len(cuts) else len(cells)
                counters = np.zeros(size, np.uint8)
                counters[cells[start:stop] & (size - 1)] = times[start:stop]
                packed.append(press.compress(counters.tobytes()))
            yield common.columns_to_batch(
                "slice,counters", (cells[some] >> slice_bits).astype(np.int32), pa.array(packed, pa.binary())
            )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds up the rows of each slice as they come, one slice after the other."""
        import zstandard

        opener, at, total = zstandard.ZstdDecompressor(), None, None
        for batch in batches:
            for number, packed in zip(batch.column("slice").to_pylist(), batch.column("counters").to_pylist()):
                if number != at:
                    if at is not None:
                        yield _quads(at, total)
                    at, total = number, np.zeros(1 << slice_bits, np.uint8)
                total += np.frombuffer(opener.decompress(packed), np.uint8)
                np.minimum(total, 2, out=total)
        if at is not None:
            yield _quads(at, total)

    parts = docs.select("text").mapInArrow(add, "slice int, counters binary")
    merged = parts.repartition("slice").sortWithinPartitions("slice").mapInArrow(merge, "slice int, counters binary")
    out = bytearray(SKETCH_ROWS * width // 4)
    size = (1 << slice_bits) // 4
    # One row per slice: a fixed number of rows of a fixed size, whatever the input.
    for row in merged.toLocalIterator():
        out[row["slice"] * size : (row["slice"] + 1) * size] = row["counters"]
    return out


def _quads(number: int, counters: np.ndarray) -> pa.RecordBatch:
    """One merged slice, four counters to a byte."""
    quad = counters.reshape(-1, 4)
    packed = quad[:, 0] | quad[:, 1] << 2 | quad[:, 2] << 4 | quad[:, 3] << 6
    return common.columns_to_batch("slice,counters", pa.array([number], pa.int32()), pa.array([packed.tobytes()], pa.binary()))


def estimated_repeated(gram: np.ndarray, merged: np.ndarray, bits: int) -> np.ndarray:
    """Which anchors the sketch counts at least twice in every row."""
    found = np.ones(len(gram), bool)
    for row in range(SKETCH_ROWS):
        cells = _cells(gram, bits, row) + row * (1 << bits)
        found &= (merged[cells >> 2] >> ((cells & 3) * 2).astype(np.uint8)) & 3 >= 2
    return found


def earliest(h1: np.ndarray, h2: np.ndarray, key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by (hash, key, place) and which of them come first of their hash."""
    order = np.lexsort((at, key, h2, h1))
    a, b = h1[order], h2[order]
    return order, np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(order) else np.array([], bool)


def _window_rows(docs: DataFrame, merged: bytearray, window: int, gram: int, bits: int) -> DataFrame:
    """(h1, h2, key, at, n): candidate windows with n = 0, and runs of n places that their own task has settled."""
    shared = docs.sparkSession.sparkContext.broadcast(merged)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(shared.value, np.uint8)
        held: list[list[np.ndarray]] = []
        for batch in common.steps(batches):
            words, runs = _runs(batch, window, gram)
            wanted = estimated_repeated(runs.gram, table, bits)
            first, count = runs.window[wanted], runs.count[wanted]
            at = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
            if not len(at):
                continue
            data, digest = words.data, xxhash.xxh3_128_digest
            hashes = b"".join(
                [digest(data[a:b]) for a, b in zip(words.start[at].tolist(), words.end[at + window - 1].tolist())]
            )
            h = np.frombuffer(hashes, np.int64).reshape(-1, 2)
            text = words.text[at]
            keys = np.asarray(batch.column(KEY))[text]
            held.append([h[:, 0], h[:, 1] & np.int64(0xFFFFFFFF), keys, at - words.first[text]])
            if sum(len(x[0]) for x in held) > 1_000_000:
                yield from settle(held)
                held = []
        if held:
            yield from settle(held)

    def settle(held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        h1, h2, key, at = (np.concatenate(x) for x in zip(*held))
        order, first = earliest(h1, h2, key, at)
        sent, late = order[first], order[~first]
        yield from rows(h1[sent], h2[sent], key[sent], at[sent], np.zeros(len(sent)))
        # What is settled goes as runs of places, dealt out by a mixed key.
        late = late[np.lexsort((at[late], key[late]))]
        k, p = key[late], at[late]
        begins = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (p[1:] != p[:-1] + 1)]) if len(late) else late
        k, p, n = k[begins], p[begins], np.diff(np.r_[begins, len(late)])
        yield from rows(spans.mix((k + p).view(np.uint64)).view(np.int64), np.zeros(len(k)), k, p, n)

    def rows(h1, h2, key, at, n) -> Iterator[pa.RecordBatch]:
        h2, at, n = h2.astype(np.uint32).view(np.int32), at.astype(np.int32), n.astype(np.int32)
        for a in range(0, len(h1), 200_000):
            part = slice(a, a + 200_000)
            yield common.columns_to_batch("h1,h2,key,at,n", h1[part], h2[part], key[part], at[part], n[part])

    return docs.select(KEY, "text").mapInArrow(run, "h1 long, h2 int, key long, at int, n int")


def _losers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order of h1: the settled runs, and all but the earliest place of each hash."""
    held = None
    for batch in with_end(batches):
        if batch is not None:
            got = [np.asarray(batch.column(c)) for c in ("h1", "h2", "key", "at", "n")]
            held = got if held is None else [np.concatenate(x) for x in zip(held, got)]
            cut = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
        elif held is None:
            return
        else:
            cut = len(held[0])
        now, held = [x[:cut] for x in held], [x[cut:] for x in held]
        if cut:
            settled, loose = np.flatnonzero(now[4] > 0), np.flatnonzero(now[4] == 0)
            order, first = earliest(*(x[loose] for x in now[:4]))
            late = np.r_[settled, loose[order[~first]]]
            if len(late):
                yield common.columns_to_batch("key,at,n", now[2][late], now[3][late], np.maximum(now[4][late], 1))


def with_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def repeated_windows(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, bits: int = SKETCH_BITS
) -> DataFrame:
    """(key, at, n): runs of ``n`` word places where a window starts whose words also start earlier."""
    merged = sketch_of(docs, lambda batch: _runs(batch, window, gram)[1].gram, bits)
    rows = _window_rows(docs, merged, window, gram, bits)
    return rows.repartition("h1").sortWithinPartitions("h1").mapInArrow(_losers, "key long, at int, n int")


def _kept(text: bytes, starts: list[int] | None, window: int) -> tuple[list[bytes], int]:
    """The words that stay, and how many there were."""
    words = text.split()
    if not starts:
        return words, len(words)
    packed = np.asarray(starts, np.int64)
    first = packed >> 32
    gone = spans.covered(first, first + (packed & 0xFFFFFFFF) - 1 + window, len(words))
    return [w for w, lost in zip(words, gone.tolist()) if not lost], len(words)


def _joined(docs: DataFrame, window: int, gram: int, bits: int) -> DataFrame:
    """``docs`` with a key and the places of repeated windows (null: none)."""
    found = repeated_windows(docs, window, gram, bits)
    # A run is one number: place and length side by side.
    packed = F.shiftleft(F.col("at").cast("long"), 32) + F.col("n")
    starts = found.groupBy(F.col("key").alias(KEY)).agg(F.collect_list(packed).alias(STARTS))
    return docs.join(starts, KEY, "left")


def removal(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, bits: int = SKETCH_BITS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.steps(batches):
            rows = []
            for text, starts in zip(common.raw_texts(batch), batch.column(STARTS).to_pylist()):
                kept, n = _kept(text, starts, window)
                rows.append((n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            n, removed, digest = zip(*rows)
            yield common.columns_to_batch(
                "doc_id,n_words,n_removed,kept_sha256", batch.column("doc_id"), pa.array(n, pa.int64()),
                pa.array(removed, pa.int64()), pa.array(digest, pa.string()),
            )

    keyed = with_key(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return _joined(keyed, window, gram, bits).select("doc_id", "text", STARTS).mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string"
    )


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, bits: int = SKETCH_BITS) -> DataFrame:
    """``docs`` without the repeated words. Other texts stay as they are; a text that loses words has its kept
    words joined by one space and its ``n_chars`` counted anew; a document that loses every word is left out."""
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.steps(batches):
            texts, stay = [], []
            old = batch.column("text").to_pylist()
            for text, starts in zip(old, batch.column(STARTS).to_pylist()):
                if starts:
                    kept, _ = _kept(text.encode(), starts, window)
                    text = b" ".join(kept).decode()
                    stay.append(bool(kept))
                else:
                    stay.append(True)
                texts.append(text)
            cols = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in [*columns, STARTS]]
            yield pa.RecordBatch.from_arrays(cols, [*columns, STARTS]).filter(pa.array(stay))

    found = _joined(with_key(docs), window, gram, bits).select(*columns, STARTS)
    changed = found.mapInArrow(run, found.schema)
    if "n_chars" in columns:
        size = F.when(F.col(STARTS).isNull(), F.col("n_chars")).otherwise(F.length("text"))
        changed = changed.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType))
    return changed.select(*columns)
