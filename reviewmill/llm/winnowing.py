"""Benchmark decontamination by winnowing.

A fingerprint is the least of the ``GRAM``-word hashes in a window of ``WINDOW`` words. If
a document and an item share a window, they share its fingerprint: no shared span
of ``WINDOW`` words is lost, though only a part of all k-grams is kept. Training and
benchmark fingerprints are joined, and each hit is extended to the
whole windows around it, word by word. An item of fewer words (but not none) is
one window of its own length; its k-gram is the item itself, and documents are looked
through for all runs of that length.

A bitmap of fixed size over the item fingerprints spares the join the many
fingerprints that no item has. It can only let too much through.

Defined cases: null and empty texts have no words, an item without words has
no window; a document with a null or repeated id is a row of its own; of
items with equal ids each row counts, the id is listed once; items with null ids
hit words but are not listed; empty tables give no rows, or rows without hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import common, spans
from reviewmill.llm.keyed import KEY, with_key
from reviewmill.session import materialise

WINDOW, GRAM = 10, 5
#: Bits of the bitmap over item fingerprints, as a power of two.
FILTER_BITS = 26


def _benchmark_words(batch: pa.RecordBatch) -> spans.Words:
    texts = common.raw_texts(batch)
    return spans.split_words([spans.single_spaced(x.translate(spans.WORD_BYTES)) for x in texts])


def _short_fingerprints(hashes: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and fingerprints of all runs of ``size`` words inside one text."""
    prints = spans.mix(spans.grams(hashes, size) + np.uint64(size))
    at = np.flatnonzero(text[: len(prints)] == text[size - 1 :]) if len(prints) else np.array([], np.int64)
    return at, prints[at]


def _rows(words: spans.Words, at: np.ndarray, size: np.ndarray, prints: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
    """Windows as rows: fingerprint, owner, place in its text, words."""
    stop = words.end[at + size - 1]
    content = [words.data[a:b] for a, b in zip(words.start[at].tolist(), stop.tolist())]
    text = words.text[at]
    return common.columns_to_batch(
        "print,owner,at,size,words", prints.view(np.int64), key[text], (at - words.first[text]).astype(np.int32),
        size.astype(np.int32), pa.array(content, pa.binary()),
    )


_SCHEMA = "print long, owner long, at int, size int, words binary"


def _windows_of(runs: spans.Runs) -> tuple[np.ndarray, np.ndarray]:
    """Window places and fingerprints of runs."""
    offset = np.arange(int(runs.count.sum())) - np.repeat(np.cumsum(runs.count) - runs.count, runs.count)
    return np.repeat(runs.window, runs.count) + offset, np.repeat(runs.gram, runs.count)


def item_windows(items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """All windows of the items: fingerprint, owner (a number for each distinct item), words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.steps(batches):
            words, key = _benchmark_words(batch), np.asarray(batch.column("owner"))
            hashes = words.hashes()
            at, prints = _windows_of(spans.anchored_runs(hashes, words.text, window, gram))
            yield _rows(words, at, np.full(len(at), window), prints, key)
            counts = np.diff(words.first)
            for size in np.unique(counts[(counts > 0) & (counts < window)]).tolist():
                at, prints = _short_fingerprints(hashes, words.text, size)
                whole = counts[words.text[at]] == size
                yield _rows(words, at[whole], np.full(whole.sum(), size), prints[whole], key)

    return items.select("owner", "text").mapInArrow(run, _SCHEMA)


def _bit_places(prints: np.ndarray) -> np.ndarray:
    return (spans.mix(prints.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - FILTER_BITS)).astype(
        np.int64
    )


def _bitmap(prints: DataFrame) -> bytes:
    """A bitmap of fixed size over the fingerprints, put together from bitmap words."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _bit_places(np.asarray(batch.column("print")))
            yield common.columns_to_batch("slot,bits", at >> 5, np.int64(1) << (at & 31))

    words = prints.mapInArrow(places, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    out = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    # At most one row per bitmap word, whatever the number of items.
    for row in words.toLocalIterator():
        out[row["slot"]] = row["bits"]
    return out.tobytes()


def document_windows(
    docs: DataFrame, bitmap: bytes, short: list[int], window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """Windows of keyed documents whose fingerprint may be an item's; and one row per document (``print`` null, its
    number of words in ``at``)."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint32)

        def known(prints: np.ndarray) -> np.ndarray:
            at = _bit_places(prints)
            return (bits[at >> 5] >> (at & 31).astype(np.uint32)) & 1 > 0

        for batch in common.steps(batches):
            words, key = _benchmark_words(batch), np.asarray(batch.column(KEY))
            counts = np.diff(words.first)
            yield common.columns_to_batch(
                "print,owner,at,size,words", pa.nulls(len(key), pa.int64()), key, counts.astype(np.int32),
                pa.nulls(len(key), pa.int32()), pa.nulls(len(key), pa.binary()),
            )
            hashes = words.hashes()
            runs = spans.anchored_runs(hashes, words.text, window, gram)
            wanted = known(runs.gram)
            runs = spans.Runs(*(x[wanted] for x in (runs.window, runs.count, runs.anchor, runs.gram)))
            at, prints = _windows_of(runs)
            if len(at):
                yield _rows(words, at, np.full(len(at), window), prints, key)
            for size in short:
                at, prints = _short_fingerprints(hashes, words.text, size)
                wanted = known(prints)
                if wanted.any():
                    yield _rows(words, at[wanted], np.full(wanted.sum(), size), prints[wanted], key)

    return docs.select(KEY, "text").mapInArrow(run, _SCHEMA)


def find_hits(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sizes (key, n_words), hits (key, at, size, owner) and members (owner, item_id) for keyed ``docs``."""
    # Items of one text are one owner, so copies of an item do not multiply the hits.
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    distinct = items.groupBy("text").agg(F.count("*").alias("n")).select("text")
    named = materialise(distinct.withColumn("owner", F.monotonically_increasing_id()))
    members = materialise(items.join(named, "text").filter("item_id is not null").select("owner", "item_id").distinct())
    rows = materialise(item_windows(named, window, gram))
    bitmap = _bitmap(rows.select("print"))
    short = [r["size"] for r in rows.filter(F.col("size") < window).select("size").distinct().collect()]
    found = materialise(document_windows(docs, bitmap, sorted(short), window, gram))
    sizes = found.filter("print is null").select(F.col("owner").alias("key"), F.col("at").alias("n_words"))
    # The join meets on the fingerprint; the hit is then extended over the words of the window.
    theirs = rows.select("print", "owner", "words").distinct()
    mine = found.filter("print is not null").select("print", F.col("owner").alias("key"), "at", "size", "words")
    hits = mine.join(theirs, ["print", "words"]).select("key", "at", "size", "owner")
    return sizes, hits, members


def _covered_words(spans_column: F.Column) -> F.Column:
    """How many words lie in any of the sorted (at, size) spans."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach"))

    def add(state, span):
        stop = span["at"] + span["size"]
        fresh = F.greatest(F.lit(0), stop - F.greatest(state["reach"], span["at"]))
        return F.struct((state["n"] + fresh).alias("n"), F.greatest(state["reach"], stop).alias("reach"))

    return F.aggregate(spans_column, start, add, lambda s: s["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_hit, items, contaminated) for every row of ``docs``; ``items`` are ids as sorted strings."""
    keyed = with_key(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    sizes, hits, members = find_hits(keyed, benchmark, window, gram)
    hits = materialise(hits)
    words = hits.select("key", "at", "size").distinct().groupBy("key").agg(
        _covered_words(F.sort_array(F.collect_list(F.struct("at", "size")))).alias("n_hit")
    )
    items = hits.select("key", "owner").distinct().join(members, "owner").groupBy("key").agg(
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items")
    )
    ids = keyed.select(F.col(KEY).alias("key"), "doc_id")
    joined = sizes.join(ids, "key").join(words, "key", "left").join(items, "key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The rows of ``docs`` that share no window with the benchmark, with all their columns."""
    keyed = with_key(docs)
    _, hits, _ = find_hits(keyed, benchmark, window, gram)
    keys = materialise(hits.select(F.col("key").alias(KEY)).distinct())
    return keyed.join(keys, KEY, "left_anti").select(*docs.columns)
