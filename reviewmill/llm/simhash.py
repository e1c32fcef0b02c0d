"""SimHash near-duplicates through a popcount embedding and a grid range-join.

A fingerprint is embedded as the bit counts of its ``SEGMENTS`` segments. One
differing bit changes one count by one, so the Manhattan distance of two
embeddings never exceeds the Hamming distance of the fingerprints: it is a lower
bound. The coordinates are dealt to ``BLOCKS`` blocks. Within distance
``d`` at most ``d`` blocks differ, so two near fingerprints share the cell of at
least one choice of ``BLOCKS - d`` blocks. The range join therefore meets in
those cells only; a pair is first held against the Manhattan bound, then its
differing bits are counted.

Equal fingerprints are one point. Inside a cell only links that join two yet
unjoined points are kept (a spanning forest), so a group of n near copies gives
n - 1 links and not n * n. Cells with many points are cut into tiles, each pair
of tiles is one unit of work.

Defined cases: a text without words (null too) has fingerprint zero and is linked
like any other; rows with equal ids get a row each; a null id gets a row and never
names a component unless it has only null ids; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import common, tiles
from reviewmill.llm.components import connected
from reviewmill.llm.keyed import KEY, with_key
from reviewmill.session import materialise

SEGMENTS, BLOCKS, DISTANCE, SEED, SHINGLE = 32, 7, 3, 42, 3
#: Points of a tile of a crowded cell.
TILE = 2048
#: An odd multiplier (the golden ratio in 64 bits).
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _fingerprint(text: bytes, shingle: int) -> int:
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
        return int(hashes[0])
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    stops = ends[shingle - 1 :].tolist()
    for at in range(0, len(starts), 65536):
        hashes = np.array(
            [digest(line[a:b], SEED) for a, b in zip(starts[at : at + 65536], stops[at : at + 65536])], np.uint64
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.flatnonzero(2 * counts > len(starts))
    return sum(1 << int(b) for b in set_bits)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the majority bits of the shingle hashes of each whole text, as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.steps(batches):
            fps = np.array([_fingerprint(x, shingle) for x in common.raw_texts(batch)], np.uint64).view(np.int64)
            yield common.columns_to_batch("doc_id,fp", batch.column("doc_id"), fps)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def _embedding(fp: np.ndarray, segments: int) -> np.ndarray:
    """Bit counts per segment, one row per fingerprint."""
    bits = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.reshape(len(fp), segments, 64 // segments).sum(axis=2, dtype=np.int8)


def cell_keys(
    fp: np.ndarray, segments: int = SEGMENTS, blocks: int = BLOCKS, distance: int = DISTANCE
) -> np.ndarray:
    """The grid cells of each fingerprint: a column per choice of ``blocks - distance`` blocks.

    A cell is named by the counts of the chosen blocks, hashed to 64 bits; two
    cells of one name only bring more pairs to the exact test.
    """
    counts = _embedding(fp, segments).astype(np.uint64)
    borders = [b * segments // blocks for b in range(blocks + 1)]
    base = np.uint64(64 // segments + 1)
    codes = []
    for a, b in zip(borders, borders[1:]):
        code = np.zeros(len(fp), np.uint64)
        for k in range(a, b):
            code = code * base + counts[:, k]
        codes.append(code)
    keys = []
    for k, chosen in enumerate(combinations(range(blocks), blocks - distance)):
        key = np.full(len(fp), k + 1, np.uint64)
        for block in chosen:
            key = (key ^ codes[block]) * _MIX
            key ^= key >> np.uint64(29)
        keys.append(key)
    return np.stack(keys, axis=1)


class _Forest:
    """Union-find over the points of one task step, with all roots in one array."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = int(up[i])
        return i

    def roots(self) -> np.ndarray:
        while True:
            higher = self.up[self.up]
            if np.array_equal(higher, self.up):
                return self.up
            self.up = higher

    def join(self, pairs: np.ndarray) -> np.ndarray:
        """Keeps the pairs that join two trees."""
        kept = []
        for n, (a, b) in enumerate(pairs.tolist()):
            a, b = self.root(a), self.root(b)
            if a != b:
                self.up[max(a, b)] = min(a, b)
                kept.append(n)
        return pairs[kept]


def links_in_runs(
    key: np.ndarray, side: np.ndarray, fp: np.ndarray, distance: int = DISTANCE, segments: int = SEGMENTS
) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the near pairs inside each run of equal keys.

    ``side`` is 0 for the first tile of a unit, 1 for the second; pairs inside
    one side are left to the unit of that tile alone, unless the unit has one
    side only.
    """
    n = len(fp)
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if n else np.array([], int)
    ends = np.r_[starts[1:], n]
    last = np.repeat(ends, ends - starts)
    two = np.repeat(np.maximum.reduceat(side, starts), ends - starts) > 0 if n else np.array([], bool)
    forest, out = _Forest(n), []
    mixed = np.asarray(_embedding(fp, segments)) if n else np.empty((0, segments), np.int8)
    alive, shift = np.arange(n), 1
    while len(alive := alive[alive + shift < last[alive]]):
        other = alive + shift
        # Points that are joined already need no link; in a group of near copies that is nearly every pair.
        wanted = ~two[alive] | (side[alive] != side[other])
        roots = forest.roots()
        wanted &= roots[alive] != roots[other]
        a, b = alive[wanted], other[wanted]
        bound = np.abs(mixed[a] - mixed[b]).sum(axis=1, dtype=np.int16) <= distance
        a, b = a[bound], b[bound]
        near = np.bitwise_count(fp[a] ^ fp[b]) <= distance
        if near.any():
            out.append(forest.join(np.stack([a[near], b[near]], axis=1)))
        shift += 1
    pairs = np.concatenate(out) if out else np.empty((0, 2), int)
    return fp[pairs[:, 0]], fp[pairs[:, 1]]


def near_links(points: DataFrame, distance: int = DISTANCE, tile: int = TILE) -> DataFrame:
    """(a, b): links between different fingerprints that join all fingerprints within ``distance``.

    ``points`` holds each fingerprint once (column ``fp``).
    """
    def cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.asarray(batch.column("fp"))
            keys = cell_keys(fp.view(np.uint64), distance=distance)
            yield common.columns_to_batch("fp,cell", np.repeat(fp, keys.shape[1]), keys.ravel().view(np.int64))

    cells = points.select("fp").mapInArrow(cells_of, "fp long, cell long")
    sizes = cells.groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1")
    # A cell of one point has no pair. Other cells go to tiles; a unit is a tile or two tiles of one cell. The planner
    # sizes the cells like the points, of which each has dozens: without the hint it may broadcast them all.
    tiles = F.ceil(F.col("n") / tile).cast("int")
    own = F.pmod(F.xxhash64("fp"), tiles.cast("long")).cast("int")
    units = (
        cells.join(sizes.hint("merge"), "cell")
        .select("fp", "cell", tiles.alias("tiles"), own.alias("own"))
        .select("fp", "cell", "own", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
        .select(
            "fp",
            F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other")).alias("unit"),
            (F.col("own") > F.col("other")).cast("int").alias("side"),
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in _with_end(batches):
            if batch is not None:
                got = [np.asarray(batch.column(c)) for c in ("unit", "side", "fp")]
                held = got if held is None else [np.concatenate(x) for x in zip(held, got)]
                # The last unit may go on in the next batch.
                cut = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            else:
                if held is None:
                    return
                cut = len(held[0])
            now, held = [x[:cut] for x in held], [x[cut:] for x in held]
            if cut:
                a, b = links_in_runs(now[0], now[1], now[2].view(np.uint64), distance)
                yield common.columns_to_batch("a,b", a.view(np.int64), b.view(np.int64))

    dealt = units.repartition("unit").sortWithinPartitions("unit", "side")
    return dealt.mapInArrow(run, "a long, b long")


def _with_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def components(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id): the smallest id that is reachable over near links."""
    prints = materialise(fingerprints(docs))
    points = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    links = materialise(near_links(points.select("fp")).distinct())
    roots = connected(links)
    named = points.join(roots, points["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = materialise(named.join(ids, "root").select("fp", "component_id"))
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def hex_of(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _majority(hashes: np.ndarray) -> int:
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        counts += np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    return sum(1 << int(b) for b in np.flatnonzero(2 * counts > len(hashes)))


def proposed(sets: DataFrame) -> DataFrame:
    """(a, b): pairs whose fingerprints, taken of the shingle sets (node, grams), are equal or near; they tie all such nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.steps(batches, "grams"):
            fps = [_majority(np.frombuffer(x, np.uint64)) for x in batch.column("grams").to_pylist()]
            yield common.columns_to_batch("node,fp", batch.column("node"), np.array(fps, np.uint64).view(np.int64))

    prints = materialise(sets.select("node", "grams").mapInArrow(run, "node long, fp long"))
    points = materialise(prints.groupBy("fp").agg(F.min("node").alias("least"), F.count("*").alias("n")))
    links = near_links(points.select("fp")).distinct()
    ends = points.select("fp", "least")
    near = links.join(ends.withColumnsRenamed({"fp": "a", "least": "x"}), "a").join(
        ends.withColumnsRenamed({"fp": "b", "least": "y"}), "b"
    ).select(F.col("x").alias("a"), F.col("y").alias("b"))
    equal = prints.join(points.filter("n > 1").select("fp", "least"), "fp").filter("node <> least")
    return near.unionByName(equal.select(F.col("least").alias("a"), F.col("node").alias("b")))


def one_of_each(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` of each component of near copies stays, the one with the smallest doc_id, with all its columns.

    Near copies have a Jaccard similarity of at least ``percent`` over ``shingle``-word shingles. Near
    fingerprints of these sets propose pairs, which are verified on the sets. What fingerprints cannot
    reach (at this similarity they differ in up to a dozen bits) is found by the tiles of ``tiles``, so no link is missed. Texts
    without words are copies of each other. Rows that repeat an id, or have none, are ordered by their
    texts (see ``keyed``); null ids come first.
    """
    keyed = with_key(docs)
    found = materialise(tiles.classes(keyed, shingle, percent, first=proposed))
    empty = found.filter("n = 0").agg(F.min("node")).first()[0]
    gone = F.col("node") != (F.when(F.col("n") == 0, F.lit(empty)).otherwise(F.col("root")))
    copies = materialise(found.filter(gone).select(F.col("node").alias(KEY)))
    return keyed.join(tiles.counted(copies), KEY, "left_anti").select(*docs.columns)
