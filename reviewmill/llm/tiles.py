"""Components of texts whose sets of word n-grams have a high Jaccard similarity, by size-banded tiles.

Two texts link if ``100 * |A & B| >= PERCENT * |A | B|`` for their sets of ``SHINGLE``-word shingles
(64-bit hashes). Nothing below misses a link. Equal sets are one point, named by a 64-bit hash (two of
n different sets share a name with a chance of n^2 / 2^65).

* **Bands and tiles.** A band holds the sizes up to a power of two. All shingles are dealt to a number of parts
  that the band fixes; linked sets of the band differ in at most ``(|A| + |B|) * (100 - PERCENT) / (100 + PERCENT)`` shingles,
  so if a set has more parts than that, one part is the same in both. A tile is what shares (band, part,
  content of the part). Parts of one shingle are left out if the others suffice, so a tile is seldom
  shared for one common passage. Sets near the upper border of a band go to the next one as well. The
  tiles are about 0.4 per shingle; those with a single point go in the first shuffle.
* **Signatures.** In a tile a point is a bitmap, about ``BITS`` bits per shingle: each shingle sets the bit its hash
  names. A bit that only A has stands for a shingle that only A has, so ``|A| - popcount(a & ~b)`` is never
  below the overlap. Pairs whose bound is too low go; the others are settled by intersecting the sorted arrays.

A group of n near copies would give n * n pairs, so links are found in two steps. *Contraction*, ``ROUNDS`` times:
every point goes with its set to one of its tiles (another one each round) if points of
different components meet there; inside a tile only pairs of different components are compared, and a link joins them at
once. A crowded tile is split; some of its points go to all parts and tie them together. *Completion*: all
tiles in which components still meet, by signatures first. Points that are held together by pairs of different
components within the bound make a group, whose sets are then compared as in a tile of the contraction: rows are points of groups
and links that join components, never all pairs of a group.

Defined cases: texts without words (null too) have an empty set and are alone; rows with equal or null ids are
documents of their own (see ``keyed``), a component is named by its least id, null if it has none; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import common, spans
from reviewmill.llm.components import connected
from reviewmill.llm.keyed import KEY, with_key
from reviewmill.session import materialise

SHINGLE, PERCENT = 5, 80
#: Bits of a signature per shingle; it is a power of two between the limits.
BITS, LEAST_BITS, MOST_BITS = 2, 64, 1 << 16
#: Contraction rounds, points of a tile, and points of a crowded tile that go to all its parts.
ROUNDS, TILE, HUBS = 3, 512, 48
#: Bytes of sets that a tile holds at most, on average.
TILE_BYTES = 4 << 20
#: The same for tiles of the completion, which holds sets only where signatures leave pairs open.
GROUP_BYTES = 32 << 20
#: Bits of the bitmap over the rows whose sets are wanted, as a power of two.
FILTER_BITS = 26
#: Tasks that the rows of one point or component may be dealt to.
SLICES = 32
#: A stored table of at most so many short rows is broadcast, a larger one is joined by a shuffle.
BROADCAST_ROWS = 200_000
_SALT = np.uint64(0x632BE59BD9B4E019)
#: Takes sets (node, grams), proposes pairs (a, b).
First = Callable[[DataFrame], DataFrame]


def shingle_sets(texts: list[bytes], shingle: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer words is one shingle."""
    out: list[np.ndarray] = []
    if sum(map(len, texts)) > 2 * common.STEP_BYTES:
        return [_long_set(x, shingle) for x in texts]
    words = spans.split_words([spans.single_spaced(x.lower()) for x in texts])
    hashes = words.hashes()
    found = spans.grams(hashes, shingle)
    for a, b in zip(words.first.tolist(), words.first[1:].tolist()):
        if b - a >= shingle:
            out.append(np.unique(found[a : b - shingle + 1]))
        else:
            # The whole sequence; the number of words keeps it apart from longer shingles.
            out.append(spans.grams(hashes[a:b], b - a) ^ np.uint64(b - a) if b > a else np.empty(0, np.uint64))
    return out


def _long_set(text: bytes, shingle: int) -> np.ndarray:
    """The set of one very long text, from parts that overlap by all but one word of a shingle."""
    parts, at, tail, total = [], 0, b"", 0
    while at < len(text):
        end = at + common.STEP_BYTES
        while end < len(text) and text[end : end + 1].strip():
            end += 1
        words = (tail + b" " + text[at:end]).split()
        total += len(words) - len(tail.split())
        if len(words) >= shingle:
            parts.append(shingle_sets([b" ".join(words)], shingle)[0])
        tail, at = b" ".join(words[1 - shingle :]), end
    return np.unique(np.concatenate(parts)) if total >= shingle else shingle_sets([tail], shingle)[0]


def wide(n: np.ndarray) -> np.ndarray:
    """Bits of the signature of sets of ``n`` shingles."""
    bits = np.clip(BITS * np.asarray(n), LEAST_BITS, MOST_BITS)
    return 1 << np.ceil(np.log2(bits)).astype(np.int64)


def band(n: np.ndarray) -> np.ndarray:
    """Number of the size band: sets of more than 2^(b - 1) and up to 2^b shingles."""
    return np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64)


def _differ(both: np.ndarray, percent: int) -> np.ndarray:
    """How many shingles linked sets of ``both`` shingles together may differ in."""
    return both * (100 - percent) // (100 + percent)


def tiles_of(sets: list[np.ndarray], percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(position of the set, tile) of all tiles of non-empty sets."""
    size = np.array([len(x) for x in sets], np.int64)
    own = band(size)
    upper = np.flatnonzero(size * 100 // percent > 1 << own)
    which, bands = np.r_[np.arange(len(sets)), upper], np.r_[own, own[upper] + 1]
    limit = np.int64(1) << bands
    parts = np.maximum(-(-limit * 9 * (100 - percent) // (4 * (100 + percent))), 1)
    size = size[which]
    # The partner is in the band, and no larger than a link allows.
    apart = _differ(size + np.minimum(limit, size * 100 // percent), percent)
    every = np.concatenate([sets[k] for k in which.tolist()])
    owner = np.repeat(np.arange(len(which)), size)
    # Sets are sorted, so the shingles of a part stand together.
    part = ((every >> np.uint64(32)) * parts[owner].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, (np.diff(part) != 0) | (np.diff(owner) != 0)])
    count, owner, part = np.diff(np.r_[first, len(every)]), owner[first], part[first]
    content = np.add.reduceat(spans.mix(every ^ _SALT), first)
    large = np.bincount(owner, count > 1, len(which)) > apart
    some = np.bincount(owner, minlength=len(which)) > apart
    keep = (count > 1) | ~large[owner]
    owner, part, content = owner[keep], part[keep], content[keep]
    # Sets with too few parts that hold anything: the empty ones may be what is the same.
    for k in np.flatnonzero(~some).tolist():
        gone = np.setdiff1d(np.arange(parts[k]), part[owner == k])
        owner, part = np.r_[owner, np.full(len(gone), k)], np.r_[part, gone]
        content = np.r_[content, np.zeros(len(gone), np.uint64)]
    tile = spans.mix(content + spans.mix(part.astype(np.uint64) * _SALT + bands[owner].astype(np.uint64)))
    return which[owner], tile


def signature(values: np.ndarray, bits: int) -> np.ndarray:
    """A bitmap of ``bits`` bits as 64-bit words; a narrower one is the upper half folded on the lower."""
    places = np.unique(spans.mix(values) & np.uint64(bits - 1)).astype(np.int64)
    out = np.zeros(bits // 64, np.uint64)
    np.bitwise_or.at(out, places >> 6, np.uint64(1) << (places & 63).astype(np.uint64))
    return out


def folded(words: np.ndarray, bits: int) -> np.ndarray:
    while len(words) * 64 > bits:
        words = words[: len(words) // 2] | words[len(words) // 2 :]
    return words


def enough(shared, a, b, percent: int = PERCENT):
    """100 * intersection >= percent * union, in whole numbers."""
    return (100 + percent) * shared >= percent * (a + b)


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    return bool(enough(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b), percent))


def open_pairs(size: np.ndarray, bitmaps: np.ndarray, i: int, others: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Which of ``others`` may be linked with point i, by size and by the bits that only one of both has."""
    n, m = size[i], size[others]
    left = others[enough(np.minimum(n, m), n, m, percent)]
    if not len(left):
        return left
    mine, theirs, m = bitmaps[i], bitmaps[left], size[left]
    bound = np.minimum(
        n - np.bitwise_count(mine & ~theirs).sum(axis=1, dtype=np.int64),
        m - np.bitwise_count(theirs & ~mine).sum(axis=1, dtype=np.int64),
    )
    return left[enough(bound, n, m, percent)]


def _stacked(sets_or_maps: list[np.ndarray], size: np.ndarray, made: bool = False) -> np.ndarray:
    """Signatures of one width for the points of a tile."""
    bits = int(wide(size.max()))
    if made:
        bits = min(bits, *(len(x) * 64 for x in sets_or_maps))
        return np.stack([folded(x, bits) for x in sets_or_maps])
    return np.stack([signature(x, bits) for x in sets_or_maps])


def counted(short: DataFrame) -> DataFrame:
    """A stored table of short rows, marked for broadcast if its counted size allows, else for a shuffle.

    Left alone the planner would take a file of short, well-packed rows for a small table and send it through the driver.
    """
    return F.broadcast(short) if short.count() <= BROADCAST_ROWS else short.hint("merge")


def name_of(x: np.ndarray) -> int:
    """A set's 64-bit name, as a signed number."""
    return int.from_bytes(xxhash.xxh64_digest(x.tobytes(), 42), "little", signed=True)


def prints(keyed: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(node, n, point) of each row: its key, the size of its set and its name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.steps(batches):
            sets = shingle_sets(common.raw_texts(batch), shingle)
            yield common.columns_to_batch(
                "node,n,point", batch.column("node"), np.array([len(x) for x in sets], np.int32),
                np.array([name_of(x) for x in sets], np.int64),
            )

    return keyed.select(F.col(KEY).alias("node"), "text").mapInArrow(run, "node long, n int, point long")


def shared_tiles(keyed: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(cell, point): the tiles that hold more than one point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # a task sends the tiles of equal sets once
        for batch in common.steps(batches):
            sets, names = [], []
            for x in shingle_sets(common.raw_texts(batch), shingle):
                if len(x) and (name := name_of(x)) not in seen:
                    seen.add(name)
                    sets.append(x)
                    names.append(name)
            if sets:
                which, tile = tiles_of(sets, percent)
                yield common.columns_to_batch("cell,point", tile.view(np.int64), np.array(names, np.int64)[which])

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = point = np.empty(0, np.int64)
        for batch in _or_end(batches):
            if batch is not None:
                cell = np.r_[cell, np.asarray(batch.column("cell"))]
                point = np.r_[point, np.asarray(batch.column("point"))]
                # The last tile may go on in the next batch.
                cut = int(np.searchsorted(cell, cell[-1])) if len(cell) else 0
            else:
                cut = len(cell)
            a, b = cell[:cut], point[:cut]
            cell, point = cell[cut:], point[cut:]
            if len(a):
                fresh = np.flatnonzero(np.r_[True, (np.diff(a) != 0) | (np.diff(b) != 0)])
                a, b = a[fresh], b[fresh]
                same = np.r_[False, np.diff(a) == 0]
                keep = same | np.r_[same[1:], False]
                yield common.columns_to_batch("cell,point", a[keep], b[keep])

    rows = keyed.select("text").mapInArrow(run, "cell long, point long")
    return rows.repartition("cell").sortWithinPartitions("cell", "point").mapInArrow(several, "cell long, point long")


def _or_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def sets_of(keyed: DataFrame, wanted: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(node, grams): the sets of the rows of ``wanted`` (node), as sorted 64-bit numbers.

    A bitmap of fixed size spares the join the rows that nobody asked for.
    """
    spot = F.pmod(F.xxhash64("node"), F.lit(1 << FILTER_BITS))
    places = wanted.select(spot.alias("p")).groupBy(F.shiftright("p", 5).alias("slot")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p & 31 as int))")).alias("bits")
    )
    out = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    # At most one row per word of the bitmap, whatever the number of rows.
    for row in places.toLocalIterator():
        out[row["slot"]] = row["bits"]
    holder = keyed.sparkSession.sparkContext.broadcast(out.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(holder.value, np.uint32)
        for batch in common.steps(batches):
            place = np.asarray(batch.column("place"))
            batch = batch.take(pa.array(np.flatnonzero(bits[place >> 5] >> (place & 31).astype(np.uint32) & 1)))
            if batch.num_rows:
                sets = shingle_sets(common.raw_texts(batch), shingle)
                yield common.columns_to_batch(
                    "node,grams", batch.column("node"), pa.array([x.tobytes() for x in sets], pa.binary())
                )

    texts = keyed.select(F.col(KEY).alias("node"), "text").withColumn("place", spot)
    return texts.mapInArrow(run, "node long, grams binary").join(wanted.select("node"), "node", "left_semi")


class Trees:
    """Labels of the points of a tile; a link joins two of them."""

    def __init__(self, label: np.ndarray):
        _, self.tree = np.unique(label, return_inverse=True)

    def join(self, i: int, j: int) -> None:
        self.tree[self.tree == self.tree[j]] = self.tree[i]


def links_in_tile(label: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that join all components of a tile that have a link between them."""
    size = np.array([len(x) for x in sets], np.int64)
    # Sizes in order: the first that is too large ends the search.
    order = np.argsort(size, kind="stable")
    size, sets = size[order], [sets[k] for k in order]
    trees, bitmaps, out = Trees(label[order]), _stacked(sets, size), []
    ends = np.searchsorted(size, size * 100 // percent, "right")
    for i in range(len(sets)):
        others = np.arange(i + 1, ends[i])
        others = others[trees.tree[others] != trees.tree[i]]
        for j in open_pairs(size, bitmaps, i, others, percent).tolist() if len(others) else ():
            if trees.tree[i] != trees.tree[j] and linked(sets[i], sets[j], percent):
                trees.join(i, j)
                out.append((int(order[i]), int(order[j])))
    return out


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[tuple]]:
    """Rows of one unit (first name) after the other, from sorted batches."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in names)):
            if held and row[0] != held[0][0]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _pairs(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    found = np.array(rows, np.int64).reshape(-1, 2)
    return common.columns_to_batch("a,b", found[:, 0], found[:, 1])


def _in_tiles(units: DataFrame, percent: int) -> DataFrame:
    """(a, b): links found in tiles; ``units`` (unit, node, label, grams)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, ["unit", "node", "label", "grams"]):
            _, node, label, grams = zip(*rows)
            sets = [np.frombuffer(x, np.uint64) for x in grams]
            yield _pairs([(node[i], node[j]) for i, j in links_in_tile(np.array(label), sets, percent)])

    return units.repartition("unit").sortWithinPartitions("unit", "node").mapInArrow(run, "a long, b long")


def contract(live: DataFrame, sets: DataFrame, labels: DataFrame, turn: int, percent: int = PERCENT, tile: int = TILE) -> DataFrame:
    """(a, b): links between components that meet in one tile of each point.

    ``live`` (cell, node), ``sets`` (node, grams), ``labels`` (node, label).
    """
    chosen = live.groupBy("node").agg(F.min(F.struct(F.xxhash64("cell", F.lit(turn)), "cell")).alias("c"))
    placed = chosen.select("node", "c.cell").join(labels, "node").join(
        sets.select("node", F.octet_length("grams").alias("bytes")), "node"
    )
    crowds = placed.groupBy("cell").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("held"),
        F.greatest(F.ceil(F.count("*") / tile), F.ceil(F.sum("bytes") / TILE_BYTES)).cast("int").alias("tiles"),
    ).filter("lo <> hi").select("cell", "held", "tiles")
    spot = F.xxhash64("node", F.lit(turn + 1000))
    # Of a crowded tile about HUBS points go to every part.
    parts = F.when(
        (F.col("tiles") > 1) & (F.pmod(spot, F.greatest(F.col("held") / HUBS, F.lit(1)).cast("long")) == 0),
        F.sequence(F.lit(0), F.col("tiles") - 1),
    ).otherwise(F.array(F.pmod(F.xxhash64("node", F.lit(turn + 2000)), F.col("tiles").cast("long")).cast("int")))
    dealt = materialise(placed.join(crowds, "cell").select("node", "label", "cell", F.explode(parts).alias("part")))
    units = sets.join(counted(dealt), "node").select(F.xxhash64("cell", "part").alias("unit"), "node", "label", "grams")
    return _in_tiles(units, percent)


def _signatures(sets: DataFrame, percent: int) -> DataFrame:
    """(node, n, bits): size and signature of each point, wide enough for the largest partner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.steps(batches, "grams"):
            rows = [np.frombuffer(x, np.uint64) for x in batch.column("grams").to_pylist()]
            size = np.array([len(x) for x in rows])
            maps = [signature(x, int(w)).tobytes() for x, w in zip(rows, wide(size * 100 / percent + 1).tolist())]
            yield common.columns_to_batch("node,n,bits", batch.column("node"), size.astype(np.int32), pa.array(maps, pa.binary()))

    return sets.mapInArrow(run, "node long, n int, bits binary")


def candidates(live: DataFrame, sets: DataFrame, labels: DataFrame, percent: int = PERCENT, tile: int = TILE) -> DataFrame:
    """(unit, node, label): groups of points of one tile that pairs which pass the bounds hold together.

    A group has a row per point and not per pair; equal groups of several tiles are one unit.
    """
    sizes = sets.select("node", F.octet_length("grams").alias("bytes"))
    cells = live.join(labels, "node").join(sizes, "node")
    # Tiles where components meet, and how far they have to be split.
    crowds = cells.groupBy("cell").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"),
        F.greatest(F.ceil(F.count("*") / tile), F.ceil(F.sum("bytes") / GROUP_BYTES)).cast("int").alias("tiles"),
    ).filter("lo <> hi").select("cell", "tiles")
    own = F.pmod(F.xxhash64("node"), F.col("tiles").cast("long")).cast("int")
    dealt = cells.join(crowds, "cell").select("node", "label", "cell", "tiles", own.alias("own")).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    )
    units = materialise(dealt.select(
        F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other")).alias("unit"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "node", "label",
    ))
    signs = _signatures(sets.join(counted(materialise(units.select("node").distinct())), "node", "left_semi"), percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, ["unit", "side", "node", "label", "n", "bits"]):
            for node, label in open_groups(*zip(*[r[1:] for r in rows]), percent):
                unit = np.full(len(node), name_of(node))
                yield common.columns_to_batch("unit,node,label", unit, node, label)

    dealt = units.join(signs, "node").repartition("unit").sortWithinPartitions("unit", "side", "node")
    return dealt.mapInArrow(run, "unit long, node long, label long").distinct()


def open_groups(side, node, label, size, bits, percent: int = PERCENT) -> list[tuple[np.ndarray, np.ndarray]]:
    """(nodes, labels) of each component of the pairs of different labels that pass the bounds; with two sides, pairs across them only."""
    order = sorted(range(len(node)), key=lambda k: (size[k], node[k]))
    side, node, label, size = (np.array([x[k] for k in order], np.int64) for x in (side, node, label, size))
    maps = [np.frombuffer(bits[k], np.uint64) for k in order]
    bitmaps, two, trees = _stacked(maps, size, made=True), bool(side.max()), Trees(np.arange(len(node)))
    ends = np.searchsorted(size, size * 100 // percent, "right")
    for i in range(len(node)):
        others = np.arange(i + 1, ends[i])
        # Points that hang together already belong to one group anyway.
        others = others[(label[others] != label[i]) & (trees.tree[others] != trees.tree[i])]
        if two:
            others = others[side[others] != side[i]]
        for j in open_pairs(size, bitmaps, i, others, percent).tolist() if len(others) else ():
            trees.join(i, j)
    held = np.argsort(trees.tree, kind="stable")
    parts = np.split(held, np.flatnonzero(np.diff(trees.tree[held])) + 1)
    parts = [x[np.argsort(node[x])] for x in parts if len(x) > 1]
    return [(node[x], label[x]) for x in parts]


def verified(sets: DataFrame, pairs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs whose sorted sets share enough."""
    both = sets.withColumnsRenamed({"node": "a", "grams": "x"}).join(counted(pairs), "a").join(
        sets.withColumnsRenamed({"node": "b", "grams": "y"}), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("a", "b", "x", "y")))
            yield _pairs([
                (a, b) for a, b, x, y in rows
                if linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
            ])

    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def roots(
    live: DataFrame, sets: DataFrame, percent: int = PERCENT, tile: int = TILE, rounds: int = ROUNDS, first: First | None = None
) -> DataFrame:
    """(node, root) of the points that are linked with another one; ``first`` proposes pairs before all tiles."""
    links, found = None, None
    labels = sets.select("node", F.col("node").alias("label"))
    for turn in range(-1 if first else 0, rounds):
        if turn < 0:
            fresh = materialise(verified(sets, materialise(first(sets)), percent))
        else:
            fresh = materialise(contract(live, sets, labels, turn, percent, tile))
        links = fresh if links is None else links.unionByName(fresh)
        if not fresh.limit(1).count():
            continue
        found = materialise(connected(links))
        labels = materialise(sets.select("node").join(found, "node", "left").select(
            "node", F.coalesce("root", "node").alias("label")
        ))
    groups = counted(materialise(candidates(live, sets, labels, percent, tile)))
    fresh = materialise(_in_tiles(sets.join(groups, "node"), percent))
    if found is not None and not fresh.limit(1).count():
        return found
    return connected(fresh if links is None else links.unionByName(fresh))


def classes(
    keyed: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, tile: int = TILE, rounds: int = ROUNDS,
    first: First | None = None,
) -> DataFrame:
    """(node, n, root) of every row: root is the least key of its component."""
    rows = materialise(prints(keyed, shingle)).withColumn("slice", F.pmod(F.xxhash64("node"), F.lit(SLICES)))
    # Equal sets are one point; its first row stands for it.
    points = materialise(rows.filter("n > 0").groupBy("point").agg(
        F.min("node").alias("node"), F.count("*").alias("copies"), F.collect_set("slice").alias("slices")
    ))
    shared = materialise(shared_tiles(keyed, shingle, percent))
    live = materialise(shared.join(points.select("point", "node"), "point").select("cell", "node"))
    sets = materialise(sets_of(keyed, live.select("node").distinct(), shingle))
    joined = roots(live, sets, percent, tile, rounds, first)
    named = points.join(joined, "node", "left").filter("copies > 1 or root is not null").select(
        "point", F.coalesce("root", "node").alias("root"), F.explode("slices").alias("slice")
    )
    # An empty set is the name of no point.
    return rows.join(counted(materialise(named)), ["point", "slice"], "left").select(
        "node", "n", F.coalesce("root", "node").alias("root")
    )


def components(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, tile: int = TILE, rounds: int = ROUNDS
) -> DataFrame:
    """(key, doc_id, n_shingles, component_id) of every row."""
    keyed = with_key(docs)
    found = materialise(classes(keyed, shingle, percent, tile, rounds))
    named = materialise(found.join(
        keyed.select(F.col(KEY).alias("node"), F.col("doc_id").cast("long").alias("doc_id")), "node"
    )).withColumn("slice", F.pmod(F.xxhash64("node"), F.lit(SLICES)))
    ids = named.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.collect_set("slice").alias("slices"))
    return named.join(ids.select("root", "component_id", F.explode("slices").alias("slice")), ["root", "slice"]).select(
        F.col("node").alias("key"), "doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id"
    )
