"""Ranked lexical search over a length-stratified index.

A document's normaliser m follows from its number of terms alone, and what a term adds to a score is
its weight times an impact that follows from (tf, m). So documents of equal m form a stratum, the
postings of a term in it are grouped by tf, and an impact is computed once per tf of a stratum. The
greatest tf of every term bounds what a stratum can score for a query. Strata are visited from the
highest bound down; a query leaves out those whose bound is below its current k-th best score.

Spark does it in these steps:

* ``build``: one row per document with its number of terms and its postings, as hashes. Only terms that may
  be asked for are kept (a bitmap of fixed size over the query terms); counts and sums over all documents
  give N, L and, per query term, df.
* ``search``: the index is range-partitioned by (m, key), so a stratum with very many documents is cut.
  A task takes its documents in portions of about ``POSTINGS`` postings, a portion is a few strata. Queries
  come in blocks of at most ``QUERIES`` items and about ``PAIRS`` terms, one pass over the index per block.
  The portion with the least hashes is searched first; its k-th scores are lower bounds that all tasks start from.
* Tasks give at most k rows per query, which are ranked once more.

Terms are held as 64-bit hashes; two terms of one hash would be taken for one (for a million query
terms and a billion others the chance is below 1e-4).

Defined cases: null and empty texts have no terms, neither count in N nor are found; items without terms find
nothing; items that share an id are one query with the terms of all; documents with equal or null
ids are documents of their own, null ids first among equal scores (see ``keyed``); empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm import common, spans
from reviewmill.llm.keyed import KEY, with_key
from reviewmill.session import materialise

TOP = 10
#: Bits of the bitmap over query terms, as a power of two.
FILTER_BITS = 20
#: Items and (item, term) pairs of a block of queries; postings of a portion of documents.
QUERIES, PAIRS, POSTINGS = 256, 1 << 16, 1 << 18
#: Cells of a dense matrix of impacts.
_CELLS = 1 << 21


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text with spaces between its terms, cut into parts of about a step's size."""
    text, at = text.translate(spans.WORD_BYTES), 0
    while at < len(text) or not at:
        end = text.find(b" ", at + common.STEP_BYTES)
        end = max(len(text), 1) if end < 0 else end
        yield spans.single_spaced(text[at:end])
        at = end


def _terms(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, term hash) of all words, a very long text in several parts."""
    parts = [(row, part) for row, text in enumerate(common.raw_texts(batch)) for part in _pieces(text)]
    ends = np.cumsum([len(part) for _, part in parts])
    cuts = [0, *(np.flatnonzero(np.diff(ends // (2 * common.STEP_BYTES))) + 1).tolist(), len(parts)]
    for a, b in zip(cuts, cuts[1:]):
        words = spans.split_words([part for _, part in parts[a:b]])
        yield np.array([row for row, _ in parts[a:b]], np.int64)[words.text], words.hashes()


def query_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): the terms of each item, once each, as hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.steps(batches):
            for row, term in _terms(batch):
                yield common.columns_to_batch(
                    "item_id,term", batch.column("item_id").take(pa.array(row)), term.view(np.int64)
                )

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", "text").mapInArrow(run, f"item_id {kind}, term long").distinct()


def _bit(terms: np.ndarray) -> np.ndarray:
    return (terms.view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _bitmap(terms: DataFrame) -> np.ndarray:
    """A bitmap of fixed size over the query terms, put together from its 64-bit words."""
    slot = F.shiftrightunsigned("term", 64 - FILTER_BITS)
    words = terms.groupBy(F.shiftright(slot, 5).alias("slot")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(shiftrightunsigned(term, %d) & 31 as int))" % (64 - FILTER_BITS))).alias("bits")
    )
    out = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    for row in words.toLocalIterator():
        out[row["slot"]] = row["bits"]
    return out


@dataclass
class Index:
    """``rows``: (key, doc_id, m, terms, tfs) per document with terms; ``weights``: (term, w) of the query terms."""

    rows: DataFrame
    weights: DataFrame
    queries: DataFrame
    documents: int
    postings: int


def _postings(keyed: DataFrame, bitmap: np.ndarray) -> DataFrame:
    held = bitmap.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.frombuffer(held, np.uint32)
        for batch in common.steps(batches):
            n, kept = np.zeros(batch.num_rows, np.int64), []
            for row, hashes in _terms(batch):
                n += np.bincount(row, minlength=len(n))
                bit = _bit(hashes)
                keep = np.flatnonzero(wanted[bit >> 5] >> (bit & 31).astype(np.uint32) & 1)
                kept.append((row[keep], hashes[keep].view(np.int64)))
            text, term = (np.concatenate(x) for x in zip(*kept))
            order = np.lexsort((term, text))
            text, term = text[order], term[order]
            first = np.flatnonzero(np.r_[True, (np.diff(text) != 0) | (np.diff(term) != 0)][: len(text)])
            tf = np.diff(np.r_[first, len(text)])
            bounds = pa.array(np.searchsorted(text[first], np.arange(batch.num_rows + 1)), pa.int32())
            yield common.columns_to_batch(
                "key,doc_id,n,terms,tfs", batch.column(KEY), batch.column("doc_id"),
                n,
                pa.ListArray.from_arrays(bounds, pa.array(term[first])),
                pa.ListArray.from_arrays(bounds, pa.array(tf.astype(np.int32))),
            )

    shape = "key long, doc_id long, n long, terms array<long>, tfs array<int>"
    return keyed.select(KEY, F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, shape)


def normaliser(n: Column, documents: int, terms: int) -> Column:
    """100 - 90 + (90 n N div L), in decimals, as 90 n N may pass 64 bits."""
    grown = n.cast("decimal(20,0)") * F.lit(90 * documents).cast("decimal(18,0)")
    return F.lit(10).cast("long") + F.floor(grown / F.lit(max(terms, 1)).cast("decimal(20,0)")).cast("long")


def build(docs: DataFrame, items: DataFrame) -> Index:
    """The index of ``docs`` for the terms of ``items``."""
    queries = materialise(query_terms(items))
    found = materialise(_postings(with_key(docs), _bitmap(queries)).filter("n > 0"))
    total = found.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    counts = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    asked = queries.select("term").distinct().join(counts, "term")
    w = F.floor(1000 * F.log(F.lit(float(2 * total["n"] + 2)) / (2 * F.col("df") + 1))).cast("long")
    weights = materialise(asked.select("term", w.alias("w"), "df"))
    postings = weights.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    rows = found.filter(F.size("terms") > 0).select(
        "key", "doc_id", normaliser(F.col("n"), total["n"], total["l"]).alias("m"), "terms", "tfs"
    )
    return Index(rows, weights, queries, total["n"], postings)


@dataclass
class Block:
    """A block of queries: weights of ``terms`` (sorted hashes) in a row per term and a column per query."""

    names: list[int]
    terms: np.ndarray
    weights: np.ndarray


class Best:
    """The k best documents of each query so far; equal scores go by key."""

    def __init__(self, k: int, floors: np.ndarray):
        self.k, self.floors = k, floors.copy()
        self.rows: list[list[tuple[int, int, int | None]]] = [[] for _ in floors]

    def add(self, query: int, scores: np.ndarray, keys: np.ndarray, ids: list) -> None:
        fresh = [(-int(s), int(key), doc) for s, key, doc in zip(scores, keys, ids)]
        rows = sorted(self.rows[query] + fresh, key=lambda r: r[:2])[: self.k]
        self.rows[query] = rows
        if len(rows) == self.k:
            self.floors[query] = max(self.floors[query], -rows[-1][0])


class Portion:
    """Some documents of the index, in strata of equal m, their postings by tf."""

    def __init__(self, block: Block, m: np.ndarray, size: np.ndarray, terms: np.ndarray, tfs: np.ndarray):
        doc = np.repeat(np.arange(len(m)), size)
        column = np.searchsorted(block.terms, terms)
        column[column == len(block.terms)] = 0
        known = block.terms[column] == terms
        doc, column, tf = doc[known], column[known], tfs[known].astype(np.int64)
        order = np.argsort(m, kind="stable")
        self.docs = order
        self.norms, begins = np.unique(m[order], return_index=True)
        self.bounds = np.r_[begins, len(m)]
        place = np.empty(len(m), np.int64)
        place[order] = np.arange(len(m))
        at = place[doc]
        stratum = np.searchsorted(self.bounds, at, "right") - 1
        # Postings of a stratum by term, then tf.
        order = np.lexsort((at, tf, column, stratum))
        self.at, self.column, self.tf, self.stratum = at[order], column[order], tf[order], stratum[order]
        self.cuts = np.searchsorted(self.stratum, np.arange(len(self.norms) + 1))
        # One impact per (stratum, tf).
        pairs, self.of = np.unique(np.stack([self.stratum, self.tf], axis=1), axis=0, return_inverse=True)
        self.impact = impact(pairs[:, 1], self.norms[pairs[:, 0]]) if len(pairs) else np.empty(0, np.int64)
        self.of = self.of.ravel()

    def highest(self, block: Block, some: slice) -> np.ndarray:
        """What a document of each stratum can score at most for each query."""
        lo, hi = self.cuts[some.start], self.cuts[some.stop]
        top = np.zeros((some.stop - some.start, len(block.terms)), block.weights.dtype)
        # Ascending tf within (stratum, term): the last one written is the greatest.
        top[self.stratum[lo:hi] - some.start, self.column[lo:hi]] = self.impact[self.of[lo:hi]]
        return top @ block.weights

    def visit(self, block: Block, s: int, queries: np.ndarray, best: Best, keys: np.ndarray, ids: np.ndarray) -> None:
        """Scores the documents of a stratum for some queries."""
        lo, hi = self.cuts[s], self.cuts[s + 1]
        columns, where = np.unique(self.column[lo:hi], return_inverse=True)
        weights = block.weights[np.ix_(columns, queries)]
        step = max(1, _CELLS // max(len(columns), 1))
        for a in range(int(self.bounds[s]), int(self.bounds[s + 1]), step):
            b = min(a + step, int(self.bounds[s + 1]))
            here = np.flatnonzero((self.at[lo:hi] >= a) & (self.at[lo:hi] < b))
            cells = np.zeros((b - a, len(columns)), block.weights.dtype)
            cells[self.at[lo:hi][here] - a, where[here]] = self.impact[self.of[lo:hi][here]]
            scores = cells @ weights
            reach = np.flatnonzero(scores.max(axis=0) >= np.maximum(best.floors[queries], 1))
            for q in reach.tolist():
                query = int(queries[q])
                rows = np.flatnonzero(scores[:, q] >= max(best.floors[query], 1))
                docs = self.docs[a + rows]
                # All but the k best of this part cannot be among the k best.
                if len(rows) > best.k:
                    some = np.lexsort((keys[docs], -scores[rows, q]))[: best.k]
                    rows, docs = rows[some], docs[some]
                best.add(query, scores[rows, q], keys[docs], ids[docs].tolist())


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A billion tf, divided by 1000 tf + 8 m, rounded down."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def search_portion(block: Block, best: Best, keys, ids, m, size, terms, tfs) -> None:
    """Visits the strata of a portion from the highest bound down."""
    portion = Portion(block, m, size, terms, tfs)
    n = len(portion.norms)
    if not n or not len(block.terms):
        return
    step = max(1, _CELLS // len(block.terms))
    highest = np.concatenate([portion.highest(block, slice(a, min(a + step, n))) for a in range(0, n, step)])
    for s in np.argsort(-highest.max(axis=1), kind="stable").tolist():
        # A bound that only equals the floor may still win by its key.
        open_ = np.flatnonzero(highest[s] >= np.maximum(best.floors, 1))
        if len(open_):
            portion.visit(block, s, open_, best, keys, ids)


def _hits(rows: DataFrame, block: Block, floors: np.ndarray, k: int) -> DataFrame:
    """(query, key, doc_id, score): at most k rows per query and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k, floors)
        for batch in batches:
            lists = batch.column("terms")
            size = np.diff(np.asarray(lists.offsets))
            ends = np.cumsum(size)
            cuts = np.flatnonzero(np.diff(ends // POSTINGS)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                search_portion(
                    block, best, np.asarray(part.column("key")),
                    np.array(part.column("doc_id").to_pylist(), object), np.asarray(part.column("m")),
                    size[a:b], np.asarray(part.column("terms").flatten()), np.asarray(part.column("tfs").flatten()),
                )
        out = [(block.names[q], key, doc, -score) for q, rows in enumerate(best.rows) for score, key, doc in rows]
        if out:
            yield common.columns_to_batch("query,key,doc_id,score", *(pa.array(c, pa.int64()) for c in zip(*out)))

    return rows.select("key", "doc_id", "m", "terms", "tfs").mapInArrow(run, "query long, key long, doc_id long, score long")


def _blocks(index: Index) -> Iterator[tuple[DataFrame, Block]]:
    """The queries in blocks of a bounded number of items and terms."""
    sizes = index.queries.groupBy("item_id").agg(F.count("*").alias("n"))
    total = sizes.agg(F.count("*").alias("items"), F.coalesce(F.sum("n"), F.lit(0)).alias("pairs")).first()
    blocks = max(1, -(-total["items"] // QUERIES) * 2 if total["items"] > QUERIES else 1, -(-total["pairs"] // PAIRS))
    # Numbers depend on where rows lie, so they are taken from a stored table.
    numbered = materialise(materialise(sizes).select("item_id", F.monotonically_increasing_id().alias("query")))
    pairs = materialise(
        index.queries.join(numbered, index.queries["item_id"].eqNullSafe(numbered["item_id"]))
        .join(index.weights, "term").select("query", "term", "w", F.pmod(F.xxhash64("query"), F.lit(blocks)).alias("block"))
    )
    for number in range(blocks):
        rows = pairs.filter(F.col("block") == number).select("query", "term", "w").toPandas()
        if not len(rows):
            continue
        names, q = np.unique(rows["query"].to_numpy(), return_inverse=True)
        terms, t = np.unique(rows["term"].to_numpy(), return_inverse=True)
        weights = np.zeros((len(terms), len(names)), np.int64)
        weights[t, q] = rows["w"].to_numpy()
        # Sums below 2^53 are exact in doubles, whose products are fast; an impact is at most a million.
        if int(weights.sum(axis=0).max()) * 1_000_000 < 1 << 53:
            weights = weights.astype(np.float64)
        yield numbered, Block(names.tolist(), terms, weights)


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item with a score above zero."""
    index = build(docs, items)
    partitions = int(max(index.postings // (4 * POSTINGS), 1))
    dealt = materialise(index.rows.repartitionByRange(partitions, "m", "key").sortWithinPartitions("m", "key"))
    spread = max(index.postings // POSTINGS, 1)
    first = dealt.filter(F.pmod(F.xxhash64("key"), F.lit(spread)) == 0).coalesce(1) if spread > 1 else None
    parts, numbered = [], None
    for numbered, block in _blocks(index):
        floors = np.zeros(len(block.names), np.int64)
        if first is not None:
            place = {name: i for i, name in enumerate(block.names)}
            seen = _hits(first, block, floors, k).groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("least"))
            for row in seen.filter(F.col("n") == k).toLocalIterator():
                floors[place[row["query"]]] = row["least"]
        parts.append(_hits(dealt, block, floors, k))
    kind = items.schema["item_id"].dataType.simpleString()
    if not parts:
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    hits = parts[0]
    for part in parts[1:]:
        hits = hits.unionByName(part)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "key")
    ranked = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(numbered, "query").select("item_id", "rank", "doc_id", "score")
