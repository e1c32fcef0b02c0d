"""Exact top-k inner products by MaxScore over signed integer vectors.

A component is floor(scale * x). To have postings with non-negative weights, every
dimension gives two terms, one for queries with a positive component (weight of a
vector: its component minus the least of the shard) and one for negative components (the
greatest of the shard minus its component); what is split off is a constant of the query and
the shard. A term's bound in a shard is the query's weight times the greatest
posting weight.

In a shard a query sorts its terms by bound. While the bounds of the low terms
together cannot lift a vector over the query's threshold, these are non-essential:
only postings of the essential terms are traversed, and their vectors are the
candidates. The non-essential terms are probed from the largest bound down, and
a candidate goes as soon as its score and the remaining bounds stay below the
threshold. The threshold is the k-th best score so far; queries and vectors are
cut into blocks, every pair of blocks is one unit of work, the units' best rows are
merged at the end. Vectors with equal components share a posting, so
copies cost one evaluation.

Defined cases: vectors that are null, empty or hold a null, NaN or infinite component
take no part, neither do ids that are null; a vector is compared with those of its own length
only; of repeated ids every row is a query and a candidate, the queries share one ranking, and none
sees a row of its own id; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm import common
from reviewmill.session import materialise

SCALE = 64
#: Vectors of a shard and queries of a block.
SHARD_ROWS, QUERY_ROWS = 8192, 1024
RESULT = "query_id long, vec_id long, score long"


class Shard:
    """Postings of one block of vectors: per term, the vectors in falling order of weight."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        # Copies share one entry; its ids are kept in rising order.
        order = np.lexsort((ids, *vectors.T[::-1])) if len(ids) else np.arange(0)
        vectors, ids = vectors[order], ids[order]
        new = np.r_[True, (vectors[1:] != vectors[:-1]).any(axis=1)] if len(ids) else np.array([], bool)
        self.first = np.flatnonzero(new)
        self.until = np.r_[self.first[1:], len(ids)]
        self.ids, self.points = ids, vectors[self.first]
        self.low, self.high = self.points.min(axis=0), self.points.max(axis=0)
        self.spread = self.high - self.low
        # Terms are read by dimension; rows of a term are contiguous.
        self.up = np.ascontiguousarray((self.points - self.low).T)
        self.down = np.ascontiguousarray((self.high - self.points).T)
        self.by_weight = np.argsort(-self.up, axis=1, kind="stable")

    def top(self, query: np.ndarray, k: int, floor: int, own: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of at least all rows that belong to the best k and reach ``floor``."""
        weight = np.abs(query)
        base = int(np.where(query >= 0, self.low, self.high) @ query)
        bounds = weight * self.spread
        terms = np.argsort(-bounds, kind="stable")
        terms = terms[bounds[terms] > 0]
        # rest[i]: the most that terms i.. can still add.
        rest = np.r_[np.cumsum(bounds[terms][::-1])[::-1], 0]
        need = floor - base
        if rest[0] < need:
            return np.array([], np.int64), np.array([], np.int64)
        # The essential terms: a vector without any posting in them cannot reach the threshold.
        essential = int(np.searchsorted(-rest, -need, side="right")) if need > 0 else 0
        essential = max(0, min(essential, len(terms)))
        alive, score = self._traverse(query, terms[:essential], need)
        done = essential
        if not essential:
            alive, score = np.arange(len(self.points)), np.zeros(len(self.points), np.int64)
        while done < len(terms):
            step = terms[done : done + 4]
            for t in step:
                score += weight[t] * (self.up if query[t] >= 0 else self.down)[t][alive]
            done += len(step)
            keep = score + rest[done] >= need
            if not keep.all():
                alive, score = alive[keep], score[keep]
            if not len(alive):
                break
        return self._rows(alive, score + base, k, floor, own)

    def _traverse(self, query: np.ndarray, terms: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores over the essential postings of every vector that has one."""
        score = np.zeros(len(self.points), np.int64)
        seen = np.zeros(len(self.points), bool)
        for t in terms:
            row = (self.up if query[t] >= 0 else self.down)[t]
            score += abs(int(query[t])) * row
            seen |= row > 0
        alive = np.flatnonzero(seen) if len(terms) else np.arange(len(self.points))
        return alive, score[alive]

    def _rows(self, alive: np.ndarray, score: np.ndarray, k: int, floor: int, own: int):
        if len(alive) > k + 1:
            # The query's own entry may take one place, so one more is kept.
            cut = np.partition(score, len(score) - k - 1)[len(score) - k - 1]
            keep = score >= cut
            alive, score = alive[keep], score[keep]
        ids, scores = [], []
        for p, s in zip(alive.tolist(), score.tolist()):
            some = self.ids[self.first[p] : self.until[p]]
            some = some[some != own][:k]
            ids.append(some)
            scores.append(np.full(len(some), s))
        if not ids:
            return np.array([], np.int64), np.array([], np.int64)
        ids, scores = np.concatenate(ids), np.concatenate(scores)
        best = np.lexsort((ids, -scores))[:k]
        best = best[scores[best] >= floor]
        return ids[best], scores[best]


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<long>, width): floor(scale * x) of every usable vector."""
    x = F.col("embedding")
    usable = F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0) & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    )
    return vectors.filter(usable).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v"),
        F.size(x).alias("width"),
    )


def _blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Rows packed into blocks of about ``size``: (width, block, ids, values)."""
    counts = {r["width"]: r["n"] for r in rows.groupBy("width").agg(F.count("*").alias("n")).collect()}
    number = F.lit(1)
    for width, n in counts.items():
        number = F.when(F.col("width") == width, -(-n // size)).otherwise(number)
    # Copies spread as well: the id is what is hashed, and with it a number for repeated ids.
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), number.cast("long")))
    grouped = dealt.groupBy("width", "block").agg(F.collect_list(F.struct("vec_id", "v")).alias("rows"))
    return grouped.select(
        "width", F.col("block").alias(name), F.col("rows.vec_id").alias(f"{name}_ids"),
        F.flatten(F.col("rows.v")).alias(f"{name}_values"),
    )


def _best(k: int) -> Window:
    return Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")


def top_k(vectors: DataFrame, k: int = 20, query_step: int = 20, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) for every row whose id is divisible by ``query_step``."""
    rows = materialise(quantised(vectors))
    shards = materialise(_blocks(rows, shard_rows, "shard"))
    queries = materialise(_blocks(rows.filter(F.pmod("vec_id", F.lit(query_step)) == 0), QUERY_ROWS, "asked"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in
                       ("shard_ids", "shard_values", "asked_ids", "asked_values")}
                width = batch.column("width")[i].as_py()
                shard = Shard(row["shard_values"].reshape(-1, width), row["shard_ids"])
                out = [[], [], []]
                for own, query in zip(row["asked_ids"].tolist(), row["asked_values"].reshape(-1, width)):
                    floor = _seed_floor(shard, query, k, own)
                    ids, scores = shard.top(query, k, floor, own)
                    out[0].append(np.full(len(ids), own))
                    out[1].append(ids)
                    out[2].append(scores)
                yield common.columns_to_batch("query_id,vec_id,score", *(np.concatenate(x) for x in out))

    # Every block of queries meets every shard: an equi-join on the width and on a list of shard numbers.
    numbers = shards.groupBy("width").agg(F.collect_list("shard").alias("shards"))
    wanted = queries.join(numbers, "width").withColumn("shard", F.explode("shards")).drop("shards")
    pairs = wanted.join(shards, ["width", "shard"])
    found = pairs.mapInArrow(score, RESULT)
    ranked = found.withColumn("rank", F.row_number().over(_best(k)).cast("int")).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _seed_floor(shard: Shard, query: np.ndarray, k: int, own: int) -> int:
    """A threshold that k rows of the shard surely reach: the k-th best score of the vectors at the head of the
    query's heaviest posting list."""
    points = shard.points
    if len(points) <= 4 * k:
        return -(1 << 62)
    weight = np.abs(query) * shard.spread
    heads = []
    for t in np.argsort(-weight, kind="stable")[:4]:
        order = shard.by_weight[t]
        heads.append(order[: 2 * k] if query[t] >= 0 else order[-2 * k :])
    some = np.unique(np.concatenate(heads))
    scores = points[some] @ query
    # The query's own row may be among them, so one more than k is asked for.
    return int(np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]) if len(scores) > k + 1 else -(1 << 62)
