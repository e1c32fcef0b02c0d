"""Quality scores by a generalised additive model with pairwise interactions.

A text becomes a few dozen numbers (``FEATURES``). Each feature is cut into bins at
quantiles of the training rows. Boosting goes round the features: in each turn a
shallow tree over the bins of one feature is fitted to what is still unexplained and a
small part of it is added to the feature's lookup table. Then pairs of features are ranked by
how much a two-by-two cut of both explains of the rest, and the best pairs get tables in the
same way. A score is the sum of table entries at the row's bins, through a logistic link.

Fitting looks at a bounded sample of labelled rows (``SAMPLE``).

Defined cases: a null text counts as empty; an empty text has all features at
zero and is scored like any other; repeated rows get equal scores; without labelled rows
every score is 0.5; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import common, labelled

SAMPLE, FOLDS, HELD = 20_000, 5, 0
BINS, PAIR_BINS, PAIRS = 32, 8, 10
ROUNDS, PAIR_ROUNDS, RATE, LEAVES, LEAST_ROWS, RIDGE = 250, 120, 0.08, 4, 10, 1.0

FEATURES = (
    "log_bytes log_words word_bytes upper digits spaces line_feeds symbols periods commas bangs bars other_ascii "
    "high_bytes byte_entropy distinct_words top_word twice_in_a_row marked_words short_words long_words upper_words "
    "log_lines line_words repeated_lines top_line stops_per_word"
).split()

_UPPER, _DIGIT = slice(0x41, 0x5B), slice(0x30, 0x3A)
_SYMBOLS = np.frombuffer(b"#$%&*+<=>@\\^_`{}~", np.uint8)


def features(text: str) -> list[float]:
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size, n = len(raw), len(words)
    shares = counts[counts > 0] / size
    common_words = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    common_lines = Counter(lines)
    lengths = np.fromiter(map(len, words), np.int64, n)
    marked = sum(k for w, k in common_words.items() if w[-1] < 128 and not w[-1:].isalnum() and w[-1:] not in b".,")
    upper = sum(k for w, k in common_words.items() if len(w) > 1 and w.isupper())
    return [
        math.log1p(size), math.log1p(n), size / n, counts[_UPPER].sum() / size, counts[_DIGIT].sum() / size,
        counts[0x20] / size, counts[0x0A] / size, counts[_SYMBOLS].sum() / size, counts[0x2E] / size,
        counts[0x2C] / size, counts[0x21] / size, counts[0x7C] / size,
        (counts[0x21:0x30].sum() + counts[0x3A:0x41].sum()) / size, counts[0x80:].sum() / size,
        float(-(shares * np.log2(shares)).sum()), len(common_words) / n, common_words.most_common(1)[0][1] / n,
        sum(map(eq, words, words[1:])) / n, marked / n, float((lengths <= 2).mean()), float((lengths >= 15).mean()),
        upper / n, math.log1p(len(lines)), n / max(len(lines), 1), 1 - len(common_lines) / max(len(lines), 1),
        (common_lines.most_common(1)[0][1] / len(lines)) if lines else 0.0, counts[0x2E] / n,
    ]


def _matrix(texts: list[str | None]) -> np.ndarray:
    return np.array([features(x or "") for x in texts], float).reshape(-1, len(FEATURES))


@dataclass
class Model:
    """Bin borders, lookup tables of features and of pairs, and the intercept."""

    borders: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_borders: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)
    intercept: float = 0.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for f, table in enumerate(self.tables):
            total += table[np.searchsorted(self.borders[f], x[:, f], side="right")]
        wide = {f: np.searchsorted(self.pair_borders[f], x[:, f], side="right") for p in self.pairs for f in p}
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[wide[a], wide[b]]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def shallow_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Step per bin of a tree with a few leaves over one feature's bins; the best cut first."""
    parts, cg, ch, cn = [(0, len(g))], *(np.r_[0, np.cumsum(x)] for x in (g, h, n))
    while len(parts) < leaves:
        best = (1e-9, 0, 0)
        for i, (a, b) in enumerate(parts):
            at = np.arange(a + 1, b)
            at = at[(cn[at] - cn[a] >= LEAST_ROWS) & (cn[b] - cn[at] >= LEAST_ROWS)]
            if len(at):
                won = _gain(cg[at] - cg[a], ch[at] - ch[a]) + _gain(cg[b] - cg[at], ch[b] - ch[at])
                won = won - _gain(cg[b] - cg[a], ch[b] - ch[a])
                k = int(np.argmax(won))
                best = max(best, (float(won[k]), i, int(at[k])), key=lambda x: x[0])
        if not best[2]:
            break
        a, b = parts[best[1]]
        parts[best[1] : best[1] + 1] = [(a, best[2]), (best[2], b)]
    step = np.zeros(len(g))
    for a, b in parts:
        step[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + RIDGE)
    return step


def cross_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and step per cell of the best two-by-two cut of a table of two features."""
    cg, ch, cn = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h, n))
    rows, cols = g.shape
    best, step = 0.0, np.zeros_like(g)
    for i in range(1, rows):
        j = np.arange(1, cols)
        quads = []
        for c in (cg, ch, cn):
            q11 = c[i, j]
            q12, q21 = c[i, cols] - q11, c[rows, j] - q11
            quads.append((q11, q12, q21, c[rows, cols] - q11 - q12 - q21))
        won = sum(_gain(a, b) for a, b in zip(quads[0], quads[1]))
        enough = np.min(quads[2], axis=0) >= LEAST_ROWS
        won = np.where(enough, won, 0)
        k = int(np.argmax(won)) if len(j) else 0
        if len(j) and won[k] > best:
            best = float(won[k])
            values = [quads[0][m][k] / (quads[1][m][k] + RIDGE) for m in range(4)]
            step = np.zeros_like(g)
            cut = k + 1
            step[:i, :cut], step[:i, cut:], step[i:, :cut], step[i:, cut:] = values
    return best, step


def fit_tables(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting on the logistic loss; shuffles nothing, so it gives the same tables each time."""
    model = Model()
    if not len(x):
        return model
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    model.intercept = math.log(share / (1 - share))
    inner = np.linspace(0, 1, BINS + 1)[1:-1]
    wide = np.linspace(0, 1, PAIR_BINS + 1)[1:-1]
    model.borders = [np.unique(np.quantile(x[:, f], inner)) for f in range(x.shape[1])]
    model.pair_borders = [np.unique(np.quantile(x[:, f], wide)) for f in range(x.shape[1])]
    bins = [np.searchsorted(b, x[:, f], side="right") for f, b in enumerate(model.borders)]
    coarse = [np.searchsorted(b, x[:, f], side="right") for f, b in enumerate(model.pair_borders)]
    model.tables = [np.zeros(len(b) + 1) for b in model.borders]
    total = np.full(len(x), model.intercept)
    sizes = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, model.tables)]

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f, table in enumerate(model.tables):
            g, h = slopes()
            step = RATE * shallow_tree(
                np.bincount(bins[f], g, len(table)), np.bincount(bins[f], h, len(table)), sizes[f]
            )
            table += step
            total += step[bins[f]]

    def grid(a: int, b: int, values: np.ndarray) -> np.ndarray:
        shape = (len(model.pair_borders[a]) + 1, len(model.pair_borders[b]) + 1)
        return np.bincount(coarse[a] * shape[1] + coarse[b], values, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    ones = np.ones(len(x))
    ranked = sorted(
        ((-cross_tree(grid(a, b, g), grid(a, b, h), grid(a, b, ones))[0], a, b)
         for a, b in combinations(range(x.shape[1]), 2))
    )
    model.pairs = [(a, b) for gain, a, b in ranked[:PAIRS] if gain < 0]
    model.pair_tables = [np.zeros((len(model.pair_borders[a]) + 1, len(model.pair_borders[b]) + 1))
                         for a, b in model.pairs]
    counts = [grid(a, b, ones) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (a, b), table, n in zip(model.pairs, model.pair_tables, counts):
            g, h = slopes()
            step = RATE * cross_tree(grid(a, b, g), grid(a, b, h), n)[1]
            table += step
            total += step[coarse[a], coarse[b]]
    return model


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.steps(batches):
        x = _matrix(batch.column("text").to_pylist())
        yield common.columns_to_batch(
            "doc_id,y,x", batch.column("doc_id"), batch.column("y"), pa.array(x.tolist(), pa.list_(pa.float64()))
        )


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    rows = labelled.sample(docs, labels, "quality", SAMPLE, FOLDS, HELD)
    # At most SAMPLE rows of a few dozen numbers; sorted, so that sums are the same each time.
    found = rows.mapInArrow(_measure, "doc_id long, y int, x array<double>").toPandas().sort_values("doc_id")
    return fit_tables(np.array(found["x"].tolist(), float).reshape(-1, len(FEATURES)), found["y"].to_numpy(float))


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted) for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.steps(batches):
            scores = model.scores(_matrix(batch.column("text").to_pylist()))
            yield common.columns_to_batch(
                "doc_id,score,predicted", batch.column("doc_id"), scores, (scores >= threshold).astype(np.int32)
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(run, "doc_id long, score double, predicted int")
