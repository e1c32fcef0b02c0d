"""Toxicity by weak supervision.

Many weak voters look at a text: one per entry of a lexicon (a fixed list, and words
and word beginnings that stand out in labelled training rows) and a few patterns. A voter says
toxic, clean or nothing. A generative label model with a hidden class learns by
expectation-maximisation how often each voter says what in each class (its
accuracy and coverage). Votes that still go together inside a class are
correlated: their log-likelihood ratios are scaled down so that a clique of
voters weighs as one, and the model is fitted again. Its posterior labels train a
logistic classifier on the voters' counts, which scores every text.

Labels serve to find lexicon entries, to strike entries that they contradict, as the prior of
the hidden class, and as one more (noisy) voter while the model is fitted; they come from a bounded sample of rows (``SAMPLE``).

Defined cases: a null text counts as empty; an empty text is scored like any
other (no voter fires); repeated rows get equal scores; without labelled rows the fixed
lexicon alone is used; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import common, labelled

#: Most labelled rows that fitting looks at.
SAMPLE = 20_000
#: Most entries taken from labelled rows, the share of positive rows that an entry must occur in, and the share
#: of positive rows among those it occurs in. An entry of the fixed list goes if it misses ``KEPT_PRECISION``.
MINED, MINED_SHARE, MINED_ROWS, MINED_PRECISION, KEPT_PRECISION = 200, 0.01, 8, 0.75, 0.4
#: Lengths of word beginnings that are looked at, and the most candidates that are counted in negative rows.
STEMS, CANDIDATES = range(4, 11), 20_000
FOLDS, HELD = 5, 0

# General words of insult.
LEXICON = (
    "ass bastard bitch bigot brainless clown coward creep cretin crap cunt damn dimwit disgusting dumb dumbass fool "
    "freak fuck fucking garbage idiot idiotic imbecile jerk liar loser lunatic moron moronic nasty pathetic pig prick "
    "psycho retard retarded scum shit shut slut stupid sucker trash ugly vermin vile whore worthless wretch"
).split()

# Patterns over lower-cased text.
PATTERNS = (
    ("addressed", r"\b(?:you|u|your|ur|they)(?:'re|\s+are|\s+r)?\s+(?:all\s+|such\s+|just\s+)?(?:an?\s+)?\w*(?:idiot|moron|fool|loser|scum|trash|clown|stupid|pathetic|worthless)"),
    ("wish", r"\b(?:go\s+to\s+hell|drop\s+dead|shut\s+up|get\s+lost|kill\s+yourself|i\s+hate\s+(?:you|them))\b"),
    ("masked", r"\b(?:f[*@#$]+k\w*|s[*@#$]+t|b[*@#$]+h|a[*@#$]{2})(?!\w)"),
)


_WORD = re.compile(r"[^\W\d_]{3,40}")


class Voters:
    """Counts of lexicon entries and patterns in a text, and the votes that follow from them.

    An entry is a whole word, or with a star at its end the beginning of longer words.
    """

    def __init__(self, words: list[str]):
        self.words = sorted(set(words))
        self.place = {w: i for i, w in enumerate(self.words)}
        self.stems = sorted({len(w) - 1 for w in self.words if w.endswith("*")})
        starts = sorted({w.rstrip("*") for w in self.words}, key=lambda w: (-len(w), w))
        self.search = re.compile("|".join(map(re.escape, starts)))
        self.patterns = [re.compile(p) for _, p in PATTERNS]

    def counts(self, text: str) -> list[int]:
        """One count per entry, then one per pattern."""
        out = [0] * (len(self.words) + len(self.patterns))
        text = text.lower()
        for hit in self.search.finditer(text):
            a = hit.start()
            if a and text[a - 1].isalnum():
                continue
            word = _WORD.match(text, a)
            if word is None:
                continue
            word = word.group()
            if word in self.place:
                out[self.place[word]] += 1
            for n in self.stems:
                if len(word) > n and (at := self.place.get(word[:n] + "*")) is not None:
                    out[at] += 1
        for k, pattern in enumerate(self.patterns):
            out[len(self.words) + k] = sum(1 for _ in pattern.finditer(text))
        return out

    def votes(self, counts: np.ndarray) -> np.ndarray:
        """-1 nothing, 0 clean, 1 toxic; word and pattern voters, then four voters over all counts."""
        words = counts[:, : len(self.words)]
        total, kinds = words.sum(axis=1), (words > 0).sum(axis=1)
        single = np.where(counts > 0, 1, -1)
        joint = np.stack(
            [
                np.where(total >= 2, 1, -1),
                np.where(kinds >= 2, 1, -1),
                np.where(total == 0, 0, -1),
                np.where(counts[:, len(self.words) :].sum(axis=1) + total == 0, 0, -1),
            ],
            axis=1,
        )
        return np.concatenate([single, joint], axis=1).astype(np.int8)


@dataclass
class LabelModel:
    """P(vote | class) per voter, the class prior and the weight that correlation leaves to each voter."""

    table: np.ndarray  # voter, class, vote + 1
    prior: float
    weight: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        kinds, back = np.unique(votes, axis=0, return_inverse=True)
        return self.of_patterns(kinds)[back.ravel()]

    def of_patterns(self, kinds: np.ndarray) -> np.ndarray:
        ratio = np.log(self.table[:, 1] / self.table[:, 0]) * self.weight[:, None]
        logit = np.full(len(kinds), np.log(self.prior / (1 - self.prior)))
        for vote in (-1, 0, 1):
            logit += (kinds == vote) @ ratio[:, vote + 1]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def fit_label_model(votes: np.ndarray, prior: float, rounds: int = 60, related: float = 0.15) -> LabelModel:
    """Expectation-maximisation, then correlations inside the classes, then expectation-maximisation again.

    Rows with equal votes count as one pattern, so the work follows the patterns.
    """
    votes, times = np.unique(votes, axis=0, return_counts=True)
    voters = votes.shape[1]
    said = (votes == 1).sum(axis=1)
    start = np.select([said >= 4, said >= 1], [0.9, 0.3], 0.03)

    # A voter that says little says it in both classes until the rows show otherwise.
    pseudo = 3 * np.stack([times @ (votes == v) / max(times.sum(), 1) for v in (-1, 0, 1)]) + 1e-3

    def fit(weight: np.ndarray, belief: np.ndarray) -> tuple[LabelModel, np.ndarray]:
        model = None
        for _ in range(rounds):
            table = np.empty((voters, 2, 3))
            for c, share in ((0, times * (1 - belief)), (1, times * belief)):
                for v in (-1, 0, 1):
                    table[:, c, v + 1] = share @ (votes == v) + pseudo[v + 1]
            table /= table.sum(axis=2, keepdims=True)
            model = LabelModel(table, prior, weight)
            after = model.of_patterns(votes)
            if np.abs(after - belief).max(initial=0) < 1e-6:
                break
            belief = after
        return model, belief

    model, belief = fit(np.ones(voters), start)
    # What is left of the votes when their class is known: correlated rests are shared evidence.
    spread = np.zeros((voters, voters))
    for c, share in ((0, times * (1 - belief)), (1, times * belief)):
        mean = model.table[:, c, 2] - model.table[:, c, 1]
        rest = (np.where(votes == 1, 1, np.where(votes == 0, -1, 0)) - mean) * np.sqrt(share)[:, None]
        spread += rest.T @ rest
    scale = np.sqrt(np.maximum(np.diag(spread), 1e-9))
    correlation = spread / scale[:, None] / scale[None]
    np.fill_diagonal(correlation, 0)
    weight = 1 / (1 + np.where(np.abs(correlation) > related, np.abs(correlation), 0).sum(axis=1))
    return fit(weight, belief)[0]


def fit_linear(x: np.ndarray, target: np.ndarray, ridge: float = 1e-2, rounds: int = 60) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps; the last weight is the intercept."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge * max(len(x), 1) / 100)
    keep[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - target) + keep * w
        curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(keep)
        step = np.linalg.solve(curve, slope)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Model:
    words: list[str]
    weights: np.ndarray

    def inputs(self, counts: np.ndarray) -> np.ndarray:
        words = counts[:, : len(self.words)]
        total, kinds = words.sum(axis=1), (words > 0).sum(axis=1)
        extra = np.stack([total > 0, np.log1p(total), np.minimum(kinds, 4) / 4], axis=1)
        return np.concatenate([np.minimum(counts, 3) / 3, extra], axis=1).astype(float)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.inputs(counts) @ self.weights[:-1] + self.weights[-1], -30, 30)))


def candidates_of(text: str) -> set[str]:
    """The words of a text, and the beginnings of its longer words (with a star)."""
    words = set(_WORD.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in STEMS if n < len(w)}


def _count_candidates(rows: DataFrame, wanted: set[str] | None) -> DataFrame:
    """(entry, n): in how many rows each entry occurs; ``wanted`` limits the entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch in common.steps(batches):
            for text in batch.column("text").to_pylist():
                seen = candidates_of(text or "")
                found.update(seen if wanted is None else seen & wanted)
        if found:
            names, counts = zip(*found.items())
            yield common.columns_to_batch("entry,n", pa.array(names, pa.string()), pa.array(counts, pa.int64()))

    counted = rows.select("text").mapInArrow(run, "entry string, n long")
    return counted.groupBy("entry").agg(F.sum("n").alias("n"))


def choose_entries(rows: DataFrame, positives: int) -> list[str]:
    """The fixed lexicon without what labels contradict, and entries that labels bear out."""
    least = max(MINED_ROWS, MINED_SHARE * positives)
    common_in_toxic = (
        _count_candidates(rows.filter("y = 1"), None).filter(F.col("n") >= least)
        .orderBy(F.desc("n"), "entry").limit(CANDIDATES)
    )
    hits = {r["entry"]: r["n"] for r in common_in_toxic.collect()}
    # A list of at most CANDIDATES entries goes to the tasks.
    misses = {r["entry"]: r["n"] for r in _count_candidates(rows.filter("y = 0"), {*hits, *LEXICON}).collect()}
    kept = [w for w in LEXICON if hits.get(w, 0) >= KEPT_PRECISION * (hits.get(w, 0) + misses.get(w, 0))]
    good = [w for w in hits if hits[w] >= MINED_PRECISION * (hits[w] + misses.get(w, 0)) and w not in kept]
    chosen: list[str] = []
    # Beginnings first, the commonest first; what a chosen beginning covers adds nothing.
    for w in sorted(good, key=lambda w: (not w.endswith("*"), -hits[w], len(w), w)):
        stems = [c[:-1] for c in chosen if c.endswith("*")]
        whole = [k for k in kept if w.endswith("*") and k.startswith(w[:-1])]
        if not whole and not any(w.startswith(s) and w.rstrip("*") != s for s in stems) and len(chosen) < MINED:
            chosen.append(w)
    return kept + chosen


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    rows = labelled.sample(docs, labels, "toxic", SAMPLE, FOLDS, HELD)
    total, positives = rows.agg(F.count("*"), F.sum("y")).first()
    voters = Voters(choose_entries(rows, positives) if positives else LEXICON)
    model = Model(voters.words, np.zeros(0))
    if not total:
        # No rows to learn from: any hit counts for toxic.
        width = len(voters.words) + len(PATTERNS)
        model.weights = np.r_[np.zeros(width), 4.0, 1.0, 0.0, -3.0]
        return model
    # At most SAMPLE rows of small counts.
    counted = rows.select("y", "text").mapInArrow(_counter(voters.words), "y int, counts array<int>").toPandas()
    counts = np.array(counted["counts"].tolist(), np.int64)
    prior = min(max(positives / total, 0.01), 0.5)
    # While fitting, the row's own label is one more voter, right as often as the others bear out.
    votes = np.concatenate([voters.votes(counts), counted["y"].to_numpy(np.int8)[:, None]], axis=1)
    posterior = fit_label_model(votes, prior).posterior(votes)
    model.weights = fit_linear(model.inputs(counts), posterior)
    return model


def _counter(words: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(words)
        for batch in common.steps(batches):
            counts = [voters.counts(x or "") for x in batch.column("text").to_pylist()]
            yield common.columns_to_batch("y,counts", batch.column("y"), pa.array(counts, pa.list_(pa.int32())))

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(model.words)
        for batch in common.steps(batches):
            counts = np.array([voters.counts(x or "") for x in batch.column("text").to_pylist()], np.int64)
            scores = model.scores(counts)
            yield common.columns_to_batch(
                "doc_id,score,predicted", batch.column("doc_id"), scores, (scores >= 0.5).astype(np.int32)
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(run, "doc_id long, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    rows = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(model.words)
        for batch in common.steps(batches):
            counts = np.array([voters.counts(x or "") for x in batch.column("text").to_pylist()], np.int64)
            yield batch.filter(pa.array(model.scores(counts) < 0.5))

    return docs.mapInArrow(run, rows)
