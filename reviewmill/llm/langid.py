"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary. The
probability of a word is the sum over all ways to cut it into pieces of the product of
their probabilities, by a forward algorithm; a text is the product of its words. The
piece probabilities are fitted by expectation-maximisation: each round a Spark job
runs forward and backward over the counted words of the training texts and adds up the
expected counts of the pieces.

Words are runs of letters in lower case, a word start is part of its first piece. A letter
outside the vocabulary is a piece of its own with one small probability for all languages.

Training texts are a bounded sample chosen by a hash of the id: the first ``SAMPLE`` documents, and of
each language the first ``SHARE`` or so besides (all, if it has fewer), so a rare language is learned too.

Defined cases: a text that is null or has no letter is ``und`` with score 0; so is
every text if nothing could be learned; equal scores go to the language that comes first in the
alphabet; repeated rows get equal results; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import common
from reviewmill.session import materialise

FOLDS, HELD = 4, 2
#: Training documents, those of each language at least, rounds of expectation-maximisation, longest piece.
SAMPLE, SHARE, ROUNDS, LONGEST = 6000, 1500, 4, 16
#: Pseudo-count of each piece in each language, and the probability of a letter outside the vocabulary.
PSEUDO, UNKNOWN = 0.02, 1e-7
#: Words whose probabilities a worker remembers.
MEMO_ENTRIES = 400_000
START = "▁"
_LETTERS = re.compile(r"[^\W\d_]+")


def _only_letters(run: str) -> list[str]:
    """The stretches of letters (general category L) in a run of word characters."""
    if run.isalpha():
        return [run]
    return "".join(c if c.isalpha() else " " for c in run).split()


@lru_cache(maxsize=2)
def vocabulary(path: str) -> dict[str, int]:
    """Pieces that lower-case words can be made of, numbered in order of the vocabulary."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    found: dict[str, int] = {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        letters = piece.removeprefix(START)
        if (not letters or letters.isalpha()) and letters == letters.lower() and len(piece) <= LONGEST:
            found.setdefault(piece, len(found))
    return found


def words_of(text: str) -> list[str]:
    # Number signs such as ² are word characters for the pattern, but no letters.
    found = _LETTERS.findall(text.lower())
    return found if text.isascii() else [w for run in found for w in _only_letters(run)]


@dataclass
class Model:
    languages: list[str]
    table: dict[str, tuple[float, ...]]  # piece -> probability per language

    def log_word(self, word: str) -> tuple[float, ...]:
        """log P(word) per language, over all segmentations."""
        word, table, many = START + word, self.table, range(len(self.languages))
        n, shift = len(word), [0.0 for _ in many]
        ways: list[list[float]] = [[1.0 for _ in many]]
        for end in range(1, n + 1):
            now = [0.0 for _ in many]
            for start in range(max(0, end - LONGEST), end):
                found = table.get(word[start:end])
                if found is not None:
                    before = ways[start]
                    for i in many:
                        now[i] += before[i] * found[i]
                elif start == end - 1:
                    before = ways[start]
                    for i in many:
                        now[i] += before[i] * UNKNOWN
            ways.append(now)
            if end % 32 == 0:  # long words: what is left of the window goes up together, the log remembers
                for i in many:
                    top = max(w[i] for w in ways[-LONGEST:])
                    if top < 1e-60:
                        for w in ways[-LONGEST:]:
                            w[i] /= top
                        shift[i] += math.log(top)
        return tuple(math.log(max(x, 1e-300)) + s for x, s in zip(ways[n], shift))


class Scorer:
    """log P of many words at once: words of one length share the steps of the forward algorithm."""

    #: Longer words could underflow; they are worked off one by one, with scaling.
    TOGETHER = 40

    def __init__(self, model: Model):
        self.model = model
        self.place = {piece: i for i, piece in enumerate(model.table)}
        known = np.array(list(model.table.values()), float).reshape(len(self.place), len(model.languages))
        # Behind the pieces: the row of a letter outside the vocabulary, and the row of what is no piece.
        self.table = np.vstack([known, np.full((1, known.shape[1]), UNKNOWN), np.zeros((1, known.shape[1]))])
        self.letter, self.nothing = len(known), len(known) + 1

    def log_words(self, words: list[str]) -> np.ndarray:
        out = np.empty((len(words), len(self.model.languages)))
        groups: dict[int, list[int]] = defaultdict(list)
        for i, word in enumerate(words):
            groups[len(word)].append(i)
        for size, at in groups.items():
            if size > self.TOGETHER:
                for i in at:
                    out[i] = self.model.log_word(words[i])
            else:
                out[at] = self._forward([START + words[i] for i in at], size + 1)
        return out

    def _forward(self, words: list[str], size: int) -> np.ndarray:
        find = self.place.get
        ways = np.zeros((size + 1, len(words), len(self.model.languages)))
        ways[0] = 1.0
        for end in range(1, size + 1):
            for start in range(max(0, end - LONGEST), end):
                missing = self.letter if start == end - 1 else self.nothing
                rows = np.array([find(w[start:end], missing) for w in words])
                hit = np.flatnonzero(rows != self.nothing)
                if len(hit):
                    ways[end, hit] += ways[start, hit] * self.table[rows[hit]]
        return np.log(np.maximum(ways[size], 1e-300))


def expected_pieces(word: str, table: dict[str, float]) -> list[tuple[str, float]]:
    """The expected count of each vocabulary piece in a word of one language (forward and backward)."""
    word = START + word
    n = len(word)
    ways, rest = [0.0] * (n + 1), [0.0] * (n + 1)
    ways[0] = rest[n] = 1.0
    arcs = []
    for end in range(1, n + 1):
        for start in range(max(0, end - LONGEST), end):
            piece = word[start:end]
            p = table.get(piece)
            if p is None and start == end - 1:
                p, piece = UNKNOWN, ""
            if p is not None:
                ways[end] += ways[start] * p
                arcs.append((start, end, piece, p))
    for start, end, _, p in reversed(arcs):
        rest[start] += p * rest[end]
    total = ways[n]
    if total <= 0.0:
        return []
    return [(piece, ways[a] * p * rest[b] / total) for a, b, piece, p in arcs if piece]


def training_words(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(lang, word, n): counted words of the sampled training documents, stored."""
    usable = docs.filter(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull()
        & (common.fold(F.col("doc_id"), FOLDS) != HELD)
    ).select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    first = usable.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # The place of an id among all hashes, from 0 to 1: no language has to be sorted in one task.
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / float(1 << 53)
    ids = usable.select("doc_id", "lang").distinct()
    sizes = F.broadcast(ids.groupBy("lang").agg(F.count("*").alias("n")))  # a row per language
    of_each = ids.join(sizes, "lang").filter(place * F.col("n") < SHARE).select("doc_id")
    wanted = first.unionByName(of_each).distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = defaultdict(Counter)
        for batch in common.steps(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                found[lang].update(w for w in words_of(text) if len(w) <= 60)
        for lang, counts in found.items():
            names, n = zip(*counts.items()) if counts else ((), ())
            yield common.columns_to_batch(
                "lang,word,n", pa.array([lang] * len(names), pa.string()), pa.array(names, pa.string()),
                pa.array(n, pa.int64()),
            )

    # At most ``sample`` ids and ``SHARE`` per language: small enough for every executor.
    rows = usable.join(F.broadcast(wanted), "doc_id").select("lang", "text")
    counted = rows.mapInArrow(count, "lang string, word string, n long")
    return materialise(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")))


def fit(docs: DataFrame, path: str | None = None, sample: int = SAMPLE, rounds: int = ROUNDS) -> Model:
    path = path or public_tokenizers.path("piece_bpe_32k.model")
    words = training_words(docs, sample)
    languages = sorted(r["lang"] for r in words.select("lang").distinct().collect())
    pieces = list(vocabulary(path))
    number = vocabulary(path)
    # One column per language; the table is as large as vocabulary x languages, whatever the corpus.
    share = np.full((len(pieces), len(languages)), 1 / len(pieces))
    place = {lang: i for i, lang in enumerate(languages)}
    for _ in range(rounds if languages else 0):
        sent = words.sparkSession.sparkContext.broadcast(share)

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = vocabulary(path)
            tables = {lang: dict(zip(known, sent.value[:, i].tolist())) for lang, i in place.items()}
            counts = np.zeros((len(known), len(place)))
            for batch in batches:
                for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n"))):
                    for piece, part in expected_pieces(word, tables[lang]):
                        counts[known[piece], place[lang]] += n * part
            at, lang = np.nonzero(counts)
            yield common.columns_to_batch("piece,lang,n", at.astype(np.int32), lang.astype(np.int32), counts[at, lang])

        totals = words.repartition("lang", "word").mapInArrow(expect, "piece int, lang int, n double")
        share = np.full_like(share, PSEUDO)
        for row in totals.groupBy("piece", "lang").agg(F.sum("n").alias("n")).toLocalIterator():
            share[row["piece"], row["lang"]] += row["n"]
        share /= share.sum(axis=0)
    return Model(languages, {p: tuple(share[i].tolist()) for p, i in number.items()})


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs``; the score is the posterior of the language named."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        langs, scorer = fitted.languages, Scorer(fitted)
        place: dict[str, int] = {}
        logs = np.zeros((0, len(langs)))
        for batch in common.steps(batches):
            counted = [Counter(words_of(x)) if x else Counter() for x in batch.column("text").to_pylist()]
            if len(place) > MEMO_ENTRIES:
                place, logs = {}, logs[:0]
            unseen = list({w for counts in counted for w in counts if w not in place}) if langs else []
            place.update((w, len(logs) + i) for i, w in enumerate(unseen))
            logs = np.concatenate([logs, scorer.log_words(unseen)]) if unseen else logs
            names, scores = [], []
            for counts in counted:
                if not counts or not langs:
                    names.append("und")
                    scores.append(0.0)
                    continue
                total = np.array(list(counts.values())) @ logs[[place[w] for w in counts]]
                best = int(np.argmax(total))
                names.append(langs[best])
                scores.append(float(1 / np.exp(total - total[best]).sum()))
            yield common.columns_to_batch(
                "doc_id,lang_pred,score", batch.column("doc_id"), pa.array(names, pa.string()),
                pa.array(scores, pa.float64()),
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(run, "doc_id long, lang_pred string, score double")
