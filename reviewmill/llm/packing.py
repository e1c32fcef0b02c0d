"""Best-fit packing of token sequences with several capacities per bin.

Pieces of documents are dealt to shards of a bounded number of tokens and
pieces. A shard is packed in one task: pieces go by falling length, and each
one is put into the open bin that suits it best among those that can still take
it under every capacity (tokens, documents, attention cost = sum of squared
lengths). "Best" is the smallest weighted norm of what would be left in the
bin, or the largest weighted dot-product of the piece's demand with the bin's
residual capacities. A shard wastes about one bin, so its size bounds the loss.

Defined cases: a null or empty text is the end token alone; rows with equal ids
are separate documents; an empty table gives no rows; other columns of the input
are ignored.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import common
from reviewmill.session import materialise

WINDOW = 4096
END_ID = 1
#: Largest share of work of one packing task.
SHARD_TOKENS, SHARD_PIECES = 4 << 20, 100_000
#: Entries of each of the two halves of a worker's memo of encoded words.
MEMO_ENTRIES = 350_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, turn long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
#: Stands between words that are encoded in one call.
_MARK = "|"
#: What often ends a word and is cut from the letters before it, as one stretch: ASCII punctuation but ' and the mark.
_ENDS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{}~"
#: Words of one call; larger calls take more time a word.
_TOGETHER = 200


def _lowered(text: bytes) -> bytes:
    """ASCII capitals as small letters, which halves the spellings; not where combining marks (U+0300 to U+036F) could
    make another composed letter of them."""
    return text if b"\xcc" in text or b"\xcd" in text else text.lower()


def _letters_only(part: bytes) -> bool:
    """Letters after normalisation too: a capital may become a letter and a mark that is none."""
    return part.isalpha() or unicodedata.normalize("NFC", part.decode("utf-8", "replace")).lower().isalpha()


class WordEncoder:
    """Token ids of a text from the ids of its parts between ASCII spaces.

    White space never lies inside a token of this vocabulary, so the parts are
    encoded on their own, each spelling once as long as the memo holds it. The memo has a young and an
    old half: when the young one is full it becomes the old one, and what the old one held and nobody
    asked for since is forgotten.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Special tokens are found in the raw text before anything else; what lies between is ordinary text.
        specials = {t.content.encode(): i for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special}
        self.special_ids = {name: np.array([i], "<u4").tobytes() for name, i in specials.items()}
        self.specials = re.compile(b"(" + b"|".join(map(re.escape, specials)) + b")") if specials else None
        self.memo: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.mark = self._plain(_MARK)[0]

    def _plain(self, text: str) -> list[int]:
        """Ids of text whose special strings are ordinary; the tokenizer itself stays as it was loaded."""
        self.tokenizer.encode_special_tokens = True
        try:
            # The fast call leaves out offsets, which nobody asks for here.
            return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        finally:
            self.tokenizer.encode_special_tokens = False

    def _learn(self, parts: list[bytes]) -> None:
        """Encodes unseen parts, many in one call with a mark between them."""
        memo, marked, together, ended = self.memo, _MARK.encode(), [], []
        asked = set(parts)
        for part in parts:
            stem = part.rstrip(_ENDS)
            last = part[len(stem) :]
            if last and _letters_only(stem):
                # Letters and the marks behind them are encoded apart.
                ended.append((part, stem, last))
                for piece in (stem, last):
                    if piece not in memo and piece not in asked:
                        asked.add(piece)
                        together.append(piece)
            elif len(part) > 64 or marked in part:
                memo[part] = np.array(self._plain(part.decode("utf-8", "replace")), "<u4").tobytes()
            else:
                together.append(part)
        for i in range(0, len(together), _TOGETHER):
            some = together[i : i + _TOGETHER]
            ids = np.array(self._plain((b" " + marked + b" ").join(some).decode("utf-8", "replace")), "<u4")
            marks = np.flatnonzero(ids == self.mark)
            if len(marks) != len(some) - 1:  # cannot happen while the mark is one token of its own
                memo.update((x, np.array(self._plain(x.decode("utf-8", "replace")), "<u4").tobytes()) for x in some)
                continue
            packed, begins = ids.tobytes(), [0, *(4 * (marks + 1)).tolist()]
            ends = [*(4 * marks).tolist(), len(packed)]
            memo.update(zip(some, [packed[a:b] for a, b in zip(begins, ends)]))
        for part, stem, last in ended:
            memo[part] = memo[stem] + memo[last]

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers, as the plain tokenizer gives them."""
        if self.specials is None or not any(self.specials.search(x) for x in texts):
            return self._ordinary(texts)
        cut = [self.specials.split(x) for x in texts]
        between = iter(self._ordinary([x for parts in cut for x in parts[::2]]))
        return [
            b"".join(self.special_ids[x] if k % 2 else next(between) for k, x in enumerate(parts)) for parts in cut
        ]

    def _ordinary(self, texts: list[bytes]) -> list[bytes]:
        split = [_lowered(x).split() for x in texts]
        if len(self.memo) > MEMO_ENTRIES:
            self.memo, self.old = {}, self.memo
        memo, old = self.memo, self.old
        unseen = set().union(*split).difference(memo)
        if old:
            known = unseen.intersection(old)
            memo.update((p, old[p]) for p in known)
            unseen -= known
        if unseen:
            self._learn(list(unseen))
        ids_of = memo.__getitem__
        return [b"".join(map(ids_of, parts)) for parts in split]

    def forget(self) -> None:
        self.memo, self.old = {}, {}


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    """One encoder per worker, so that its memo serves all tasks; other operators' tasks clear it."""
    found = WordEncoder(path)
    common.keep("packing", found.forget)
    return found


def cut_pieces(docs: DataFrame, tokenizer_path: str | None = None, window: int = WINDOW) -> DataFrame:
    """One row per piece of a document's ids plus the end id, with its CRC-32."""
    path = tokenizer_path or public_tokenizers.path("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, turn, end = _encoder(path), 0, np.array([END_ID], "<u4").tobytes()
        for batch in common.steps(batches, owner="packing"):
            keys = batch.column("doc_id").to_pylist()
            rows = []
            for key, ids in zip(keys, encoder.encode_all(common.raw_texts(batch))):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * window)):
                    part = ids[at : at + 4 * window]
                    rows.append((key, piece, at // 4, len(part) // 4, zlib.crc32(part), turn))
                    turn += 1
            cols = list(zip(*rows))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield common.columns_to_batch(
                "doc_id,piece,start,length,ids_crc32,turn", *(pa.array(c, k) for c, k in zip(cols, kinds))
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def best_fit(
    lengths: np.ndarray,
    capacity: tuple[float, float, float],
    weights: tuple[float, float, float] = (1.0, 0.0, 0.0),
    rule: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece. Ties go to the bin opened first.

    ``capacity``: tokens, documents and attention cost of a bin. A piece that
    alone breaks a capacity gets a bin of its own.
    """
    limits, scale = np.array(capacity, float), np.array(weights, float)
    order = np.argsort(-lengths, kind="stable")
    left = np.empty((64, 3))  # residuals of open bins
    names = np.empty(64, np.int64)
    n_open = n_bins = 0
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i in order.tolist():
        size = float(lengths[i])
        demand = np.array([size, 1.0, size * size])
        rest = left[:n_open] - demand
        fits = np.flatnonzero(rest.min(axis=1) >= 0) if n_open else ()
        if len(fits):
            if rule == "norm":
                score = (scale * (rest[fits] / limits) ** 2).sum(axis=1)
            else:
                score = -(scale * (demand / limits) * (left[fits] / limits)).sum(axis=1)
            at = int(fits[np.argmin(score)])
        else:
            if n_open == len(left):
                left, names = np.concatenate([left, np.empty_like(left)]), np.concatenate([names, np.empty_like(names)])
            at, n_open = n_open, n_open + 1
            left[at], names[at] = limits, n_bins
            n_bins += 1
        bins[i], offsets[i] = names[at], int(limits[0] - left[at, 0])
        left[at] -= demand
        if left[at].min() <= 0 or left[at, 0] < 1:  # full: it leaves the open ones
            n_open -= 1
            left[at:n_open], names[at:n_open] = left[at + 1 : n_open + 1].copy(), names[at + 1 : n_open + 1].copy()
    return bins, offsets


def pack(
    pieces: DataFrame,
    window: int = WINDOW,
    max_docs: int | None = None,
    max_attention: float | None = None,
    weights: tuple[float, float, float] = (1.0, 0.0, 0.0),
    rule: str = "norm",
) -> DataFrame:
    """Puts the stored ``pieces`` into sequences.

    ``max_docs`` and ``max_attention`` default to values that tokens alone
    imply (one token per document, the square of the window), so that they do
    not bind unless asked for.
    """
    capacity = (float(window), float(max_docs or window), float(max_attention or float(window) ** 2))
    tokens, rows = pieces.agg(F.sum("length"), F.count("*")).first()
    shards = max(1, -(-(tokens or 0) // SHARD_TOKENS), -(-rows // SHARD_PIECES))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece", "turn"], ascending=[False, True, True, True])
        bins, offsets = best_fit(group["length"].to_numpy(np.int64), capacity, weights, rule)
        shard = int(group["shard"].iloc[0])
        group = group.assign(sequence_id=(shard << 32) + bins, offset=offsets)
        return group[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    # Exact copies and null ids spread too: the place in the stored table is part of the key.
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "turn"), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(run, PACKED)


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, window: int = WINDOW, **limits) -> DataFrame:
    """Tokenises, cuts and packs ``docs`` (doc_id, text)."""
    return pack(materialise(cut_pieces(docs, tokenizer_path, window)), window, **limits)
