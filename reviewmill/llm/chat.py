"""Chat formatting with offset-aligned loss masks.

A turn is ``<s>role[INST]text[/INST]</s>``. Roles and texts are escaped so that no
control string of the template can occur in them: a backslash is doubled, and a
control string gets a backslash after its first character. Dropping the backslash of each
pair undoes both. A whole conversation is rendered, then encoded once with
character offsets; the control strings are tokens of their own, so a token never crosses the
border of a text. The loss mask is the intersection of the sorted spans of assistant
texts with the token spans, found by binary search.

Rows of a conversation come sorted by turn into one task and are worked off as a stream:
a very long conversation is rendered and encoded in parts that end at turn borders (where
a token ends anyway), each an output row, so memory stays bounded whatever the number of turns.

Defined cases: a null text or role counts as empty; rows with a null conv_id are one
conversation of their own; rows with equal turn are ordered by role, then text; repeated rows
are turns of their own; an empty text of an assistant adds nothing to the mask; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, TEXT, STOP, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
CONTROLS = (OPEN, TEXT, STOP, CLOSE)
#: The first escape that applies at a place: a backslash, or a control string.
_ESCAPE = re.compile(r"\\|<(?=/?s>)|\[(?=/?INST\])")
_TURN = re.compile(r"<s>(.*?)\[INST\](.*?)\[/INST\]</s>", re.DOTALL)
#: Characters after which an output row ends at the next turn border.
PART_CHARS = 1 << 20
PARTS = (
    "conv_id long, part int, formatted string, ids array<int>, starts array<int>, ends array<int>, "
    "loss_mask array<boolean>"
)


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m.group() + "\\", text)


def unescape(text: str) -> str:
    return re.sub(r"(.)\\", r"\1", text, flags=re.DOTALL) if "\\" in text else text


def render(turns: list[tuple[str, str]]) -> tuple[str, list[int], list[int]]:
    """The formatted string and the sorted spans of the assistant texts in it."""
    out, at, starts, ends = [], 0, [], []
    for role, text in turns:
        head, body = f"{OPEN}{escape(role)}{TEXT}", escape(text)
        out += (head, body, STOP, CLOSE)
        at += len(head)
        if role == "assistant" and body:
            starts.append(at)
            ends.append(at + len(body))
        at += len(body) + len(STOP) + len(CLOSE)
    return "".join(out), starts, ends


def loss_mask(starts: np.ndarray, ends: np.ndarray, spans_from: list[int], spans_to: list[int]) -> np.ndarray:
    """Which tokens (starts, ends) intersect one of the sorted, disjoint spans."""
    if not spans_from:
        return np.zeros(len(starts), bool)
    # The last span that starts before the token ends is the only one that may reach it first.
    last = np.searchsorted(np.asarray(spans_from), ends, side="left") - 1
    return (last >= 0) & (np.asarray(spans_to)[np.maximum(last, 0)] > starts)


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import AddedToken, Tokenizer, processors

    found = Tokenizer.from_file(path)
    # Only the template's own strings are control tokens; the vocabulary's special token is ordinary text here.
    found.encode_special_tokens = True
    found.add_tokens([AddedToken(x, normalized=False, special=False) for x in CONTROLS])
    found.post_processor = processors.ByteLevel(trim_offsets=False)
    return found


def _sorted_rows(df: DataFrame, *order: str) -> Iterator:
    return df.repartition(F.col(order[0])).sortWithinPartitions(*order)


def _streams(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[bool, object, dict]]:
    """(new conversation?, key, row) in order of the rows."""
    last, any_before = None, False
    for batch in batches:
        columns = {c: batch.column(c).to_pylist() for c in batch.schema.names}
        for i, k in enumerate(columns[key]):
            yield not any_before or k != last, k, {c: v[i] for c, v in columns.items()}
            last, any_before = k, True


def format_conversations(conversations: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """(conv_id, part, formatted, ids, starts, ends, loss_mask): parts of each conversation in order."""
    path = tokenizer_path or public_tokenizers.path("byte_bpe_50k.json")

    def row(conv: int | None, part: int, turns: list[tuple[str, str]]) -> tuple:
        text, spans_from, spans_to = render(turns)
        encoded = _tokenizer(path).encode(text, add_special_tokens=False)
        offsets = np.array(encoded.offsets, np.int64).reshape(-1, 2)
        mask = loss_mask(offsets[:, 0], offsets[:, 1], spans_from, spans_to)
        return conv, part, text, encoded.ids, offsets[:, 0], offsets[:, 1], mask

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, part, turns, size, done, held = None, 0, [], 0, [], 0
        for new, key, r in _streams(batches, "conv_id"):
            if turns and (new or size >= PART_CHARS):
                done.append(row(conv, part, turns))
                held, part, turns, size = held + size, part + 1, [], 0
                if held >= 4 * PART_CHARS:
                    yield _batch(done)
                    done, held = [], 0
            if new:
                conv, part = key, 0
            turns.append((r["role"] or "", r["text"] or ""))
            size += len(turns[-1][1])
        if turns:
            done.append(row(conv, part, turns))
        if done:
            yield _batch(done)

    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    return _sorted_rows(rows, "conv_id", "turn", "role", "text").mapInArrow(run, PARTS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    ints = pa.list_(pa.int32())
    kinds = (pa.int64(), pa.int32(), pa.string(), ints, ints, ints, pa.list_(pa.bool_()))
    names = ["conv_id", "part", "formatted", "ids", "starts", "ends", "loss_mask"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted string."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def read_loss_text(formatted: str, starts: list[int], ends: list[int], mask: list[bool]) -> str:
    """The text under the loss mask. Tokens of one character's bytes overlap, so each character counts once."""
    out, reach = [], 0
    for a, b, wanted in zip(starts, ends, mask):
        if wanted and b > reach:
            out.append(formatted[max(a, reach) : b])
            reach = b
    return unescape("".join(out))


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def digest(formatted: DataFrame) -> DataFrame:
    """What can be read back from the formatted parts, one row per conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        conv, n, turns, chars, loss, size = None, 0, None, 0, None, 0
        for new, key, r in _streams(batches, "conv_id"):
            if new:
                if turns is not None:
                    done.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), size))
                if len(done) >= 5000:
                    yield _digest_batch(done)
                    done = []
                conv, n, turns, chars, loss, size = key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0
            for role, text in read_turns(r["formatted"]):
                n += 1
                turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            under = read_loss_text(r["formatted"], r["starts"], r["ends"], r["loss_mask"])
            chars += len(under)
            loss.update(under.encode("utf-8", "surrogatepass"))
            size += len(r["formatted"])
        if turns is not None:
            done.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), size))
        if done:
            yield _digest_batch(done)

    parts = formatted.select("conv_id", "part", "formatted", "starts", "ends", "loss_mask")
    return _sorted_rows(parts, "conv_id", "part").mapInArrow(run, DIGESTS)


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
