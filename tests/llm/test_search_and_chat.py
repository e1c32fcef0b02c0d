"""Top-k search and chat formatting against plain versions, and the pipeline against its stages' plain versions."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
import cases
from test_copies import survivors
import corpus_pipeline
from reviewmill.llm import chat, maxscore, queries, toxicity
from reviewmill.llm.common import table

SF_DIR = "/root/testdata/sf0.001"


def top_k(rows, k, step):
    usable = [
        (i, [math.floor(64 * x) for x in v]) for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in usable:
        if q % step:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q and len(a) == len(b))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def vectors(n, width, seed, copies=0):
    rng = np.random.default_rng(seed)
    x = (rng.normal(size=(n, width)) * rng.gamma(0.5, 1, size=(1, width))).astype(np.float32)
    if copies:
        x[rng.choice(n, copies, replace=False)] = x[0]
    return [(int(i), [float(v) for v in row]) for i, row in enumerate(x)]


@pytest.mark.parametrize("shard_rows", [40, 8192])
def test_top_k_is_exact(spark, shard_rows):
    rows = vectors(600, 12, 1, copies=200)
    rows += [(1000, None), (1001, []), (1002, [float("nan")] * 12), (1003, [float("inf")] * 12), (1004, [None] * 12),
             (None, [1.0] * 12), (1020, [1.0, 2.0]), (1021, [2.0, 1.0]), (1040, [0.0] * 12), (1041, [-0.0] * 12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    got = maxscore.top_k(df, 7, 20, shard_rows=shard_rows).collect()
    assert sorted(tuple(r) for r in got) == top_k(rows, 7, 20)


def test_top_k_prunes_without_loss():
    """Few heavy dimensions: most vectors never become candidates, and the result is that of a full scan."""
    rng = np.random.default_rng(2)
    x = np.zeros((5000, 16), np.int64)
    x[:, 0] = rng.pareto(1.2, 5000) * 50
    x[:, 1:] = rng.integers(-2, 3, (5000, 15))
    shard = maxscore.Shard(x, np.arange(5000))
    for q in range(0, 60, 7):
        floor = maxscore._seed_floor(shard, x[q], 10, q)
        ids, scores = shard.top(x[q], 10, floor, q)
        full = x @ x[q]
        want = [i for i in np.lexsort((np.arange(5000), -full)).tolist() if i != q][:10]
        assert ids.tolist() == want and scores.tolist() == full[want].tolist()


def test_top_k_of_few_or_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert maxscore.top_k(empty).collect() == []
    alone = spark.createDataFrame([(0, [1.0]), (0, [2.0]), (3, [1.0])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in maxscore.top_k(alone).collect()) == [(0, 1, 3, 8192), (0, 2, 3, 4096)]


texts = st.text(alphabet=st.sampled_from(list("<>/[]\\sINSTab \n\té日")), max_size=40) | st.lists(
    st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "/", "s>", "INST]"]), max_size=8
).map("".join)


@given(texts)
@settings(max_examples=400, deadline=None)
def test_escaping_is_reversible_and_hides_controls(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text
    assert not any(c in hidden for c in chat.CONTROLS)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "<s>"]), texts), max_size=5))
@settings(max_examples=60, deadline=None)
def test_rendered_turns_come_back(turns):
    import public_tokenizers

    text, starts, ends = chat.render(turns)
    assert chat.read_turns(text) == turns
    encoded = chat._tokenizer(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False)
    offsets = np.array(encoded.offsets).reshape(-1, 2)
    mask = chat.loss_mask(offsets[:, 0], offsets[:, 1], starts, ends)
    under = chat.read_loss_text(text, offsets[:, 0].tolist(), offsets[:, 1].tolist(), mask.tolist())
    assert under == "".join(t for role, t in turns if role == "assistant")


def conversation_rows():
    return [
        (1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] x\\ [/INST]"), (1, 2, "assistant", ""), (2, 0, None, None),
        (None, 0, "user", "a"), (None, 1, "assistant", "b"), (3, 1, "assistant", "second"), (3, 0, "user", "first"),
        (3, 1, "assistant", "second"), (4, None, "assistant", "no turn"), (5, 0, "assistant", "日本語 é  <|endoftext|>"),
        (6, 0, "user", "q"), *[(6, i, "assistant", cases.passage(i, 300)) for i in range(1, 40)],
    ]


def test_conversations_are_read_back(spark, monkeypatch):
    rows = conversation_rows()
    want = []
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: tuple((x is not None, x or "") if k > 1 else (x is not None, x or 0) for k, x in enumerate(r)))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        want.append((conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit("x"))
    formatted = chat.format_conversations(df)
    got = chat.digest(formatted).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    for r in formatted.collect():
        assert len(r["ids"]) == len(r["loss_mask"]) == len(r["starts"]) == len(r["ends"])
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digest(chat.format_conversations(empty)).collect() == []


def test_pipeline_stages_follow_from_each_other(spark):
    docs = table(spark, SF_DIR, "documents")
    items = [(r["item_id"], r["text"]) for r in table(spark, SF_DIR, "benchmark").collect()]
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = toxicity.fit(docs, table(spark, SF_DIR, "labels"))
    toxic = {r["doc_id"] for r in toxicity.score(docs, model).filter("predicted = 1").collect()}
    kept = {k: t for k, t in kept.items() if k not in toxic}
    kept = dict(survivors(list(kept.items())))
    lost = {r[0]: r for r in brute.windows(kept.items())}
    stages = corpus_pipeline.STAGES
    assert [name for name, _ in stages] == ["toxicity", "near_copies", "repeated_windows", "benchmark", "pack"]
    frame = docs
    for name, stage in stages[:3]:
        frame = stage(spark, frame, SF_DIR)
        assert frame.columns == docs.columns
    texts_now = {r["doc_id"]: r["text"] for r in frame.collect()}
    assert set(texts_now) == {k for k, r in lost.items() if not r[1] or r[2] < r[1]}
    for k, text in texts_now.items():
        words = text.encode().split()
        assert hashlib.sha256(b" ".join(words)).hexdigest() == lost[k][3]
        if not lost[k][2]:
            assert text == kept[k]
    clean = {r[0] for r in brute.leaks(texts_now.items(), items) if not r[4]}
    packed = corpus_pipeline.run(spark, SF_DIR)
    assert {r["doc_id"] for r in packed.collect()} == clean


def test_every_operator_is_registered():
    names = queries.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(queries.oracles()) <= set(names)
