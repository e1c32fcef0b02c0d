"""Document operators against plain versions, on odd tables and on the given ones."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
import cases
from reviewmill.llm import packing, queries, quality, simhash, suffixes, toxicity, windows, winnowing
from reviewmill.llm import langid
from reviewmill.llm.common import table

SF_DIR = "/root/testdata/sf0.001"
SMALL_SKETCH = 16


def sorted_rows(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def odd(spark):
    return cases.with_clashes(cases.frame(spark, cases.odd_rows()).repartition(3))


@pytest.fixture(scope="module")
def empty(spark):
    return cases.frame(spark, [])


@pytest.fixture(scope="module")
def documents(spark):
    return table(spark, SF_DIR, "documents")


@pytest.mark.parametrize("bits", [SMALL_SKETCH, 8])
def test_windows_on_odd_rows(odd, bits):
    """A sketch of 256 counters is full of false alarms; the result is the same."""
    got = windows.removal(odd, bits=bits).collect()
    assert sorted_rows(got) == sorted_rows(brute.windows(pairs(odd)))


@pytest.mark.parametrize("bits", [SMALL_SKETCH, 8])
def test_strings_on_odd_rows(odd, bits):
    got = suffixes.removal(odd, bits=bits).collect()
    assert sorted_rows(got) == sorted_rows(brute.strings(pairs(odd)))


def test_strings_on_documents(documents):
    got = suffixes.removal(documents, bits=SMALL_SKETCH).collect()
    assert sorted_rows(got) == sorted_rows(brute.strings(pairs(documents)))


def test_strings_with_crowded_leading_tokens(spark):
    """One passage in most documents, between texts that differ: its suffixes fill more than a range."""
    shared = cases.passage(50, 45)
    rows = [(i, f"{cases.passage(100 + i, 12)} {shared} {cases.passage(900 + i, 12)}", None, None, None)
            for i in range(240)]
    docs = cases.frame(spark, rows).repartition(4)
    merged = windows.sketch_of(suffixes.with_key(docs), suffixes._grams, SMALL_SKETCH)
    cuts, crowded = suffixes._splitters(suffixes.with_key(docs), merged, SMALL_SKETCH)
    assert isinstance(crowded, set)
    # Treat every leading token that is a splitter as crowded too: the same strings must go.
    expected = sorted_rows(brute.strings([r[:2] for r in rows]))
    assert sorted_rows(suffixes.removal(docs, bits=SMALL_SKETCH).collect()) == expected
    keyed = suffixes.with_key(docs.select("doc_id", "text"))
    every = {bytes(x).ljust(suffixes.GRAM, b"\0") for x in cuts.tolist()} or {shared.encode()[: suffixes.GRAM]}
    rows_by_value = suffixes._rows(keyed, merged, cuts, every, SMALL_SKETCH)
    kinds = {r["kind"] for r in rows_by_value.select("kind").distinct().collect()}
    assert 1 in kinds or not len(cuts)


def test_multikey_quicksort_orders_rows():
    rng = np.random.default_rng(5)
    raw = rng.integers(0, 3, (20_000, 24), dtype=np.uint8)
    raw[:9000] = raw[0]
    order = suffixes.multikey_quicksort(suffixes.tokens_of(raw))
    got = [bytes(r) for r in raw[order]]
    assert got == sorted(bytes(r) for r in raw)
    assert sorted(order.tolist()) == list(range(len(raw)))


def test_removed_text_of_the_pipeline_stage(odd):
    columns = odd.columns
    got = windows.remove_repeats(odd, bits=SMALL_SKETCH)
    assert got.columns == columns
    want = {}
    for doc_id, n, removed, digest in brute.windows(pairs(odd)):
        want.setdefault(doc_id, []).append((n, removed))
    kept = {}
    for r in got.collect():
        kept.setdefault(r["doc_id"], []).append(r)
    # Documents that lose nothing keep their text, those that lose all words go.
    lost_all = sum(n > 0 and n == removed for rows in want.values() for n, removed in rows)
    assert sum(map(len, kept.values())) == len(cases.odd_rows()) - lost_all
    assert kept[3][0]["text"] == [r for r in cases.odd_rows() if r[0] == 3][0][1]
    assert kept[2][0]["n_chars"] == len(kept[2][0]["text"]) if want[2][0][1] else True


def benchmark_rows():
    shared = cases.passage(1, 60)
    return [
        (1, shared), (2, shared), (2, shared), (None, cases.passage(3, 50)), (4, ""), (5, None), (6, "Spam,SPAM"),
        (7, "one"), (8, cases.passage(99, 40)), (10, "日本語 x"), (11, cases.passage(2, 25).upper().replace(" ", " -- ")),
    ]


def test_leaks_on_odd_rows(spark, odd):
    items = spark.createDataFrame(benchmark_rows(), "item_id long, text string")
    got = winnowing.contamination(odd, items).collect()
    assert sorted_rows(got) == sorted_rows(brute.leaks(pairs(odd), benchmark_rows()))
    left = winnowing.drop_contaminated(odd, items)
    assert left.columns == odd.columns
    clean = [r[0] for r in brute.leaks(pairs(odd), benchmark_rows()) if not r[4]]
    assert sorted([r["doc_id"] for r in left.collect()], key=repr) == sorted(clean, key=repr)


def test_leaks_with_an_empty_benchmark(spark, odd):
    items = spark.createDataFrame([], "item_id long, text string")
    assert not winnowing.contamination(odd, items).filter("contaminated").count()


def test_near_copies_on_odd_rows(odd):
    got = simhash.components(odd).select("doc_id", simhash.hex_of(F.col("fp")).alias("fp"), "component_id").collect()
    assert sorted_rows(got) == sorted_rows(brute.near_copies(pairs(odd)))
    left = simhash.one_of_each(odd)
    assert left.columns == odd.columns
    assert left.count() == len({f for f in brute.near_components(
        {brute.fingerprint(t) for _, t in pairs(odd)}).values()})


@pytest.mark.parametrize("tile", [2048, 7])
def test_near_links_of_crowded_cells(spark, tile):
    """Many prints within a few bits of each other, and chains that only hold through others."""
    rng = random.Random(7)
    points = {rng.getrandbits(64) for _ in range(300)}
    for centre in list(points)[:4]:
        points |= {centre ^ (1 << a) ^ (1 << b) for a in range(0, 40, 3) for b in range(1, 40, 5)}
    chain = rng.getrandbits(64)
    for k in range(20):
        chain ^= 0b111 << (3 * k)
        points.add(chain)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in points]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), tile=tile).collect()
    assert all(((r["a"] ^ r["b"]) & (1 << 64) - 1).bit_count() <= 3 for r in links)
    up = {p: p for p in points}

    def root(p):
        while up[p] != p:
            p = up[p]
        return p

    for r in links:
        a, b = root(r["a"] % (1 << 64)), root(r["b"] % (1 << 64))
        up[max(a, b)] = min(a, b)
    assert {p: root(p) for p in points} == brute.near_components(points)


def test_packing_is_whole_and_gapless(documents, odd):
    import public_tokenizers
    import zlib
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    special = cases.frame(odd.sparkSession, [
        (n, text, None, None, None)
        for n, text in enumerate(["a <|endoftext|> b", "<|startoftext|>", "É<|endoftext|><|endoftext|>É <|ENDOFTEXT|>", "<|end oftext|>"])
    ])
    for docs in (documents, odd, special):
        want = []
        for doc_id, text in pairs(docs):
            ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
            for piece, at in enumerate(range(0, len(ids), 4096)):
                part = np.array(ids[at : at + 4096], "<u4").tobytes()
                want.append((doc_id, piece, at, len(part) // 4, zlib.crc32(part)))
        rows = packing.pack_documents(docs).collect()
        assert sorted_rows([tuple(r)[:5] for r in rows]) == sorted_rows(want)
        bins = {}
        for r in rows:
            bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for spans in bins.values():
            spans.sort()
            assert [s[0] for s in spans] == [sum(x[1] for x in spans[:i]) for i in range(len(spans))]
            assert sum(s[1] for s in spans) <= 4096
        assert len(bins) <= math.ceil(1.01 * sum(w[3] for w in want) / 4096) + 1


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_keeps_every_capacity(rule):
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 400, 500)
    bins, offsets = packing.best_fit(lengths, (1000.0, 6.0, 300_000.0), (1.0, 0.3, 0.3), rule)
    for b in np.unique(bins):
        inside = lengths[bins == b]
        assert inside.sum() <= 1000 and len(inside) <= 6 and (inside**2).sum() <= 300_000
        starts = np.sort(offsets[bins == b])
        assert starts[0] == 0 and len(np.unique(starts)) == len(starts)


def test_ends_of_words_are_learnt_once(monkeypatch):
    """Punctuation behind letters brings no spelling of its own to the tokenizer, and no id changes."""
    import public_tokenizers

    ends = [".", ",", ".&&&", "!?", "...", ");", "'", "'s", "|", ".|", "~~", "_", "\u00b2.", "\u0301.", "<|endoftext|>"]
    stems = ["word", "\u00c9t\u00e9", "\u0391\u03a3", "\u00df", "x9", "9", "", "-a"]
    texts = [" ".join(s + e for s in stems for e in ends), *(s + e + "  " + e + s for s in stems for e in ends)]
    encoder = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    plain = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    got = [np.frombuffer(encoder.encode_all([t.encode()])[0], "<u4").tolist() for t in texts]
    assert got == [e.ids for e in plain]
    asked = []
    fresh = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    tell = fresh._plain
    monkeypatch.setattr(fresh, "_plain", lambda text: asked.extend(text.split(" | ")) or tell(text))
    fresh.encode_all([b"word. word, word! word.&&& word); word"])
    assert sorted(asked) == sorted(["word", ".", ",", "!", ".&&&", ");"])


def test_memo_limit_does_not_change_ids(monkeypatch):
    import public_tokenizers

    texts = [cases.passage(s, 80).encode() + " | a|b isn't “x” \u00a0y a,b., c., d.. 's. |. a|. ²., Ⅷ, ʰ. İ. ΑΣ. ß, K. é. e\u0301. \u0301. J\u030C T\u0308 <|endoftext|>.".encode()
             for s in range(12)]
    whole = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json")).encode_all(texts)
    monkeypatch.setattr(packing, "MEMO_ENTRIES", 20)
    small = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))  # its halves turn over with every text
    assert [small.encode_all([t])[0] for t in texts] == whole
    plain = small.tokenizer.encode_batch([t.decode() for t in texts], add_special_tokens=False)
    assert [np.frombuffer(x, "<u4").tolist() for x in whole] == [e.ids for e in plain]


def test_classifiers_take_odd_rows(spark, odd, documents):
    labels = table(spark, SF_DIR, "labels")
    for module, model in ((toxicity, toxicity.fit(documents, labels)), (quality, quality.fit(documents, labels))):
        rows = module.score(odd, model).collect()
        assert len(rows) == odd.count()
        assert all(0 <= r["score"] <= 1 for r in rows)
    found = {r["doc_id"]: r for r in langid.predict(odd, langid.fit(documents, sample=40, rounds=2)).collect()}
    assert {found[k]["lang_pred"] for k in (5, 6, 7)} == {"und"} and found[5]["score"] == 0
    assert all(r["lang_pred"] != "und" for k, r in found.items() if k in (1, 2, 9, 13))


def test_classifiers_without_labels(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd_labels = spark.createDataFrame(
        [(None, 1, 1), (1, None, None), (2, 1, 0), (2, 1, 0), (99, 1, 1)], "doc_id long, quality int, toxic int"
    )
    for labels in (none, odd_labels):
        assert toxicity.score(odd, toxicity.fit(odd, labels)).count() == odd.count()
        assert quality.score(odd, quality.fit(odd, labels)).count() == odd.count()
    unknown = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.predict(odd, langid.fit(unknown, rounds=1)).collect()} == {"und"}


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame(benchmark_rows(), "item_id long, text string")
    for df in (
        windows.removal(empty, bits=SMALL_SKETCH), suffixes.removal(empty, bits=SMALL_SKETCH),
        winnowing.contamination(empty, items), simhash.components(empty), packing.pack_documents(empty),
        toxicity.score(empty, toxicity.fit(empty, labels)), quality.score(empty, quality.fit(empty, labels)),
        langid.predict(empty, langid.fit(empty, rounds=1)),
        windows.remove_repeats(empty, bits=SMALL_SKETCH), simhash.one_of_each(empty),
        winnowing.drop_contaminated(empty, items), toxicity.drop_toxic(empty, toxicity.fit(empty, labels)),
    ):
        assert df.collect() == []


def test_forward_sums_all_segmentations():
    model = langid.Model(["x", "y"], {"▁": (0.1, 0.2), "▁a": (0.2, 0.1), "a": (0.3, 0.1), "ab": (0.1, 0.3), "b": (0.2, 0.2)})
    ways = [("▁", "a", "b"), ("▁a", "b"), ("▁", "ab")]
    want = [sum(math.prod(model.table[p][i] for p in way) for way in ways) for i in range(2)]
    assert [math.exp(x) for x in model.log_word("ab")] == pytest.approx(want)
    counts = dict.fromkeys(model.table, 0.0)
    for piece, part in langid.expected_pieces("ab", {k: v[0] for k, v in model.table.items()}):
        counts[piece] += part
    assert counts["ab"] == pytest.approx(0.1 * 0.1 / want[0])
    words = ["ab", "ba", "aXb", "abab", "", "b" * 39, "a" * 41]
    assert langid.Scorer(model).log_words(words) == pytest.approx(np.array([model.log_word(w) for w in words]))
    long = model.log_word("ab" * 20_000)
    assert all(math.isfinite(x) and x < -1000 for x in long)


def held_out(df, labels, column):
    joined = df.join(labels, "doc_id").filter("held_out")
    return joined.agg(F.avg((F.col(column[0]) == F.col(column[1])).cast("double"))).first()[0]


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = table(spark, sf_dir, "labels")
    assert held_out(queries.op1_weak_toxicity(spark, sf_dir), labels, ("predicted", "toxic")) > 0.97
    assert held_out(queries.op7_additive_quality(spark, sf_dir), labels, ("predicted", "quality")) > 0.97
    sf_dir = "/root/testdata/sf0.01"
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    assert held_out(queries.op2_marginal_unigrams(spark, sf_dir), docs, ("lang_pred", "lang")) > 0.98
