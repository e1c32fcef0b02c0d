"""Periodic runs, the stratified index and the banded tiles against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import cases
from reviewmill.llm import periods, queries, spans, strata, tiles

SCHEMA = "doc_id long, text string"


def words_of(text):
    return (text or "").encode().split()


# --- periodic runs


def brute_runs(w):
    """Maximal stretches for every period, each named by its least period."""
    out = {}
    for p in range(1, len(w) // 4 + 1):
        i = 0
        while i + p < len(w):
            if w[i] != w[i + p]:
                i += 1
                continue
            start = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            if i + p - start >= max(6, 4 * p):
                out.setdefault((start, i + p), p)
    return sorted(((s, e - s, p) for (s, e), p in out.items()), key=lambda r: (r[0], r[2]))


def runs_row(doc_id, text):
    w, h = words_of(text), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and w:
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    found = brute_runs(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    longest = (None,) * 4 if best is None else (best[0], best[1], best[2], 1000 * best[1] // best[2])
    return (doc_id, len(found), *longest, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def periodic_texts():
    rng, rows = random.Random(5), []
    for k in range(150):
        letters = [f"w{x}" for x in range(rng.randint(1, 5))]
        w = [rng.choice(letters) for _ in range(rng.choice([0, 1, 5, 6, 7, 24, 90, 240]))]
        if rng.random() < 0.6 and len(w) > 3:
            a = rng.randrange(len(w))
            p = 1 + (len(w) - a) // rng.randint(3, 9)
            w[a:] = [w[a + i % p] for i in range(len(w) - a)]
        rows.append((k, "\t ".join(w)))
    return rows


def test_runs_query_on_a_table(spark, tmp_path):
    rows = periodic_texts() + [r[:2] for r in cases.odd_rows()]
    assert sum(zlib.crc32(str(k).encode()) % 10 == 0 for k, _ in rows if k is not None) > 10
    cases.with_clashes(spark.createDataFrame(rows, SCHEMA)).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op11_difference_cover_runs(spark, str(tmp_path))
    assert got.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    ]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((runs_row(*r) for r in rows), key=repr)
    assert periods.find_runs(spark.createDataFrame([], SCHEMA)).collect() == []


def test_runs_query_on_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    short = {r["doc_id"]: runs_row(*r) for r in docs.collect() if len(words_of(r["text"])) < 1500}
    got = {r["doc_id"]: tuple(r) for r in queries.op11_difference_cover_runs(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == 200 and len(short) > 150
    assert {k: got[k] for k in short} == short


def test_extensions_of_all_pairs():
    rng = np.random.default_rng(3)
    for n in (1, 5, 30, 130):
        ids = np.r_[9, rng.integers(0, 2, n), 8].astype(np.int32)
        ids[n // 2 : n] = ids[n // 3]
        i, j = np.triu_indices(len(ids), 1)
        want = []
        for a, b in zip(i, j):
            k = 0
            while b + k < len(ids) and ids[a + k] == ids[b + k]:
                k += 1
            want.append(k)
        assert periods.Extensions(ids).between(i, j).tolist() == want


def test_long_text_in_slices(monkeypatch):
    monkeypatch.setattr(periods, "SLICE", 40)
    monkeypatch.setattr(periods, "PAIRS", 50)
    text = (" ".join(["a b c d"] * 200) + " " + cases.passage(1, 300) + " " + "z " * 50).encode()
    w = text.split()
    names = {x: i for i, x in enumerate(dict.fromkeys(w))}
    found = periods.runs_of([periods._numbers(text, names)])[0]
    assert [tuple(r) for r in found.tolist()] == brute_runs(w)
    gone = {i for s, n, q in found.tolist() for i in range(s + q, s + n)}
    assert periods.collapsed(text, len(w), found) == b" ".join(x for i, x in enumerate(w) if i not in gone)


# --- stratified index

_TERM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_ranks(docs, items, k=10):
    docs = [(d, Counter(_TERM.findall((t or "").encode().lower()))) for d, t in docs]
    docs = [(d, c, c.total()) for d, c in docs if c]
    total, length = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    terms = {}
    for item, text in items:
        terms.setdefault(item, set()).update(_TERM.findall((text or "").encode().lower()))
    out = []
    for item, asked in terms.items():
        scored = []
        for d, c, n in docs:
            m = 10 + 90 * n * total // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in asked if t in c
            )
            if score > 0:
                scored.append((-score, d is not None, d or 0, d))
        for rank, (score, _, _, d) in enumerate(sorted(scored, key=lambda r: r[:3])[:k], 1):
            out.append((item, rank, d, -score))
    return sorted(out, key=repr)


@pytest.mark.parametrize("postings, queries_", [(1 << 18, 256), (64, 2)])
def test_ranks_of_odd_rows(spark, monkeypatch, postings, queries_):
    """Portions of a few documents and blocks of two items give the same rows."""
    monkeypatch.setattr(strata, "POSTINGS", postings)
    monkeypatch.setattr(strata, "QUERIES", queries_)
    rows = [r[:2] for r in cases.odd_rows()]
    rows += [(100 + i, cases.passage(3, 5 + i % 40)) for i in range(150)]  # ties and strata of several documents
    items = [
        ("a", cases.passage(3, 40)), ("b", "spam ONE été"), ("c", None), ("d", ""), ("e", "unheardof"),
        ("f", cases.passage(4, 9)), ("f", "spam"), (None, cases.passage(5, 12)), ("g", cases.passage(2, 25)),
    ]
    docs = cases.with_clashes(spark.createDataFrame(rows, SCHEMA).repartition(3))
    asked = cases.with_clashes(spark.createDataFrame(items, "item_id string, text string"))
    got = sorted((tuple(r) for r in strata.search(docs, asked).collect()), key=repr)
    assert got == brute_ranks(rows, items)
    empty = spark.createDataFrame([], SCHEMA)
    assert strata.search(empty, asked).collect() == []
    assert strata.search(docs, asked.limit(0)).collect() == []


def test_bounds_are_never_below_a_score():
    rng = np.random.default_rng(1)
    block = strata.Block([0, 1], np.arange(30), rng.integers(0, 9000, (30, 2)).astype(np.float64))
    m, size = rng.integers(10, 14, 60), rng.integers(0, 20, 60)
    terms = np.concatenate([rng.choice(40, n, replace=False) for n in size]).astype(np.int64)
    tfs = rng.integers(1, 5, len(terms)).astype(np.int32)
    portion = strata.Portion(block, m, size, terms, tfs)
    highest = portion.highest(block, slice(0, len(portion.norms)))
    ends = np.cumsum(size)
    for d in range(60):
        part = slice(int(ends[d] - size[d]), int(ends[d]))
        known = terms[part] < 30
        scores = strata.impact(tfs[part][known].astype(np.int64), m[d]) @ block.weights[terms[part][known]]
        assert (scores <= highest[np.searchsorted(portion.norms, m[d])]).all()


def test_long_text_in_parts(monkeypatch):
    monkeypatch.setattr(strata.common, "STEP_BYTES", 64)
    text = ("Ab-c, d " * 100).encode()
    parts = list(strata._pieces(text))
    assert len(parts) > 5 and b" ".join(parts).split() == _TERM.findall(text.lower())


def test_weight_beyond_64_bits(spark):
    n = spark.createDataFrame([(10**9,)], "n long").select(strata.normaliser(F.col("n"), 5 * 10**11, 10**14)).first()[0]
    assert n == 10 + 90 * 10**9 * 5 * 10**11 // 10**14


# --- banded tiles


def grams(text):
    w = (text or "").encode().lower().split()
    return frozenset(b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(rows):
    sets, up = [grams(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(rows)), key=repr)


def edited(words, seed, edits):
    rng, words = random.Random(seed), list(words)
    for i in rng.sample(range(len(words)), edits):
        words[i] = f"edit{seed}x{i}"
    return " ".join(words)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


@pytest.mark.parametrize("tile, rounds", [(512, 3), (8, 3), (8, 0)])
def test_components_of_planted_copies(spark, tile, rounds):
    """Pairs on both sides of the limit, a crowd, a chain; small tiles and no contraction change nothing."""
    rows = [r[:2] for r in cases.odd_rows()]
    for k in range(25):
        base = cases.passage(1000 + k, 20 + 6 * k).split()
        rows += [(1000 + 10 * k, " ".join(base))] + [(1000 + 10 * k + e, edited(base, 100 * k + e, e)) for e in (1, 2, 3, 4)]
    crowd = cases.passage(7, 200).split()
    rows += [(5000 + i, edited(crowd, 9000 + i, 1 + i % 6)) for i in range(60)]
    chain = cases.passage(8, 200).split()
    for i in range(12):
        chain = edited(chain, 7000 + i, 3).split()
        rows.append((8000 + i, " ".join(chain)))
    # Sizes at the very limit: 80 of 100 shingles shared, and one fewer.
    line = cases.passage(9, 104).split()
    rows += [(9000, " ".join(line)), (9001, " ".join(line[:84])), (9002, " ".join(line[21:]))]
    docs = cases.with_clashes(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert found(tiles.components(docs, tile=tile, rounds=rounds)) == brute_components(rows)


def test_components_of_nothing(spark):
    assert tiles.components(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, None), (2, ""), (3, "  ")]
    assert found(tiles.components(spark.createDataFrame(rows, SCHEMA))) == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]


def test_bits_bound_the_overlap():
    rng = np.random.default_rng(2)
    for n in (3, 40, 400):
        pool = spans.mix(rng.integers(1, 1 << 60, 2 * n).astype(np.uint64))
        sets = [np.unique(rng.choice(pool, n)) for _ in range(12)]
        size = np.array([len(x) for x in sets])
        for bits in (64, 1024):
            maps = np.stack([tiles.signature(x, bits) for x in sets])
            assert (np.stack([tiles.folded(tiles.signature(x, 4 * bits), bits) for x in sets]) == maps).all()
            for i in range(12):
                wanted = {j for j in range(12) if j != i and tiles.linked(sets[i], sets[j])}
                assert wanted <= set(tiles.open_pairs(size, maps, i, np.flatnonzero(np.arange(12) != i)).tolist())


def test_linked_sets_share_a_tile():
    """Random pairs at and above the limit, of all small sizes: every link has a tile in common."""
    rng = np.random.default_rng(4)
    pool, links = spans.mix(np.arange(1, 5000, dtype=np.uint64)), 0
    for n in [*range(1, 40), 64, 65, 100, 129, 300, 1000]:
        for _ in range(30):
            base = rng.choice(pool, n, replace=False)
            lost = int(rng.integers(0, n // 5 + 1))
            more = rng.choice(pool, int(rng.integers(0, max(n // 4 - lost, 0) + 1)), replace=False)
            a, b = np.unique(base), np.unique(np.r_[base[lost:], more])
            if len(b) and tiles.linked(a, b):
                links += 1
                which, cell = tiles.tiles_of([a, b])
                assert set(cell[which == 0].tolist()) & set(cell[which == 1].tolist()), (n, lost, len(more))
    assert links > 800


def test_set_of_a_long_text_in_parts(monkeypatch):
    text = ("".join(cases.passage(s, 400) + "\n \t" for s in range(5)) + "Tail").encode()
    whole = tiles.shingle_sets([text])[0]
    monkeypatch.setattr(tiles.common, "STEP_BYTES", 700)
    assert np.array_equal(tiles.shingle_sets([text, b"x " * 900])[0], whole)
    assert np.array_equal(tiles._long_set(b"one two", 5), tiles.shingle_sets([b"one two"])[0])
