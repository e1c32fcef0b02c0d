"""Near copies of the pipeline against all pairs."""

import random

import cases
import corpus_pipeline
from reviewmill.llm import simhash
from reviewmill.llm.common import table


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def survivors(rows):
    """Sorted texts of the first row of each component over five-word Jaccard >= 0.8."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    sets, up = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or len(a & b) >= 0.8 * len(a | b):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return sorted(((rows[i][0], rows[i][1]) for i in range(len(rows)) if root(i) == i), key=repr)


def kept(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()), key=repr)


def edited(words, seed, edits):
    rng = random.Random(seed)
    words = list(words)
    for i in rng.sample(range(len(words)), edits):
        words[i] = f"edit{seed}x{i}"
    return " ".join(words)


def test_odd_rows(spark):
    odd = cases.with_clashes(cases.frame(spark, cases.odd_rows()).repartition(3))
    left = simhash.one_of_each(odd)
    assert left.columns == odd.columns
    assert kept(left) == survivors([r[:2] for r in cases.odd_rows()])
    assert simhash.one_of_each(cases.frame(spark, [])).collect() == []


def test_stage_finds_pairs_far_apart_in_fingerprints(spark):
    """The given rows hold pairs of similarity 0.83 whose fingerprints differ in 7 and 11 bits."""
    sf_dir = "/root/testdata/sf0.001"
    docs = table(spark, sf_dir, "documents")
    got = kept(corpus_pipeline.drop_near_copies(spark, docs, sf_dir))
    assert got == survivors([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert not {145, 177} & {doc_id for doc_id, _ in got}


def test_planted_copies(spark):
    """Copies just above and just below the limit, a crowd around one text, and a chain; recall is whole."""
    rows = []
    for k in range(60):
        base = cases.passage(1000 + k, 200).split()
        rows += [(10 * k, " ".join(base))] + [(10 * k + e, edited(base, 100 * k + e, e)) for e in (2, 3, 4, 5)]
    crowd = cases.passage(7, 300).split()
    rows += [(5000 + i, edited(crowd, 9000 + i, 1 + i % 8)) for i in range(120)]
    chain = cases.passage(8, 300).split()
    for i in range(20):
        chain = edited(chain, 7000 + i, 4).split()
        rows.append((8000 + i, " ".join(chain)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert kept(simhash.one_of_each(docs)) == survivors(rows)
