"""Crowds of texts that are nearly, but not quite, alike: rows per text, not per pair."""

import numpy as np
from pyspark.sql import functions as F

from reviewmill.llm import tiles


def _crowd(spark, alike: int, own: int, links: int):
    """``alike`` sets of 900 common and ``own`` numbers of their own, ``links`` more that add 20 to the first; all in two tiles."""
    rng = np.random.default_rng(11)
    common_ = rng.integers(0, 2**63, 900, dtype=np.uint64)
    sets = [np.unique(np.r_[common_, rng.integers(0, 2**63, own, dtype=np.uint64)]) for _ in range(alike)]
    sets += [np.unique(np.r_[sets[0], rng.integers(0, 2**63, 20, dtype=np.uint64)]) for _ in range(links)]
    rows = spark.createDataFrame([(k, x.tobytes()) for k, x in enumerate(sets)], "node long, grams binary")
    live = rows.select(F.explode(F.expr("array(1L, 2L)")).alias("cell"), "node")
    return live, rows, rows.select("node", F.col("node").alias("label"))


def test_crowd_without_links_has_a_row_per_text(spark):
    live, sets, labels = _crowd(spark, 60, 150, 0)
    assert tiles.candidates(live, sets, labels).count() <= 60
    assert tiles.roots(live, sets, rounds=0).count() == 0


def test_links_in_a_split_crowd(spark):
    live, sets, _ = _crowd(spark, 40, 150, 3)
    for tile in (512, 8):
        got = {r.node: r.root for r in tiles.roots(live, sets, rounds=0, tile=tile).collect()}
        assert got == {0: 0, 40: 0, 41: 0, 42: 0}
