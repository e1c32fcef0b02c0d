"""The near-copy stage makes every contraction round of the tiles, and misses no link whatever their number."""

import cases
import pytest
import test_copies
from reviewmill.llm import simhash, tiles


def test_all_rounds_are_made(spark, monkeypatch):
    turns, contract = [], tiles.contract
    monkeypatch.setattr(tiles, "contract", lambda live, sets, labels, turn, *rest: (
        turns.append(turn), contract(live, sets, labels, turn, *rest))[1])
    base = cases.passage(1, 100).split()
    docs = spark.createDataFrame([(0, " ".join(base)), (1, test_copies.edited(base, 1, 1))], "doc_id long, text string")
    assert simhash.one_of_each(docs).count() == 1
    assert turns == list(range(tiles.ROUNDS))


@pytest.mark.parametrize("rounds", [0, 2])
def test_links_do_not_depend_on_rounds(spark, monkeypatch, rounds):
    rows = []
    for k in range(12):
        base = cases.passage(300 + k, 120).split()
        rows += [(20 * k, " ".join(base))] + [(20 * k + e, test_copies.edited(base, 50 * k + e, e)) for e in (1, 2, 3, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    classes = tiles.classes
    monkeypatch.setattr(tiles, "classes", lambda *args, **named: classes(*args, **named | {"rounds": rounds}))
    assert test_copies.kept(simhash.one_of_each(docs)) == test_copies.survivors(rows)
