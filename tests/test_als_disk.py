"""ALS leaves no more than one iteration's shuffle files behind, and cuts large inputs into more blocks."""

from pyspark.sql import functions as F
from reviewmill.operators import factors


def test_every_iteration_is_checkpointed(spark, monkeypatch):
    made, als = [], factors._als
    monkeypatch.setattr(factors, "_als", lambda *args, **named: made.append(als(*args, **named)) or made[-1])
    rows = [(f"U{n % 7}", f"I{n % 11}", float(1 + n % 5)) for n in range(77)]
    indexed = factors.index_ratings(spark.createDataFrame(rows, "reviewerID string, asin string, overall double"))

    def shuffles():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = (found.apply(n).getName() for n in range(found.size()))
        return {n.split("_")[1] for n in names if n.startswith("shuffle_")}

    before = shuffles()
    model = factors.train_als(indexed, rank=2, iters=6)
    assert made[0].getCheckpointInterval() == 1
    # Two shuffles an iteration; the last one's and those that build the blocks stay.
    assert len(shuffles() - before) < 12
    monkeypatch.setattr(factors, "_als", lambda *args, **named: als(*args, **named | {"checkpoint": 10}))
    plain = factors.train_als(indexed, rank=2, iters=6)
    for mine, other, key in ((model.users, plain.users, "user"), (model.items, plain.items, "item")):
        assert mine.orderBy(key).collect() == other.orderBy(key).collect()


def test_blocks_grow_with_the_ratings(spark, monkeypatch):
    assert factors.als_blocks(0) == factors.als_blocks(40_000_000) == 10
    assert factors.als_blocks(216_000_000) == 54
    monkeypatch.setattr(factors, "BLOCK_RATINGS", 5)
    rows = [(f"U{n % 7}", f"I{n % 11}", float(1 + n % 5)) for n in range(77)]
    indexed = factors.index_ratings(spark.createDataFrame(rows, "reviewerID string, asin string, overall double"))
    model = factors.train_als(indexed, rank=2, iters=3)
    assert model.als.getBlockSize() and model.users.count() == 7 and model.items.filter(F.size("vec") == 2).count() == 11
