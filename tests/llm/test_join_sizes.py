"""Tables that an explode or a Python step makes longer are never broadcast, whatever the planner takes them for."""

import pytest
from pyspark.sql import functions as F
from reviewmill.llm import components, simhash, tiles
from reviewmill.session import materialise


@pytest.fixture
def generous(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cells_are_not_broadcast(generous):
    points = materialise(generous.range(50).select(F.xxhash64("id").alias("fp")))
    plan = plan_of(simhash.near_links(points))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_slices_are_not_broadcast(generous):
    edges = materialise(generous.range(1, 50).select(F.col("id").alias("u"), F.lit(0).cast("long").alias("v")))
    plan = plan_of(components._with_least(edges, F.min("v")))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_tables_above_the_counted_size_are_not_broadcast(generous, monkeypatch):
    short = materialise(generous.range(50).select("id", F.col("id").alias("label")))
    rows = materialise(generous.range(80).withColumn("text", F.lit("x")))
    assert "Broadcast" in plan_of(rows.join(tiles.counted(short), "id"))
    monkeypatch.setattr(tiles, "BROADCAST_ROWS", 10)
    assert "Broadcast" not in plan_of(rows.join(tiles.counted(short), "id"))
