"""Connected components of a link table by rounds of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.session import materialise


#: Tasks that the links of one node may be dealt to.
SLICES = 32


def _with_least(edges: DataFrame, least: Column) -> DataFrame:
    """Adds ``m``, the ``least`` of each node u, to its edges; only slices that a node has are sent to them.

    The hint keeps the slices, of which the planner sees one per node, from being broadcast.
    """
    sliced = edges.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(SLICES)))
    found = sliced.groupBy("u").agg(least.alias("m"), F.collect_set("s").alias("slices"))
    return sliced.join(found.select("u", "m", F.explode("slices").alias("s")).hint("merge"), ["u", "s"])


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b long): root is the least node of its component.

    A round is a large-star step (each node hands its larger neighbours to the
    least node it knows) and a small-star step (likewise for the smaller ones).
    Both are a ``min`` aggregate and an equi-join. The join is on (node, slice of its
    links), so the links of one node lie in up to ``SLICES`` tasks. Rounds
    grow with the logarithm of the number of nodes. Each round is a stored table.
    """
    edges = materialise(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .filter("u <> v").distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, F.least(F.min("v"), F.col("u"))).filter("v > u")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        small = _with_least(large, F.min("v"))
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").unionByName(
            large.groupBy("u").agg(F.min("v").alias("v"))
        )
        after = materialise(small.distinct())
        # Stars only: nobody is both a leaf and a centre, and no leaf has two centres.
        centres = after.select(F.col("v").alias("u")).distinct()
        tangled = after.join(centres, "u", "left_semi").limit(1).count()
        if not tangled and not after.groupBy("u").count().filter("count > 1").limit(1).count():
            break
        edges = after
    return after.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        after.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
