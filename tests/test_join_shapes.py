"""A statistics table is broadcast only below its counted size; the rows do not depend on it."""

from pyspark.sql import functions as F

from reviewmill.operators import experiments
from reviewmill.operators.joins import attach_stats


def test_broadcast_follows_the_counted_size(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "z")], "x long, k string")
    stats = spark.createDataFrame([("a", 10), ("b", 20), (None, 30)], "k string, n long")

    def plan(frame):
        return frame._jdf.queryExecution().optimizedPlan().toString()

    small, large = (attach_stats(df, stats, "k", null_safe=True, broadcast_rows=most) for most in (3, 2))
    assert "strategy=broadcast" in plan(small) and "strategy=broadcast" not in plan(large)
    want = [(1, "a", 10), (2, "b", 20), (3, None, 30), (4, "z", None)]
    for frame in (small, large):
        assert sorted(tuple(r) for r in frame.collect()) == want
    plain = attach_stats(df, stats, "k", broadcast_rows=3).select("x", "n")
    assert sorted((tuple(r) for r in plain.collect()), key=repr) == [(1, 10), (2, 20), (3, None), (4, None)]


def test_summary_lists_each_metric_once(spark):
    rows = [(f"u{i}", "A" if i % 3 else "B", f"m{i % 4}", 1.0) for i in range(24)] + [("u0", "B", "m1", 1.0)]
    metrics = spark.createDataFrame(rows, "user_id string, group string, metric string, value double")
    got = experiments.test_summary(metrics, "t", 0.3).first()
    assert (got.total_assignments, got.group_a_count, got.group_b_count) == (24, 16, 8)
    assert (got.metrics_tracked, got.traffic_split) == ("m0,m1,m2,m3", 0.3)
    empty = experiments.test_summary(metrics.filter(F.lit(False)), "t").first()
    assert (empty.total_assignments, empty.metrics_tracked) == (0, "")
