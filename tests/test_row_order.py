"""Statistics that must not depend on how rows are dealt to tasks."""

from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import functions as F

from reviewmill.functions import scores
from reviewmill.operators import enrich, features, selection, validate


def _uneven(spark):
    """Constant 1.0 next to a varying column; merged over 33 tasks its plain deviation is 1e-16, not 0."""
    one = F.when(F.col("id") >= 0, 1.0).alias("constant")
    return spark.range(0, 6_000_000, 1, 33).select(one, (F.col("id") % 7).cast("double").alias("x"),
                                                   (F.col("id") % 3).cast("double").alias("label"))


def test_constant_column_has_no_correlation(spark):
    df = _uneven(spark)
    got = {(r.x, r.y): r.correlation for r in validate.correlation_matrix(df, ["constant", "x"]).collect()}
    assert got["constant", "x"] is got["x", "constant"] is got["constant", "constant"] is None
    assert abs(got["x", "x"] - 1) < 1e-12


def test_constant_column_has_no_scores(spark):
    df = _uneven(spark)
    assert {r.z for r in enrich.zscore(df, "constant", "z").select("z").distinct().collect()} == {None}
    assert {r.feature: r.f_score for r in selection.anova_scores(df, ["constant"], "label").collect()} == {"constant": None}
    assert [r.variance for r in selection.variance_scores(df, ["constant"]).collect()] == [0.0]


def test_spread_on_the_limit_is_on_the_limit(spark):
    rng, rows = np.random.default_rng(3), []
    for n in range(4, 13):
        for values in combinations_with_replacement(range(1, 6), n):
            if 4 * (n * sum(v * v for v in values) - sum(values) ** 2) == 9 * n * (n - 1):
                rows += [(len(rows) // n * 100 + n, float(v)) for v in rng.permutation(values)]
    df = spark.createDataFrame(rows, "key long, overall double")
    spreads = df.groupBy("key").agg(scores.rating_spread(F.col("overall")).alias("s"))
    level = features.rating_confidence(F.col("s"), F.lit(0.0))
    exact = df.groupBy("key").agg((4 * (F.count("*") * F.sum(F.pow("overall", F.lit(2))) - F.pow(F.sum("overall"), F.lit(2)))
                                   == 9 * F.count("*") * (F.count("*") - 1)).alias("on")).filter("on")
    got = spreads.join(exact, "key").select("s", level.alias("level")).distinct().collect()
    assert [(r.s, r.level) for r in got] == [(1.5, 0.7)]


def test_equal_values_have_equal_means(spark):
    cents = [29.27, 122.79, 2.11, 0.1, 33.33, 7.07, 250.01]
    rng = np.random.default_rng(5)
    rows = [(k, float(v)) for k in range(200) for v in rng.permutation(cents)]
    means = spark.createDataFrame(rows, "k long, v double").groupBy("k").agg(scores.exact_mean(F.col("v")).alias("m"))
    assert means.select("m").distinct().count() == 1
    odd = spark.createDataFrame([(1, 1e300), (1, 3e300), (2, None), (3, float("nan"))], "k long, v double")
    got = dict(odd.groupBy("k").agg(scores.exact_mean(F.col("v")).alias("m")).collect())
    assert got[1] == 2e300 and got[2] is None and np.isnan(got[3])
