"""Known values of the tests and distribution functions."""

import math

import pytest
from pyspark.sql import functions as F

from reviewmill.functions import special
from reviewmill.operators import drift, experiments


def test_distribution_functions():
    assert special.t_two_sided(2.0, 10) == pytest.approx(0.07338803, abs=1e-7)
    assert special.t_quantile(0.975, 10) == pytest.approx(2.2281388520, abs=1e-8)
    assert special.t_quantile(0.975, 1000) == pytest.approx(1.9623390808, abs=1e-8)
    assert special.gamma_upper(0.5, 3.841458820694124 / 2) == pytest.approx(0.05, abs=1e-9)
    assert special.gamma_upper(2.0, 9.487729036781154 / 2) == pytest.approx(0.05, abs=1e-9)
    assert special.beta_inc(2, 3, 0.4) == pytest.approx(0.5248, abs=1e-9)


def test_mann_whitney_exact_counts_arrangements():
    # 3 against 3 without ties: only 1 of 20 arrangements reaches U = 9.
    assert special.mann_whitney_exact(9, 3, 3) == pytest.approx(1 / 20)
    assert special.mann_whitney_exact(0, 4, 7) == pytest.approx(1.0)


def log(spark, a, b):
    rows = [(f"a{i}", "A", float(v)) for i, v in enumerate(a)] + [(f"b{i}", "B", float(v)) for i, v in enumerate(b)]
    return spark.createDataFrame(rows, "user_id string, `group` string, value double").withColumn("metric", F.lit("m"))


def test_mann_whitney_small_sample(spark):
    row = experiments.mann_whitney(log(spark, [1, 2, 3], [4, 5, 6])).first()
    assert row.u_statistic == 0 and row.p_value == pytest.approx(0.1)


def test_mann_whitney_with_ties_uses_normal_law(spark):
    row = experiments.mann_whitney(log(spark, [1, 1, 2], [1, 2, 2])).first()
    mu, ties = 4.5, (27 - 3) * 2
    spread = math.sqrt(9 / 12 * (7 - ties / 30))
    assert row.u_statistic == 3.0
    assert row.p_value == pytest.approx(math.erfc((6 - mu - 0.5) / spread / math.sqrt(2)))


def test_t_test_equal_and_constant(spark):
    same = experiments.t_test(log(spark, [1, 2, 3], [1, 2, 3])).first()
    assert same.t_statistic == 0 and same.p_value == pytest.approx(1.0) and not same.is_significant
    flat = experiments.t_test(log(spark, [2, 2], [2, 2])).first()
    assert flat.t_statistic is None and flat.cohens_d == 0 and not flat.is_significant


def test_t_test_values(spark):
    row = experiments.t_test(log(spark, [1, 2, 3, 4], [3, 4, 5, 8])).first()
    # pooled variance (5 + 14) / 6, t = -2.5 / sqrt(19/6 * 1/2)
    assert row.t_statistic == pytest.approx(-2.5 / math.sqrt(19 / 12))
    assert row.improvement_percent == pytest.approx(100.0)
    half = special.t_quantile(0.975, 3) * math.sqrt(1.25) / 2
    assert row.ci_a == pytest.approx([2.5 - half, 2.5 + half])


def test_chi_square_two_by_two_is_corrected(spark):
    rows = [("x", "A")] * 10 + [("x", "B")] * 20 + [("y", "A")] * 30 + [("y", "B")] * 20
    df = spark.createDataFrame(rows, "c string, `group` string")
    row = experiments.chi_square(df, "c").first()
    expected = [15, 15, 25, 25]
    assert row.degrees_of_freedom == 1
    assert row.chi2_statistic == pytest.approx(sum(4.5**2 / e for e in expected))
    assert row.p_value == pytest.approx(math.erfc(math.sqrt(row.chi2_statistic / 2)), abs=1e-12)


def test_analyze_gate_and_tests(spark):
    few = experiments.analyze(log(spark, [1, 2], [3, 4]), "t", min_sample=10).first()
    assert few.overall_status == "insufficient_data" and not few.sample_size_sufficient and few.p_value is None
    ranks = experiments.analyze(log(spark, range(20), range(30, 50)), "t", min_sample=10).first()
    assert ranks.test_type == "mann_whitney_u" and ranks.overall_status == "significant_results"
    big = experiments.analyze(log(spark, range(40), range(40)), "t", min_sample=10).first()
    assert big.test_type == "t_test" and big.overall_status == "no_significant_results"


def test_bucket_equals_python(spark):
    import hashlib

    ids = [f"user_{i}" for i in range(200)]
    df = spark.createDataFrame([(i,) for i in ids], "u string")
    for row in df.select("u", experiments.bucket(F.col("u")).alias("b")).collect():
        assert row.b == int(hashlib.md5(row.u.encode()).hexdigest(), 16) % 100


def test_sample_size(spark):
    rows = log(spark, [0.1] * 4, [0.5])
    out = experiments.required_sample(rows, 0.05).first()
    assert out.n_per_group == math.ceil((1.959963985 + 0.841621234) ** 2 * (0.09 + 0.1275) / 0.0025)
    assert out.n_total == 2 * out.n_per_group


def test_drift_extremes(spark):
    a = spark.createDataFrame([(float(v), "x") for v in range(50)], "overall double, c string")
    b = spark.createDataFrame([(float(v), "y") for v in range(100, 150)], "overall double, c string")
    same = drift.numeric_drift(a, a, ["overall"]).first()
    assert same.ks_statistic == 0 and same.ks_pvalue == 1.0 and not same.drift_detected
    apart = drift.numeric_drift(a, b, ["overall"]).first()
    assert apart.ks_statistic == 1.0 and apart.ks_pvalue < 1e-9 and apart.drift_detected
    assert drift.hellinger_drift(a, b, ["c"]).first().hellinger_distance == pytest.approx(1.0)
    assert drift.hellinger_drift(a, a, ["c"]).first().hellinger_distance == 0
    zero = a.withColumn("overall", F.col("overall") - 24.5)
    assert drift.numeric_drift(a, zero, ["overall"]).first().mean_drift == 0


def test_drift_report_rows_and_alerts(spark):
    from reviewmill.operators import quality

    a = spark.range(40).select(
        F.lit("U").alias("reviewerID"), F.col("id").cast("string").alias("asin"), (F.col("id") % 2 + 4.0).alias("overall"),
        F.expr("timestamp_ntz'2020-01-01 00:00:00'").alias("review_timestamp"), F.lit(9).alias("word_count"),
        F.lit(0.5).alias("helpfulness_ratio"), F.lit("x").alias("c"),
    )
    b = a.withColumn("overall", F.col("overall") - 3)
    report = drift.drift_report(a, b, ["overall"], ["c"], "d").collect()
    assert sorted(r.metric for r in report) == ["all_metrics", "c", "overall"]
    score = {r.metric: r.drift_score for r in report}
    assert score["all_metrics"] == pytest.approx((score["c"] + score["overall"]) / 2)
    raised = quality.alerts(quality.validate_quality(a, "d"), drift.drift_report(a, b, ["overall"], ["c"], "d")).collect()
    assert sorted((r.type, r.severity) for r in raised) == [
        ("DRIFT", "HIGH"), ("DRIFT", "HIGH"), ("QUALITY", "MEDIUM"), ("QUALITY", "MEDIUM"), ("VOLUME", "MEDIUM")
    ]


def test_mann_whitney_laws_meet_at_the_border(monkeypatch, spark):
    """Just under and just over the size where the exact law ends, the two laws agree."""
    import pandas as pd

    from reviewmill.functions import special

    law = special.mann_whitney_pvalue.func

    def p(u, n, m):
        return law(pd.Series([u]), pd.Series([n]), pd.Series([m]), pd.Series([0.0]))[0]

    n, m = 6.0, 400.0
    for u in (700.0, 1100.0, 1500.0):
        exact = p(u, n, m)
        monkeypatch.setattr(special, "EXACT_SIDE", 0)
        assert abs(exact - p(u, n, m)) < 0.012
        monkeypatch.undo()


def test_exact_laws_equal_enumeration():
    """All orders of two samples of up to eight values: every distance and every rank sum."""
    import itertools
    from collections import Counter

    import numpy as np

    for n, m in itertools.product(range(1, 9), repeat=2):
        places = np.array(list(itertools.combinations(range(n + m), n)))
        mine = np.zeros((len(places), n + m), np.int64)
        np.put_along_axis(mine, places, 1, axis=1)
        gaps = np.abs(np.cumsum(mine * m - (1 - mine) * n, axis=1)).max(axis=1)
        for gap, _ in Counter(gaps.tolist()).items():
            assert special.ks_exact(gap / (n * m), n, m) == pytest.approx((gaps >= gap).mean(), abs=1e-12)
        wins = places.sum(axis=1) - n * (n - 1) // 2
        for u in range(n * m + 1):
            assert special.mann_whitney_exact(u, n, m) == pytest.approx((wins >= u).mean(), abs=1e-12)


def test_exact_laws_of_uneven_and_large_samples():
    # One value above all others, and a value in the middle; sizes no table would hold.
    assert special.mann_whitney_exact(10**9, 1, 10**9) == pytest.approx(1 / (10**9 + 1), rel=1e-12)
    assert special.mann_whitney_exact(4 * 10**9, 8, 10**9) == pytest.approx(0.5, abs=1e-6)
    assert special.mann_whitney_exact(2 * 10**6 - 3, 2, 10**6) == pytest.approx(6 / math.comb(10**6 + 2, 2), rel=1e-12)
    # Known limit: 1.3581 / sqrt(nm / (n + m)) is the 5 % point for large samples.
    assert special.ks_exact(round(1.3581 * (2 / 2000) ** 0.5 * 2000) / 2000, 2000, 2000) == pytest.approx(0.05, abs=0.004)


def test_ks_of_small_samples_is_exact(spark):
    left = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4)], "v double")
    right = spark.createDataFrame([(float(x),) for x in (5, 6, 7)], "v double")
    row = drift.ks_drift(left, right, ["v"]).first()
    assert row.ks_statistic == 1.0 and row.ks_pvalue == pytest.approx(2 / 35)
    many = spark.range(10_001).select(F.col("id").cast("double").alias("v"))
    assert drift.ks_drift(many, right, ["v"]).first().ks_pvalue == pytest.approx(0.0050, abs=0.002)


def test_saved_test_is_closed_once_and_keeps_other_writers(spark, tmp_path, monkeypatch):
    from reviewmill.operators import experiments
    from reviewmill.sources import writers

    path = str(tmp_path / "tests")
    schema = "test_id string, status string, stopped_at string, overall_status string"
    writers.write_table(spark.createDataFrame([("a", "active", None, None), ("b", "active", None, None)], schema), path)
    log = spark.createDataFrame(
        [("m", g, f"{g}{i}", float(i + (100 if g == "B" else 0))) for g in "AB" for i in range(40)],
        "metric string, `group` string, user_id string, value double",
    )
    publish, calls = writers.write_table, []

    def raced(df, where, **more):
        # Another writer adds a test between the reading and the commit.
        if not calls:
            calls.append(1)
            writers.append_table(spark.createDataFrame([("c", "active", None, None)], schema), where)
        return publish(df, where, **more)

    monkeypatch.setattr(writers, "write_table", raced)
    experiments.close_saved_test(log, path, "a", "2024-02-01", min_sample=10)
    experiments.close_saved_test(log, path, "a", "2024-03-01", min_sample=1000)
    rows = {r.test_id: (r.status, r.stopped_at, r.overall_status) for r in writers.read_table(spark, path).collect()}
    assert rows == {
        "a": ("stopped", "2024-02-01", "significant_results"), "b": ("active", None, None), "c": ("active", None, None)
    }
