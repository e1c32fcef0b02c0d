"""A/B experiments: assignment, metric log, tests and reports."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions import special
from reviewmill.operators import ordered
from reviewmill.operators.joins import attach_totals
from reviewmill.session import materialise
from reviewmill.sources import writers

SMALL_SAMPLE = 30  # below this in either arm the rank test is used


def bucket(user: Column) -> Column:
    """int(md5(user)) mod 100, from the two halves of the digest (2^64 mod 100 = 16)."""
    digest = F.md5(user)

    def half(start: int) -> Column:
        return F.conv(F.substring(digest, start, 16), 16, 10).cast("decimal(20,0)") % 100

    return ((half(1) * 16 + half(17)) % 100).cast("int")


def group_of(user: Column, split: float = 0.5) -> Column:
    return F.when(bucket(user) / F.lit(100.0) < F.lit(float(split)), "A").otherwise("B")


def assign(df: DataFrame, split: float = 0.5, user: str = "user_id") -> DataFrame:
    """Sticky group per user: a pure function of the id, so nothing needs to be remembered."""
    return df.withColumn("group", group_of(F.col(user), split))


def track(events: DataFrame, test_id: str, split: float = 0.5) -> DataFrame:
    """Metric log rows (test_id, user_id, group, metric, value, ts) from (user_id, metric, value, ts)."""
    return assign(events, split).select(
        F.lit(test_id).alias("test_id"), "user_id", "group", "metric", "value", "ts"
    )


def required_sample(
    metrics: DataFrame, effect: float, power: float = 0.8, alpha: float = 0.05
) -> DataFrame:
    """Sample size per arm to see ``effect`` over each metric's control-group rate."""
    z = NormalDist().inv_cdf(1 - alpha / 2) + NormalDist().inv_cdf(power)
    base = metrics.filter(F.col("group") == "A").groupBy("metric").agg(F.avg("value").alias("baseline"))
    p1, p2 = F.col("baseline"), F.col("baseline") + F.lit(effect)
    n = F.ceil(F.lit(z * z) * (p1 * (1 - p1) + p2 * (1 - p2)) / F.lit(effect * effect))
    return base.withColumn("n_per_group", n).withColumn("n_total", n * 2)


def arms(metrics: DataFrame) -> DataFrame:
    """One row per metric: size, mean and population standard deviation of both arms."""
    value = F.col("value")

    def arm(group: str) -> list[Column]:
        own = F.when(F.col("group") == group, value)
        tag = group.lower()
        return [
            F.count(own).alias(f"sample_size_{tag}"),
            F.avg(own).alias(f"mean_{tag}"),
            F.stddev_pop(own).alias(f"std_{tag}"),
        ]

    return metrics.groupBy("metric").agg(*arm("A"), *arm("B"))


def improvement() -> Column:
    return F.when(
        F.col("mean_a") > 0, (F.col("mean_b") - F.col("mean_a")) / F.col("mean_a") * 100
    ).otherwise(0.0)


def t_statistics(per_metric: DataFrame) -> DataFrame:
    """Pooled t, Cohen's d and improvement from the per-arm rows; undefined for zero variance."""
    na, nb = F.col("sample_size_a"), F.col("sample_size_b")
    va, vb = F.col("std_a") * F.col("std_a"), F.col("std_b") * F.col("std_b")
    dof = na + nb - 2
    pooled = F.try_divide(na * va + nb * vb, dof)
    error = F.sqrt(pooled * (F.try_divide(F.lit(1.0), na) + F.try_divide(F.lit(1.0), nb)))
    spread = F.sqrt(F.try_divide((na - 1) * va + (nb - 1) * vb, dof))
    return per_metric.withColumns(
        {
            "dof": dof,
            "t_statistic": F.try_divide(F.col("mean_a") - F.col("mean_b"), error),
            "cohens_d": F.when(spread > 0, (F.col("mean_b") - F.col("mean_a")) / spread).otherwise(0.0),
            "improvement_percent": improvement(),
        }
    )


def t_test(metrics: DataFrame, level: float = 0.95, alpha: float = 0.05) -> DataFrame:
    """t_statistics with p-value, significance and the t interval of both arms."""
    out = t_statistics(arms(metrics))
    out = out.withColumn("p_value", special.t_pvalue(F.col("t_statistic"), F.col("dof").cast("double")))
    for tag in ("a", "b"):
        n = F.col(f"sample_size_{tag}")
        half = special.t_margin(F.lit(level), (n - 1).cast("double")) * F.col(f"std_{tag}") / F.sqrt(n)
        out = out.withColumn(f"ci_{tag}", F.array(F.col(f"mean_{tag}") - half, F.col(f"mean_{tag}") + half))
    return out.withColumn("is_significant", F.coalesce(F.col("p_value") < alpha, F.lit(False)))


def rank_statistics(metrics: DataFrame) -> DataFrame:
    """(metric, n_a, n_b, u_statistic, ties): average ranks from counts per distinct value."""
    is_a = (F.col("group") == "A").cast("long")
    counts = (
        metrics.filter(F.col("value").isNotNull())
        .groupBy("metric", "value")
        .agg(F.sum(is_a).alias("__a"), F.count(F.lit(1)).alias("__t"))
    )
    cum = ordered.group_totals(counts, ["metric"], "value", {"__cum": F.col("__t")})
    a, t = F.col("__a"), F.col("__t").cast("double")
    rank = F.col("__cum") - t + (t + 1) / 2
    n_a = F.sum(a)
    return cum.groupBy("metric").agg(
        n_a.alias("n_a"),
        F.sum(F.col("__t") - a).alias("n_b"),
        (F.sum(a * rank) - n_a * (n_a + 1) / 2).alias("u_statistic"),
        F.sum(t * t * t - t).alias("ties"),
    )


def mann_whitney(metrics: DataFrame, alpha: float = 0.05) -> DataFrame:
    ranks = rank_statistics(metrics)
    p = special.mann_whitney_pvalue(
        F.col("u_statistic"), F.col("n_a").cast("double"), F.col("n_b").cast("double"), F.col("ties")
    )
    means = arms(metrics).select("metric", "mean_a", "mean_b")
    return (
        ranks.join(means, "metric")
        .withColumn("p_value", p)
        .withColumn("is_significant", F.coalesce(F.col("p_value") < alpha, F.lit(False)))
        .withColumn("improvement_percent", improvement())
        .withColumnsRenamed({"n_a": "sample_size_a", "n_b": "sample_size_b"})
    )


def contingency(df: DataFrame, category: str, group: str = "group") -> DataFrame:
    """(category, observed_a, observed_b, expected_a, expected_b)."""
    seen = df.groupBy(category).agg(
        F.count_if(F.col(group) == "A").alias("observed_a"), F.count_if(F.col(group) == "B").alias("observed_b")
    )
    totals = seen.agg(F.sum("observed_a").alias("__a"), F.sum("observed_b").alias("__b"))
    row = F.col("observed_a") + F.col("observed_b")
    whole = F.col("__a") + F.col("__b")
    return (
        attach_totals(seen, totals)
        .withColumn("expected_a", row * F.col("__a") / whole)
        .withColumn("expected_b", row * F.col("__b") / whole)
        .drop("__a", "__b")
    )


def chi_square_statistic(df: DataFrame, category: str, group: str = "group") -> DataFrame:
    """(chi2_statistic, dof) of category x group; continuity correction for a 2x2 table."""
    table = contingency(df, category, group)
    sized = attach_totals(table, table.agg(F.count(F.lit(1)).alias("__k")))

    def cell(tag: str) -> Column:
        gap = F.abs(F.col(f"observed_{tag}") - F.col(f"expected_{tag}"))
        gap = F.when(F.col("__k") == 2, gap - F.least(gap, F.lit(0.5))).otherwise(gap)
        return F.try_divide(gap * gap, F.col(f"expected_{tag}"))

    return sized.agg(
        F.sum(cell("a") + cell("b")).alias("chi2_statistic"), (F.count(F.lit(1)) - 1).alias("degrees_of_freedom")
    )


def chi_square(df: DataFrame, category: str, group: str = "group", alpha: float = 0.05) -> DataFrame:
    out = chi_square_statistic(df, category, group)
    p = special.chi2_pvalue(F.col("chi2_statistic"), F.col("degrees_of_freedom").cast("double"))
    return out.withColumn("p_value", p).withColumn("is_significant", F.col("p_value") < alpha)


def analyze(metrics: DataFrame, test_id: str, min_sample: int = 1000, alpha: float = 0.05) -> DataFrame:
    """Per-metric result and the overall status of a test.

    Both tests are computed for every metric (one aggregate each) and the
    result is picked per row: too small, rank test or t test.
    """
    t = t_test(metrics, alpha=alpha)
    u = mann_whitney(metrics, alpha=alpha).select(
        "metric", "u_statistic", F.col("p_value").alias("__pu")
    )
    enough = F.least("sample_size_a", "sample_size_b") >= min_sample
    small = F.least("sample_size_a", "sample_size_b") < SMALL_SAMPLE
    p = F.when(enough, F.when(small, F.col("__pu")).otherwise(F.col("p_value")))
    rows = t.join(u, "metric", "left").select(
        F.lit(test_id).alias("test_id"),
        "metric",
        enough.alias("sample_size_sufficient"),
        "sample_size_a",
        "sample_size_b",
        F.lit(min_sample).alias("required_sample_size"),
        F.when(enough, F.when(small, "mann_whitney_u").otherwise("t_test")).alias("test_type"),
        F.when(enough, F.when(small, F.col("u_statistic")).otherwise(F.col("t_statistic"))).alias("statistic"),
        p.alias("p_value"),
        F.coalesce(p < alpha, F.lit(False)).alias("is_significant"),
        F.when(enough, F.col("mean_a")).alias("mean_a"),
        F.when(enough, F.col("mean_b")).alias("mean_b"),
        F.when(enough & ~small, F.col("cohens_d")).alias("cohens_d"),
        F.when(enough, F.col("improvement_percent")).alias("improvement_percent"),
    )
    verdict = rows.agg(
        F.count_if("is_significant").alias("significant_metrics_count"),
        F.count_if("sample_size_sufficient").alias("__ready"),
    )
    status = (
        F.when(F.col("significant_metrics_count") > 0, "significant_results")
        .when(F.col("__ready") > 0, "no_significant_results")
        .otherwise("insufficient_data")
    )
    return attach_totals(rows, verdict).withColumn("overall_status", status).drop("__ready")


def test_summary(metrics: DataFrame, test_id: str, split: float = 0.5) -> DataFrame:
    """Assigned users in total and per group, and the metrics seen."""
    users = metrics.select("user_id", "group").distinct()
    # Names meet once each: the number of metrics bounds the list, not the number of users.
    names = metrics.select("metric").distinct().agg(
        F.concat_ws(",", F.array_sort(F.collect_list("metric"))).alias("metrics_tracked")
    )
    return attach_totals(users.agg(
        F.lit(test_id).alias("test_id"),
        F.lit(float(split)).alias("traffic_split"),
        F.count(F.lit(1)).alias("total_assignments"),
        F.count_if(F.col("group") == "A").alias("group_a_count"),
        F.count_if(F.col("group") == "B").alias("group_b_count"),
    ), names)


def close_test(tests: DataFrame, results: DataFrame, test_id: str, stopped_at: str) -> DataFrame:
    """The test table with this test stopped and its verdict frozen.

    ``tests``: (test_id, status, stopped_at, overall_status); write the result
    as the table's next version. A test that is already stopped stays as it is.
    """
    verdict = results.groupBy("test_id").agg(F.max("overall_status").alias("__verdict"))
    closing = (F.col("test_id") == test_id) & (F.col("status") == "active")
    return (
        tests.join(verdict, "test_id", "left")
        .withColumn("overall_status", F.when(closing, F.col("__verdict")).otherwise(F.col("overall_status")))
        .withColumn("stopped_at", F.when(closing, F.lit(stopped_at)).otherwise(F.col("stopped_at")))
        .withColumn("status", F.when(closing, "stopped").otherwise(F.col("status")))
        .drop("__verdict")
    )


def close_saved_test(metrics: DataFrame, path: str, test_id: str, stopped_at: str, min_sample: int = 1000) -> int:
    """Closes a test in the versioned table of tests at ``path``: the number of the version that says so.

    ``metrics`` is the test's own metric log; its verdict is worked out once. A writer that changes the table
    meanwhile is not overwritten: the closing is applied to the newest version again.
    """
    spark = metrics.sparkSession
    results = materialise(analyze(metrics, test_id, min_sample).select("test_id", "overall_status"))
    while True:
        version = writers.versions(spark, path)[-1]
        closed = close_test(writers.read_table(spark, path, version), results, test_id, stopped_at)
        try:
            return writers.write_table(closed, path, based_on=version)
        except writers.Conflict:
            continue
