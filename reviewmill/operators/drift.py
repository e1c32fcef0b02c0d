"""Drift between a current and a reference table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions import special
from reviewmill.operators import ordered
from reviewmill.session import materialise

# Name of the summary row; ``overall`` is taken, it is the rating column.
ALL_METRICS = "all_metrics"


def _sides(current: DataFrame, reference: DataFrame, pick) -> DataFrame:
    return pick(current).withColumn("__cur", F.lit(1).cast("long")).withColumn("__ref", F.lit(0).cast("long")).unionByName(
        pick(reference).withColumn("__cur", F.lit(0).cast("long")).withColumn("__ref", F.lit(1).cast("long"))
    )


def kolmogorov_sf(distance: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p-value: 2 sum (-1)^(k-1) exp(-2 k^2 en D^2), en = nm/(n+m)."""
    en = n * m / (n + m)
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(100)),
        lambda k: F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(F.lit(-2.0) * k * k * en * distance * distance),
    )
    total = F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)
    return F.when(distance == 0, 1.0).otherwise(F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)))


def _two_samples(current: DataFrame, reference: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(metric, value, c, r, fc, fr): copies of each value per side with running counts, stored.

    Both samples are counted per distinct value, so copies collapse before the
    shuffle; this is the only pass over the data.
    """
    both = _sides(current, reference, lambda d: ordered.unpivot(d, [], cols)).withColumnRenamed("column", "metric")
    counts = both.groupBy("metric", "value").agg(F.sum("__cur").alias("c"), F.sum("__ref").alias("r"))
    return ordered.group_totals(counts, ["metric"], "value", {"fc": F.col("c"), "fr": F.col("r")})


def _ks(samples: DataFrame) -> DataFrame:
    totals = samples.groupBy("metric").agg(F.sum("c").alias("n_cur"), F.sum("r").alias("n_ref"))
    gap = F.abs(F.try_divide("fc", "n_cur") - F.try_divide("fr", "n_ref"))
    stats = samples.join(materialise(totals), "metric").groupBy("metric", "n_cur", "n_ref").agg(F.max(gap).alias("ks_statistic"))
    law = [F.col("ks_statistic"), F.col("n_cur"), F.col("n_ref")]
    exact = special.ks_pvalue_exact(*[c.cast("double") for c in law])
    return stats.withColumn("ks_pvalue", F.coalesce(exact, kolmogorov_sf(*law)))


def ks_drift(current: DataFrame, reference: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(metric, n_cur, n_ref, ks_statistic, ks_pvalue) of the two-sample test.

    The p-value is exact up to ``special.EXACT_KS`` values in either sample, above that it is that of the limiting law.
    """
    return _ks(_two_samples(current, reference, cols))


def numeric_drift(current: DataFrame, reference: DataFrame, cols: Sequence[str]) -> DataFrame:
    """KS statistic, relative change of mean and standard deviation, score and flag."""
    samples = _two_samples(current, reference, cols)

    def side(copies: str, mean: str, std: str) -> DataFrame:
        own = samples.filter(F.col(copies) > 0).select("metric", "value", F.col(copies).alias("copies"))
        return ordered.moments(own, ["metric"]).select(
            "metric", F.col("mean").alias(mean), F.col("std").alias(std)
        )

    def relative(new: str, old: str) -> Column:
        return F.when(F.col(old) == 0, 0.0).otherwise(F.try_divide(F.abs(F.col(new) - F.col(old)), F.col(old)))

    scored = (
        _ks(samples)
        .join(side("c", "__mc", "__sc"), "metric")
        .join(side("r", "__mr", "__sr"), "metric")
        .withColumn("mean_drift", relative("__mc", "__mr"))
        .withColumn("std_drift", relative("__sc", "__sr"))
        .withColumn("drift_score", (F.col("ks_statistic") + F.col("mean_drift") + F.col("std_drift")) / 3)
    )
    flag = (F.col("ks_pvalue") < 0.05) | (F.col("drift_score") > 0.1)
    return scored.select(
        "metric", "ks_statistic", "ks_pvalue", "mean_drift", "std_drift", "drift_score", flag.alias("drift_detected")
    )


def hellinger_drift(current: DataFrame, reference: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Hellinger distance of the value shares per categorical column; a value on one side only counts as 0 on the other."""

    def long(df: DataFrame) -> DataFrame:
        pairs = F.explode(
            F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("value")) for c in cols])
        )
        return df.select(pairs.alias("__p")).select("__p.*").filter(F.col("value").isNotNull())

    counts = (
        _sides(current, reference, long)
        .groupBy("metric", "value")
        .agg(F.sum("__cur").alias("__c"), F.sum("__ref").alias("__r"))
    )
    totals = counts.groupBy("metric").agg(F.sum("__c").alias("__nc"), F.sum("__r").alias("__nr"))
    gap = F.sqrt(F.coalesce(F.try_divide("__c", "__nc"), F.lit(0.0))) - F.sqrt(
        F.coalesce(F.try_divide("__r", "__nr"), F.lit(0.0))
    )
    distance = F.sqrt(F.sum(gap * gap) / 2)
    return (
        counts.join(materialise(totals), "metric")
        .groupBy("metric")
        .agg(distance.alias("hellinger_distance"))
        .withColumn("drift_score", F.col("hellinger_distance"))
        .withColumn("drift_detected", F.col("hellinger_distance") > 0.1)
    )


def drift_report(
    current: DataFrame, reference: DataFrame, numeric: Sequence[str], categorical: Sequence[str], name: str
) -> DataFrame:
    """(dataset, metric, drift_score, drift_detected) per metric and an ``all_metrics`` row."""
    columns = ["metric", "drift_score", "drift_detected"]
    # One row per compared column; written once because the overall row reads it again.
    metrics = materialise(
        numeric_drift(current, reference, numeric)
        .select(*columns)
        .unionByName(hellinger_drift(current, reference, categorical).select(*columns))
    )
    overall = metrics.agg(
        F.lit(ALL_METRICS).alias("metric"),
        F.avg("drift_score").alias("drift_score"),
        F.coalesce(F.bool_or("drift_detected"), F.lit(False)).alias("drift_detected"),
    )
    return metrics.unionByName(overall).select(F.lit(name).alias("dataset"), *columns)
