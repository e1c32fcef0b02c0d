"""Validation reports over an enriched table. Each is one aggregate pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_completeness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_records"), *[F.count(c).alias(f"{c}_not_null") for c in cols]
    )


def range_checks(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that satisfy each named rule."""
    return df.agg(
        F.count(F.lit(1)).alias("total_records"), *[F.count_if(c).alias(n) for n, c in rules.items()]
    )


def uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return groups.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("total_records"), F.count(F.lit(1)).alias("unique_records")
    ).withColumn("uniqueness_ratio", F.try_divide("unique_records", "total_records"))


def rating_distribution(df: DataFrame, col: str = "overall") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(col)


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, count) of several columns in one pass."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    )
    long = df.select(pairs.alias("__p")).select("__p.*")
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))


def feature_means(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, mean, std) with the sample standard deviation."""
    return _melt(
        df, cols, {"mean": F.avg, "std": F.stddev_samp}
    )


def value_ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _melt(df, cols, {"min": F.min, "max": F.max})


def _melt(df: DataFrame, cols: Sequence[str], fns: Mapping[str, object]) -> DataFrame:
    wide = df.agg(
        *[fn(F.col(c).cast("double")).alias(f"{c}__{n}") for c in cols for n, fn in fns.items()]
    )
    rows = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{n}").alias(n) for n in fns])
                for c in cols
            ]
        )
    )
    return wide.select(rows.alias("__r")).select("__r.*")


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both are present; null for a constant column."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    # Merged partial moments of a constant need not be exactly zero.
    varies = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
    return F.when(varies, F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x, y, correlation) for every ordered pair, from one aggregate."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    wide = df.agg(
        *[correlation(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}") for a, b in pairs]
    )
    entries = []
    for a, b in pairs:
        for x, y in {(a, b), (b, a)}:
            entries.append(
                F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"{a}__{b}").alias("correlation"))
            )
    return wide.select(F.explode(F.array(*entries)).alias("__e")).select("__e.*")


def entity_counts(df: DataFrame, approximate: bool = False) -> DataFrame:
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        distinct(F.col("reviewerID")).alias("unique_users"),
        distinct(F.col("asin")).alias("unique_products"),
    )


def run_report(
    tables: Mapping[str, DataFrame],
    errors: Mapping[str, Sequence[str]] | None = None,
    durations: Mapping[str, float] | None = None,
) -> DataFrame:
    """One row per processed table and a final ``total`` row."""
    errors, durations = errors or {}, durations or {}
    report = None
    for name, df in tables.items():
        failed = list(errors.get(name, []))
        row = df.agg(F.count(F.lit(1)).alias("records")).select(
            F.lit(name).alias("table"),
            F.lit("error" if failed else "success").alias("status"),
            "records",
            F.lit(len(failed)).cast("long").alias("errors"),
            F.lit(durations.get(name)).cast("double").alias("duration_seconds"),
        )
        report = row if report is None else report.unionByName(row)
    total = report.agg(
        F.lit("total").alias("table"),
        F.when(F.sum("errors") > 0, "error").otherwise("success").alias("status"),
        F.sum("records").alias("records"),
        F.sum("errors").alias("errors"),
        F.sum("duration_seconds").alias("duration_seconds"),
    )
    return report.unionByName(total)
