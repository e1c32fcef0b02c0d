"""Profiling, scored quality rules and alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.operators import ordered
from reviewmill.operators.drift import ALL_METRICS
from reviewmill.operators.joins import attach_totals
from reviewmill.operators.validate import value_counts
from reviewmill.session import materialise

BOX = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def _tidy(wide: DataFrame, section: str) -> DataFrame:
    """One wide row to (section, key, value)."""
    rows = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value"))
                for c in wide.columns
            ]
        )
    )
    return wide.select(F.lit(section).alias("section"), rows.alias("__r")).select("section", "__r.key", "__r.value")


def completeness(df: DataFrame) -> DataFrame:
    """(column, non_null_count, completeness_rate) and an ``all_columns`` row with the mean rate."""
    cols = df.columns
    counts = df.agg(F.count(F.lit(1)).alias("__total"), *[F.count(F.col(c)).alias(c) for c in cols])
    rate = {c: F.try_divide(F.col(c) * 100, F.col("__total")) for c in cols}
    overall = sum(rate.values(), F.lit(0.0)) / len(cols)
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(c).alias("non_null_count"), rate[c].alias("completeness_rate"))
        for c in cols
    ]
    entries.append(
        F.struct(
            F.lit("all_columns").alias("column"),
            F.col("__total").alias("non_null_count"),
            overall.alias("completeness_rate"),
        )
    )
    return counts.select(F.explode(F.array(*entries)).alias("__e")).select("__e.*")


def missing(df: DataFrame) -> DataFrame:
    """(column, missing, missing_percent) and a ``total`` row over all cells."""
    cols = df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("__total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols]
    )
    cells = sum([F.col(c) for c in cols[1:]], F.col(cols[0]))
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(c).alias("missing"),
            F.try_divide(F.col(c) * 100, F.col("__total")).alias("missing_percent"),
        )
        for c in cols
    ]
    entries.append(
        F.struct(
            F.lit("total").alias("column"),
            cells.alias("missing"),
            F.try_divide(cells * 100, F.col("__total") * len(cols)).alias("missing_percent"),
        )
    )
    return counts.select(F.explode(F.array(*entries)).alias("__e")).select("__e.*")


def column_distribution(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return ordered.distribution(ordered.unpivot(df, [], cols), ["column"])


def five_numbers(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """mean, median, std, min, max of each column as (section, key, value) rows."""
    dist = column_distribution(df, cols)
    wide = ordered.moments(dist, ["column"]).join(ordered.quantiles(dist, ["column"], {"median": 0.5}), "column")
    return _melt(wide, "column", ("mean", "median", "std", "min", "max"))


def _melt(wide: DataFrame, section: str, keys: Sequence[str]) -> DataFrame:
    rows = F.explode(
        F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("double").alias("value")) for k in keys])
    )
    return wide.select(F.col(section).alias("section"), rows.alias("__r")).select("section", "__r.key", "__r.value")


def rating_summary(df: DataFrame) -> DataFrame:
    """Rating counts, rating statistics and category counts in one tidy report."""
    counts = value_counts(df, ["overall", "rating_category"])
    stats = five_numbers(df, ["overall"]).withColumn("section", F.lit("rating_stats"))
    return stats.unionByName(
        counts.select(F.col("column").alias("section"), F.col("value").alias("key"),
                      F.col("count").cast("double").alias("value"))
    )


def entity_summary(df: DataFrame, kind: str) -> DataFrame:
    """Reviews per user or product: totals, mean, median, max, single-review share."""
    key, other = ("reviewerID", "asin") if kind == "user" else ("asin", "reviewerID")
    per = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(other).alias("partners"), F.avg("overall").alias("rating")
    )
    stats = per.agg(
        F.count(F.lit(1)).alias("total"),
        F.avg("n").alias("avg_reviews"),
        F.max("n").alias("max_reviews"),
        F.count_if(F.col("n") == 1).alias("single_review"),
        F.avg("partners").alias("avg_partners"),
        F.avg("rating").alias("avg_rating"),
    ).withColumn("single_review_percent", F.try_divide(F.col("single_review") * 100, F.col("total")))
    dist = column_distribution(per, ["n"])
    middle = ordered.quantiles(dist, ["column"], {"median_reviews": 0.5}).select("median_reviews")
    return _tidy(stats, kind).unionByName(_tidy(middle, kind))


def temporal_summary(df: DataFrame, col: str = "review_timestamp") -> DataFrame:
    """Counts by year, month, weekday and quarter in one pass, and the covered period."""
    when = F.col(col)
    parts = df.select(
        F.year(when).alias("year"),
        F.month(when).alias("month"),
        F.weekday(when).alias("dayofweek"),
        F.quarter(when).alias("quarter"),
        when.alias("__ts"),
    )
    names = ["year", "month", "dayofweek", "quarter"]
    sets = [[F.col(n)] for n in names]
    counted = parts.groupingSets(sets, *[F.col(n) for n in names]).agg(F.count(F.lit(1)).alias("n"))
    label = F.coalesce(*[F.when(F.col(n).isNotNull(), F.lit(n)) for n in names])
    number = F.coalesce(*[F.col(n) for n in names])
    by_part = counted.filter(label.isNotNull()).select(
        label.alias("section"), number.cast("string").alias("key"), F.col("n").cast("double").alias("value")
    )
    low, high = F.min("__ts"), F.max("__ts")
    seconds = F.timestamp_diff("SECOND", low, high)
    period = parts.agg(
        F.unix_date(F.to_date(low)).alias("start_day"),
        F.unix_date(F.to_date(high)).alias("end_day"),
        F.floor(seconds / F.lit(86400)).alias("total_days"),
    )
    return by_part.unionByName(_tidy(period, "period"))


def text_summary(df: DataFrame, length: str = "review_length", words: str = "review_word_count") -> DataFrame:
    return five_numbers(df, [length, words])


def quality_report(df: DataFrame, name: str) -> DataFrame:
    """All sections of the report for one dataset as (dataset, section, key, value)."""
    # Stored once: every section passes over it.
    df = materialise(df)
    complete = completeness(df).select(
        F.lit("completeness").alias("section"), F.col("column").alias("key"), F.col("completeness_rate").alias("value")
    )
    parts = [
        complete,
        rating_summary(df),
        entity_summary(df, "user"),
        entity_summary(df, "product"),
        temporal_summary(df),
        text_summary(df, "char_count", "word_count"),
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report.select(F.lit(name).alias("dataset"), "section", "key", "value")


def histogram(df: DataFrame, col: str, bins: int, clip_q: float | None = None) -> DataFrame:
    """Equal-width bins (bin, low, high, count), the last one closed; optional clip at a quantile."""
    values = df.select(F.col(col).cast("double").alias("value")).filter(F.col("value").isNotNull())
    if clip_q is not None:
        dist = ordered.distribution(values.select(F.lit(col).alias("column"), "value"), ["column"])
        limit = ordered.quantiles(dist, ["column"], {"__cap": clip_q}).select("__cap")
        values = attach_totals(values, limit).filter(F.col("value") <= F.col("__cap")).drop("__cap")
    bounds = values.agg(F.min("value").alias("__lo"), F.max("value").alias("__hi"))
    width = (F.col("__hi") - F.col("__lo")) / bins
    place = F.when(width == 0, 0).otherwise(
        F.least(F.floor(F.try_divide(F.col("value") - F.col("__lo"), width)), F.lit(bins - 1))
    )
    counts = (
        attach_totals(values, bounds)
        .groupBy(place.cast("int").alias("bin"), "__lo", "__hi")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return counts.select(
        "bin",
        (F.col("__lo") + F.col("bin") * width).alias("low"),
        (F.col("__lo") + (F.col("bin") + 1) * width).alias("high"),
        "count",
    )


def profile_basic(df: DataFrame) -> DataFrame:
    """Rows, columns and the number of columns of each type."""
    kinds: dict[str, int] = {}
    for _, kind in df.dtypes:
        kinds[kind] = kinds.get(kind, 0) + 1
    wide = df.agg(F.count(F.lit(1)).alias("total_records")).select(
        "total_records",
        F.lit(len(df.columns)).alias("total_columns"),
        *[F.lit(n).alias(f"type_{k}") for k, n in sorted(kinds.items())],
    )
    return _tidy(wide, "basic")


def duplicates(df: DataFrame, keys: Sequence[str] = ("reviewerID", "asin")) -> DataFrame:
    """Surplus rows, compared as whole rows and by ``keys``; copies collapse before the shuffle."""
    whole = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    by_key = whole.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum(F.col("n") - 1).alias("extra"))
    surplus = by_key.agg(
        F.sum("n").alias("total_records"),
        F.sum("extra").alias("total_duplicates"),
        F.sum(F.col("n") - 1).alias("user_product_duplicates"),
    )
    return surplus.select(
        "*",
        F.try_divide(F.col("total_duplicates") * 100, F.col("total_records")).alias("duplicate_percent"),
        F.try_divide(F.col("user_product_duplicates") * 100, F.col("total_records")).alias(
            "user_product_duplicate_percent"
        ),
    )


def iqr_outliers(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Values outside [Q1 - 1.5 IQR, Q3 + 1.5 IQR] per numeric column."""
    dist = column_distribution(df, cols)
    box = ordered.quantiles(dist, ["column"], {"q1": 0.25, "q3": 0.75})
    spread = F.col("q3") - F.col("q1")
    bounds = box.select(
        "column",
        (F.col("q1") - 1.5 * spread).alias("lower_bound"),
        (F.col("q3") + 1.5 * spread).alias("upper_bound"),
    )
    outside = (F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound"))
    counted = (
        dist.join(materialise(bounds), "column")
        .groupBy("column", "lower_bound", "upper_bound")
        .agg(
            F.coalesce(F.sum(F.when(outside, F.col("copies"))), F.lit(0)).alias("count"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
        )
    )
    percent = F.try_divide(F.col("count") * 100, F.col("__rows"))
    return (
        attach_totals(counted, df.agg(F.count(F.lit(1)).alias("__rows")))
        .withColumn("percentage", percent)
        .drop("__rows")
    )


def numeric_distributions(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """mean, std, min, max and the 25/50/75/90/95 percentiles per column."""
    dist = column_distribution(df, cols)
    marks = {"p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95}
    return ordered.moments(dist, ["column"]).drop("n").join(ordered.quantiles(dist, ["column"], marks), "column")


def distributions(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Value counts for string columns, statistics for numeric ones, as (section, key, value)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = [c for c in cols if isinstance(types[c], T.NumericType)]
    strings = [c for c in cols if c not in numeric]
    parts = []
    if strings:
        parts.append(
            value_counts(df, strings).select(
                F.col("column").alias("section"), F.col("value").alias("key"),
                F.col("count").cast("double").alias("value"),
            )
        )
    if numeric:
        wide = numeric_distributions(df, numeric)
        parts.append(_melt(wide, "column", [c for c in wide.columns if c != "column"]))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def box_stats(df: DataFrame, group: str, col: str) -> DataFrame:
    """Quartiles per group with whiskers at the furthest values inside 1.5 IQR."""
    long = df.select(F.col(group), F.col(col).cast("double").alias("value")).filter(F.col("value").isNotNull())
    dist = ordered.distribution(long, [group])
    box = ordered.quantiles(dist, [group], BOX)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    value = F.col("value")
    return (
        dist.join(materialise(box), group)
        .groupBy(group, "q1", "median", "q3")
        .agg(
            F.sum("copies").alias("n"),
            F.min(F.when(value >= F.col("q1") - reach, value)).alias("low_whisker"),
            F.max(F.when(value <= F.col("q3") + reach, value)).alias("high_whisker"),
        )
    )


def sparsity(df: DataFrame) -> DataFrame:
    counts = df.agg(
        F.count(F.lit(1)).alias("reviews"),
        F.count_distinct("reviewerID").alias("users"),
        F.count_distinct("asin").alias("products"),
    )
    cells = F.col("users").cast("double") * F.col("products")
    return counts.withColumn("sparsity", 1 - F.try_divide("reviews", cells))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, stddev, min, max per column (the ``describe`` table, one row per column)."""
    wide = df.agg(
        *[
            agg.alias(f"{c}__{n}")
            for c in cols
            for n, agg in (
                ("count", F.count(c)),
                ("mean", F.avg(c)),
                ("stddev", F.stddev_samp(c)),
                ("min", F.min(c)),
                ("max", F.max(c)),
            )
        ]
    )
    names = ("count", "mean", "stddev", "min", "max")
    rows = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{n}").cast("double").alias(n) for n in names])
        for c in cols
    ]
    return wide.select(F.explode(F.array(*rows)).alias("__r")).select("__r.*")


def _issues(*pairs: tuple[Column, Column | str]) -> Column:
    """Messages whose condition holds, in order."""
    made = [F.when(cond, msg if isinstance(msg, Column) else F.lit(msg)) for cond, msg in pairs]
    return F.filter(F.array(*made), lambda m: m.isNotNull())


def validate_quality(df: DataFrame, name: str) -> DataFrame:
    """Five scored rules, their mean and the list of issues: one row per dataset."""
    rating = F.col("overall")
    keys = F.struct("reviewerID", "asin", "review_timestamp")
    levels = [F.count_if(rating == level).alias(f"__r{level}") for level in range(1, 6)]
    facts = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count("reviewerID").alias("__users"),
        F.count("asin").alias("__items"),
        F.count("overall").alias("__ratings"),
        F.count_if(rating.between(1, 5)).alias("__rating_ok"),
        F.count_if(F.col("helpfulness_ratio").between(0, 1)).alias("__ratio_ok"),
        *levels,
        F.count_distinct(keys).alias("unique_reviews"),
        F.avg("word_count").alias("avg_word_count"),
        F.min("word_count").alias("min_word_count"),
    )
    total = F.col("total_records")
    keys_full = F.least("__users", "__items", "__ratings") == total
    ratings_ok, ratios_ok = F.col("__rating_ok") == total, F.col("__ratio_ok") == total
    all_levels = F.least(*[F.col(f"__r{level}") for level in range(1, 6)]) > 0
    positive = F.coalesce(F.try_divide(F.col("__r4") + F.col("__r5"), total), F.lit(0.0))
    balanced = positive.between(0.3, 0.8)
    unique = F.coalesce(F.try_divide(F.col("unique_reviews"), total), F.lit(0.0))
    long_enough, not_empty = F.col("avg_word_count") > 5, F.col("min_word_count") > 0

    def pick(cond: Column, otherwise: float) -> Column:
        return F.when(cond, 1.0).otherwise(F.lit(otherwise))

    scored = facts.select(
        F.lit(name).alias("dataset"),
        "total_records",
        "unique_reviews",
        "avg_word_count",
        "min_word_count",
        positive.alias("positive_ratio"),
        unique.alias("uniqueness_ratio"),
        pick(keys_full, 0.0).alias("key_score"),
        pick(ratings_ok & ratios_ok, 0.5).alias("range_score"),
        pick(all_levels & balanced, 0.5).alias("distribution_score"),
        F.least(unique * 2, F.lit(1.0)).alias("uniqueness_score"),
        pick(long_enough & not_empty, 0.5).alias("text_score"),
        _issues(
            (~keys_full, "null values in key columns"),
            (~ratings_ok, "ratings outside [1-5]"),
            (~ratios_ok, "helpfulness ratio outside [0-1]"),
            (~all_levels, "rating levels missing"),
            (~balanced, F.format_string("unusual share of positive ratings: %.2f", positive)),
            (unique < 0.95, F.format_string("low uniqueness: %.2f", unique)),
            (~long_enough, "reviews too short on average"),
            (~not_empty, "reviews with 0 words"),
        ).alias("issues"),
    )
    parts = ["key_score", "range_score", "distribution_score", "uniqueness_score", "text_score"]
    return scored.withColumn("overall_score", sum([F.col(p) for p in parts], F.lit(0.0)) / len(parts))


def alerts(validation: DataFrame, drift: DataFrame, min_rows: int = 1000) -> DataFrame:
    """(type, severity, message, dataset) rows from one validation row and a drift report.

    ``drift`` holds one row per metric plus the ``all_metrics`` row (see ``drift_report``).
    """
    overall = F.col("overall_score")
    volume = F.col("total_records")

    def alert(kind: str, severity: str, message: Column) -> Column:
        return F.struct(F.lit(kind).alias("type"), F.lit(severity).alias("severity"), message.alias("message"))

    raised = F.concat(
        F.filter(
            F.array(
                F.when(overall < 0.7, alert("QUALITY", "HIGH", F.format_string("low quality score: %.2f", overall))),
                F.when(volume < min_rows, alert("VOLUME", "MEDIUM", F.format_string("low volume: %d rows", volume))),
            ),
            lambda a: a.isNotNull(),
        ),
        F.transform("issues", lambda i: alert("QUALITY", "MEDIUM", F.concat(F.lit("quality issue: "), i))),
    )
    quality = validation.select("dataset", F.explode(raised).alias("__a")).select("__a.*", "dataset")
    score = F.col("drift_score")
    is_overall = F.col("metric") == ALL_METRICS
    drifted = drift.filter("drift_detected").select(
        F.lit("DRIFT").alias("type"),
        F.when(is_overall | (score > 0.2), "HIGH").otherwise("MEDIUM").alias("severity"),
        F.when(is_overall, F.format_string("data drift detected, score: %.3f", score))
        .otherwise(F.format_string("drift detected for %s: %.3f", F.col("metric"), score))
        .alias("message"),
        "dataset",
    )
    return quality.unionByName(drifted)


def simple_monitor(df: DataFrame, name: str) -> DataFrame:
    """Quick checks of a feature store: counts, alert list and the four-part score."""
    needed = ["reviewerID", "asin", "overall"]
    absent = [c for c in needed if c not in df.columns]
    ratios = [c for c in df.columns if "ratio" in c.lower()]
    if "reviewerID" in absent:
        raise ValueError("reviewerID is required to judge user diversity")
    has_rating = "overall" in df.columns
    rating = F.col("overall") if has_rating else F.lit(None).cast("double")
    # First per user, then over users: the distinct and single-review counts need
    # no second pass, and every other count is summed along.
    per_user = df.groupBy("reviewerID").agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count_if(F.col(c).isNull()).alias(f"__null_{c}") for c in df.columns],
        F.count_if(F.coalesce(rating.between(1, 5), F.lit(False))).alias("__rating_ok"),
        F.count_if(rating.isin(4, 5)).alias("__positive"),
        *[F.count_if(F.coalesce(F.col(c).between(0, 1), F.lit(False))).alias(f"__ok_{c}") for c in ratios],
    )
    known = F.col("reviewerID").isNotNull()
    facts = per_user.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("total_records"),
        F.count_if(known).alias("unique_users"),
        F.count_if(known & (F.col("__n") == 1)).alias("single_review_users"),
        F.sum("__rating_ok").alias("__rating_ok"),
        F.sum("__positive").alias("__positive"),
        *[F.sum(f"__null_{c}").alias(f"__null_{c}") for c in df.columns],
        *[F.sum(f"__ok_{c}").alias(f"__ok_{c}") for c in ratios],
    )
    total = F.col("total_records")
    positive = F.coalesce(F.try_divide("__positive", total), F.lit(0.0))
    single = F.coalesce(F.try_divide("single_review_users", "unique_users"), F.lit(0.0))
    nulls = F.filter(
        F.array(*[F.when(F.col(f"__null_{c}") > total * 0.1, F.lit(c)) for c in df.columns]),
        lambda c: c.isNotNull(),
    )
    invalid = [(total - F.col("__rating_ok"), "ratings outside [1-5]")] if has_rating else []
    invalid += [(total - F.col(f"__ok_{c}"), f"invalid values in {c}") for c in ratios]
    wrong = F.filter(
        F.array(*[F.when(n > 0, F.concat(n.cast("string"), F.lit(f" {what}"))) for n, what in invalid])
        if invalid
        else F.array().cast("array<string>"),
        lambda m: m.isNotNull(),
    )
    score = (
        F.lit(1.0 if not absent else 0.5)
        + (F.when(positive <= 0.8, 1.0).otherwise(0.7) if has_rating else F.lit(0.7))
        + F.when(total >= 1000, 1.0).otherwise(0.5)
        + F.when(F.col("unique_users") >= 100, 1.0).otherwise(0.7)
    ) / 4
    return facts.select(
        F.lit(name).alias("dataset"),
        "total_records",
        "unique_users",
        "single_review_users",
        positive.alias("positive_ratio"),
        _issues(
            (F.lit(bool(absent)), f"HIGH MISSING_COLUMNS {', '.join(absent)}"),
            (F.size(nulls) > 0, F.concat(F.lit("MEDIUM HIGH_NULLS "), F.concat_ws(", ", nulls))),
            (F.size(wrong) > 0, F.concat(F.lit("HIGH INVALID_VALUES "), F.concat_ws("; ", wrong))),
            (positive > 0.9, F.format_string("MEDIUM BIASED_DISTRIBUTION %.2f", positive)),
            (single > 0.7, F.format_string("HIGH COLD_START %.3f", single)),
        ).alias("alerts"),
        score.alias("overall_score"),
    )


def monitor_rollup(scores: DataFrame, drifts: DataFrame, raised: DataFrame) -> DataFrame:
    """Across datasets: mean quality, mean drift, alert totals, datasets with issues.

    ``scores``: (dataset, overall_score); ``drifts``: (dataset, drift_score) of the
    ``all_metrics`` rows; ``raised``: alert rows with severity.
    """
    per = scores.join(drifts, "dataset", "left")
    bad = (F.col("overall_score") < 0.7) | (F.coalesce(F.col("drift_score"), F.lit(0.0)) > 0.1)
    summary = per.agg(
        F.count(F.lit(1)).alias("total_datasets"),
        F.avg("overall_score").alias("avg_quality_score"),
        F.avg("drift_score").alias("avg_drift_score"),
        F.count_if(bad).alias("datasets_with_issues"),
    )
    counts = raised.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.count_if(F.col("severity") == "HIGH").alias("high_severity_alerts"),
    )
    return attach_totals(summary, counts)
