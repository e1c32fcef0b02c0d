"""Feature engineering over an enriched review frame."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewmill.functions import scores, text
from reviewmill.operators import ordered
from reviewmill.operators.joins import attach_stats, attach_totals
from reviewmill.schemas import require

HOLIDAY_MONTHS = (11, 12, 1, 7, 8)  # fixed values


def calendar_features(df: DataFrame) -> DataFrame:
    when = F.col("review_timestamp")
    return df.withColumns(
        {
            "review_year": F.year(when),
            "review_month": F.month(when),
            "review_day": F.dayofmonth(when),
            "review_weekday": F.weekday(when),
            "review_hour": F.hour(when),
            "review_dayofyear": F.dayofyear(when),
        }
    )


def season_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "is_weekend": (F.col("review_weekday") >= 5).cast("int"),
            "is_holiday": F.col("review_month").isin(*HOLIDAY_MONTHS).cast("int"),
        }
    )


def cyclic(df: DataFrame) -> DataFrame:
    month, day = F.col("review_month") * (2 * math.pi / 12), F.col("review_weekday") * (2 * math.pi / 7)
    return df.withColumns(
        {
            "month_sin": F.sin(month),
            "month_cos": F.cos(month),
            "weekday_sin": F.sin(day),
            "weekday_cos": F.cos(day),
        }
    )


def recency(df: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """Whole days and weeks before the newest review of the table (of ``base``, a cheaper frame of the same rows)."""
    newest = (df if base is None else base).agg(F.max("review_timestamp").alias("__newest"))
    days = scores.whole_days(F.col("__newest"), F.col("review_timestamp"))
    return (
        attach_totals(df, newest)
        .withColumn("days_before_newest", days)
        .withColumn("weeks_before_newest", F.floor(F.col("days_before_newest") / 7).cast("int"))
        .drop("__newest")
    )


def user_profile(df: DataFrame) -> DataFrame:
    """All per-user aggregates in one pass: activity, counts, diversity, rating spread."""
    days = scores.whole_days(F.max("review_timestamp"), F.min("review_timestamp"))
    return df.groupBy("reviewerID").agg(
        F.count(F.lit(1)).alias("user_popularity"),
        days.alias("user_activity_days"),
        (F.count(F.lit(1)) / (days + 1)).alias("user_review_frequency"),
        F.count_distinct("asin").alias("user_product_diversity"),
        F.avg("overall").alias("user_avg_rating"),
        scores.rating_spread(F.col("overall")).alias("user_rating_std"),
    )


def product_profile(df: DataFrame) -> DataFrame:
    days = scores.whole_days(F.max("review_timestamp"), F.min("review_timestamp"))
    return df.groupBy("asin").agg(
        F.count(F.lit(1)).alias("product_popularity_count"),
        days.alias("product_lifetime_days"),
        F.count_distinct("reviewerID").alias("product_user_diversity"),
        F.avg("overall").alias("product_avg_rating"),
        scores.rating_spread(F.col("overall")).alias("product_rating_std"),
    )


def rarity(per_key: DataFrame, count: str, name: str) -> DataFrame:
    """Average-rank percentile of ``count`` across the keys of ``per_key``.

    The ranks are taken on the histogram of counts, which has far fewer rows
    than there are keys, and joined back by count.
    """
    counts = per_key.filter(F.col(count).isNotNull()).select(F.col(count).alias("value"))
    ranks = ordered.distribution(counts, []).select(F.col("value").alias(count), ordered.rank_percent().alias(name))
    return per_key.join(ranks, count, "left")


def rating_confidence(user_std: Column, product_std: Column) -> Column:
    """1.0 / 0.7 / 0.3; an undefined spread (single review) counts as low."""

    def both(limit: float) -> Column:
        return F.coalesce((user_std < limit) & (product_std < limit), F.lit(False))

    return F.when(both(1.5), 1.0).when(both(2.0), 0.7).otherwise(0.3)


def attach_users(df: DataFrame, users: DataFrame) -> DataFrame:
    return attach_stats(df, rarity(users, "user_popularity", "user_rarity_score"), "reviewerID")


def attach_products(df: DataFrame, products: DataFrame) -> DataFrame:
    return attach_stats(df, rarity(products, "product_popularity_count", "product_rarity_score"), "asin")


def pair_features(df: DataFrame) -> DataFrame:
    """Confidence, engagement and the products of user and product statistics."""
    col = F.col
    confidence = rating_confidence(col("user_rating_std"), col("product_rating_std"))
    return df.withColumns(
        {
            "rating_confidence": confidence,
            "engagement_intensity": col("helpfulness_ratio") * col("word_count") / 100 * confidence,
            "popularity_match": col("user_popularity") * col("product_popularity_count"),
            "diversity_match": col("user_product_diversity") * col("product_user_diversity"),
        }
    )


def interaction_features(df: DataFrame, users: DataFrame, products: DataFrame) -> DataFrame:
    """Joins the profiles (with rarity scores) and adds the pairwise products."""
    return pair_features(attach_products(attach_users(df, users), products))


def review_completeness(words: Column, chars: Column, helpful: Column) -> Column:
    return (
        (words > 10).cast("int") * F.lit(0.3)
        + (chars > 50).cast("int") * F.lit(0.3)
        + (helpful > 0.5).cast("int") * F.lit(0.4)
    )


def freshness(days: Column) -> Column:
    return F.when(days < 30, 1.0).when(days < 90, 0.7).otherwise(0.3)


def consistency(rating: Column, sentiment: Column) -> Column:
    agrees = ((rating >= 4) & (sentiment > 0)) | ((rating <= 2) & (sentiment < 0))
    return F.when(agrees, 1.0).when(rating == 3, 0.5).otherwise(0.0)


def content_features(df: DataFrame) -> DataFrame:
    """Content scores; text-derived columns come from ``add_text_scores`` or a joined text table."""
    col = F.col
    return df.withColumns(
        {
            "review_completeness": review_completeness(
                col("word_count"), col("char_count"), col("helpfulness_ratio")
            ),
            "rating_length_interaction": col("overall") * F.log1p(col("word_count")),
            "sentiment_length_correlation": col("sentiment_score") * col("word_count") / 100,
            "content_freshness": freshness(col("days_before_newest")),
            "rating_sentiment_consistency": consistency(col("overall"), col("sentiment_score")),
        }
    )


def add_text_scores(df: DataFrame, col: str = "reviewText_clean") -> DataFrame:
    return df.withColumns(
        {
            "text_complexity": text.text_complexity(F.col(col), cleaned=True),
            "sentiment_intensity": text.sentiment_intensity(F.col(col), cleaned=True),
        }
    )


def _oldest_first(ties: Sequence[str]) -> list[Column]:
    return [F.col("review_timestamp").asc(), *[F.col(c).asc() for c in ties]]


def user_rolling(
    df: DataFrame, ties: Sequence[str], n: int = 5, hot_rows: int | None = None, base: DataFrame | None = None
) -> DataFrame:
    """Rolling mean/std of rating, mean length and sentiment trend over the user's last n reviews."""

    def exprs(spec: W) -> dict[str, Column]:
        frame = spec.rowsBetween(-(n - 1), W.currentRow)
        return {
            "user_rolling_avg_rating": F.avg("overall").over(frame),
            "user_rolling_std_rating": F.stddev_samp("overall").over(frame),
            "user_rolling_avg_length": F.avg("word_count").over(frame),
            "user_rolling_sentiment_trend": F.col("sentiment_score") - F.first("sentiment_score").over(frame),
        }

    return ordered.sliding(df, ["reviewerID"], _oldest_first(ties), n, exprs, hot_rows, base=base)


def product_rolling(
    df: DataFrame, ties: Sequence[str], n: int = 10, hot_rows: int | None = None, base: DataFrame | None = None
) -> DataFrame:
    """Rolling mean rating, rating trend and mean reviewer activity over the product's last n reviews."""

    def exprs(spec: W) -> dict[str, Column]:
        frame = spec.rowsBetween(-(n - 1), W.currentRow)
        return {
            "product_rolling_avg_rating": F.avg("overall").over(frame),
            "product_rolling_rating_trend": F.col("overall") - F.first("overall").over(frame),
            "product_rolling_popularity_trend": F.avg("user_review_count").over(frame),
        }

    return ordered.sliding(df, ["asin"], _oldest_first(ties), n, exprs, hot_rows, base=base)


def vs_global(df: DataFrame, base: DataFrame | None = None) -> DataFrame:
    means = (df if base is None else base).agg(
        F.avg("overall").alias("__rating"), F.avg("word_count").alias("__length"),
        F.avg("sentiment_score").alias("__sentiment"),
    )
    return (
        attach_totals(df, means)
        .withColumns(
            {
                "rating_vs_global": F.col("overall") - F.col("__rating"),
                "length_vs_global": F.col("word_count") - F.col("__length"),
                "sentiment_vs_global": F.col("sentiment_score") - F.col("__sentiment"),
            }
        )
        .drop("__rating", "__length", "__sentiment")
    )


def percentile_ranks(df: DataFrame, cols: dict[str, str], base: DataFrame | None = None) -> DataFrame:
    """Adds the average-rank percentile of each column (``{column: new name}``).

    All columns are counted in one pass; each rank table has one row per
    distinct value and is joined on the value, so repeated values never meet in
    one window.
    """
    dist = ordered.distribution(ordered.unpivot(df if base is None else base, [], list(cols)), ["column"])
    out = df
    for col, name in cols.items():
        key = f"__value_{name}"
        ranks = dist.filter(F.col("column") == col).select(
            F.col("value").alias(key), ordered.rank_percent().alias(name)
        )
        out = out.join(ranks, F.col(col).cast("double") == F.col(key), "left").drop(key)
    return out


#: Columns of ``build_features`` that are made of ratings, the row's own among them: a model of the rating
#: must not see them, and a feature store for such a model does not carry them.
TARGET_DERIVED = (
    "sentiment_score", "user_avg_rating", "user_rating_std", "user_rolling_avg_rating", "user_rolling_std_rating",
    "user_rolling_sentiment_trend", "product_avg_rating", "product_rating_std", "product_rolling_avg_rating",
    "product_rolling_rating_trend", "rating_confidence", "engagement_intensity", "rating_length_interaction",
    "sentiment_length_correlation", "rating_sentiment_consistency", "rating_vs_global", "sentiment_vs_global",
    "rating_percentile",
)

PERCENTILES = {
    "overall": "rating_percentile",
    "word_count": "length_percentile",
    "helpfulness_ratio": "helpfulness_percentile",
}


def build_features(df: DataFrame, ties: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """Temporal, interaction, content, rolling, global and percentile features."""
    require(df, ["reviewerID", "asin", "overall", "review_timestamp", "word_count", "char_count",
                 "helpfulness_ratio", "sentiment_score", *ties])
    # Statistics are taken on the input frame, never on the widened one.
    users, products = user_profile(df), product_profile(df)
    # The rows move twice: once by user for the join and the user windows, once by product.
    out = attach_users(df, users).withColumn("user_review_count", F.col("user_popularity"))
    out = user_rolling(out, ties, hot_rows=hot_rows, base=df)
    out = attach_products(out, products)
    out = product_rolling(out, ["reviewerID", *[t for t in ties if t != "asin"]], hot_rows=hot_rows, base=df)
    # What follows from a row's own time is added after the rows have moved, in its old place.
    moved = out.columns
    out = out.transform(calendar_features).transform(season_flags).transform(cyclic).transform(recency, df)
    added, rest = out.columns[len(moved):], [c for c in moved if c not in df.columns]
    out = content_features(pair_features(out.select(*[c for c in moved if c in df.columns], *added, *rest)))
    return percentile_ranks(vs_global(out, df), PERCENTILES, df)
