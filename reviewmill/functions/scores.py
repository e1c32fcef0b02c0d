"""Scalar scores over rating, vote and time columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds as a zone-free timestamp (UTC wall clock, whatever the session zone)."""
    return F.expr(EPOCH) + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def timestamp_to_epoch(ts: Column) -> Column:
    return F.timestamp_diff("SECOND", F.expr(EPOCH), ts)


def whole_days(later: Column, earlier: Column) -> Column:
    """Elapsed whole days (floor of the time difference), unlike calendar ``datediff``."""
    return F.floor(F.timestamp_diff("SECOND", earlier, later) / F.lit(86400)).cast("int")


def rating_spread(rating: Column) -> Column:
    """Sample deviation of whole-number ratings from exact sums, so that no order of rows moves it; null below two."""
    n = F.count(rating).cast("double")
    rest = F.greatest(n * F.sum(rating * rating) - F.sum(rating) * F.sum(rating), F.lit(0.0))
    return F.when(n > 1, F.when(F.min(rating) == F.max(rating), 0.0).otherwise(F.sqrt(rest / (n * (n - 1)))))


def exact_mean(value: Column) -> Column:
    """Mean of doubles that no order of rows moves: the sum is taken in decimals, 12 behind the point.

    Where a value or the sum does not fit (above 10^26, NaN, infinity) it is the plain mean.
    """
    exact = value.try_cast("decimal(38,12)")
    whole = F.when(F.count(exact) == F.count(value), F.try_sum(exact).cast("double"))
    return F.coalesce(F.try_divide(whole, F.count(value).cast("double")), F.avg(value))


def rating_category(rating: Column) -> Column:
    return F.when(rating <= 2, "negative").when(rating == 3, "neutral").when(rating.isNotNull(), "positive")


def rating_sentiment(rating: Column) -> Column:
    return (
        F.when(rating.isNull(), 0.0).when(rating <= 2, -1.0).when(rating == 3, 0.0).otherwise(F.lit(1.0))
    )


def helpful_pair(votes: Column) -> Column:
    """[useful, total], or [0, 0] when the array is missing or short."""
    return F.when(F.size(votes) >= 2, F.slice(votes, 1, 2)).otherwise(F.array(F.lit(0), F.lit(0)))


def helpfulness_ratio(useful: Column, total: Column) -> Column:
    return F.when(total > 0, useful / total).otherwise(F.lit(0.0))


def engagement(useful: Column, total: Column) -> Column:
    return useful / F.greatest(total, F.lit(1))


def helpfulness_score(useful: Column, total: Column) -> Column:
    """Ratio weighted by the number of votes, full weight from ten votes on."""
    weight = F.least(total / F.lit(10.0), F.lit(1.0))
    return F.when(total > 0, useful / total * weight).otherwise(F.lit(0.0))


def popularity(count: Column, hi: int = 100, mid: int = 10) -> Column:
    return F.when(count >= hi, "high").when(count >= mid, "medium").otherwise("low")


def experience(count: Column, hi: int = 50, mid: int = 10) -> Column:
    return F.when(count >= hi, "expert").when(count >= mid, "intermediate").otherwise("beginner")


def review_quality(
    words: Column, helpful: Column, category: Column | None, min_words: int = 20
) -> Column:
    """Length factor x helpful factor x positive factor (the last one optional)."""
    score = F.when(words >= min_words, 1.0).otherwise(0.5) * F.when(helpful > 0.5, 1.2).otherwise(1.0)
    if category is not None:
        score = score * F.when(category == "positive", 1.1).otherwise(1.0)
    return score


def interaction_strength(rating: Column, helpful: Column, user_reviews: Column) -> Column:
    return rating * helpful * F.log(user_reviews + 1)


def weekday(ts: Column) -> Column:
    """Monday = 0."""
    return F.weekday(ts)
