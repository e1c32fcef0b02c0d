"""Cleaning of raw review records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions import scores, text
from reviewmill.schemas import REVIEW_KEY, require

MIN_TIME = 788918400  # 1995-01-01 00:00:00 UTC
MAX_TIME = 1767139200  # 2025-12-31 00:00:00 UTC


def clean_reviewer_name(name: Column) -> Column:
    kept = F.regexp_replace(F.coalesce(name, F.lit("Anonymous")), r"(?U)[^\w\s]", "")
    return text.strip(kept)


def valid_name(name: Column) -> Column:
    return F.length(name) > 1


def valid_reviewer(reviewer: Column) -> Column:
    return F.coalesce(reviewer.rlike("^[A-Z0-9]+$"), F.lit(False))


def valid_asin(asin: Column) -> Column:
    return F.coalesce(asin.rlike("^[A-Z0-9]{10}$"), F.lit(False))


def valid_rating(rating: Column) -> Column:
    return F.coalesce(rating.between(1, 5), F.lit(False))


def clean_summary(summary: Column, limit: int = 100, default: str = "") -> Column:
    return F.coalesce(F.substring(text.clean_text(summary), 1, limit), F.lit(default))


def valid_text(raw: Column, cleaned: Column, min_len: int = 10) -> Column:
    return raw.isNotNull() & (F.length(cleaned) >= min_len)


def valid_time(seconds: Column, lo: int = MIN_TIME, hi: int = MAX_TIME) -> Column:
    return F.coalesce(seconds.between(lo, hi), F.lit(False))


def parse_review_time(value: Column) -> Column:
    return F.try_to_date(value, "M d, yyyy")


def normalise(df: DataFrame) -> DataFrame:
    """Cleaned values next to the untouched key columns; no row is removed."""
    require(df, ["reviewerID", "asin", "reviewerName", "helpful", "reviewText", "overall", "summary",
                 "unixReviewTime", "reviewTime"])
    return df.withColumns(
        {
            "reviewerName": clean_reviewer_name(F.col("reviewerName")),
            "helpful": scores.helpful_pair(F.col("helpful")),
            "__had_text": F.col("reviewText").isNotNull(),
            "reviewText": text.clean_text(F.col("reviewText")),
            "summary": clean_summary(F.col("summary")),
            "reviewTime": parse_review_time(F.col("reviewTime")),
        }
    )


def rules(min_unique_ratio: float = 0.1) -> list[tuple[str, Column]]:
    """(step, keep-condition) in the order the steps are applied."""
    col = F.col
    return [
        ("reviewer", valid_name(col("reviewerName")) & valid_reviewer(col("reviewerID"))),
        ("product", valid_asin(col("asin"))),
        ("rating", valid_rating(col("overall"))),
        ("text", col("__had_text") & (F.length("reviewText") >= 10)),
        ("spam", ~text.is_spam(col("reviewText"), min_unique_ratio=min_unique_ratio)),
        ("time", valid_time(col("unixReviewTime")) & col("reviewTime").isNotNull()),
    ]


def dedup_reviews(df: DataFrame, keys: Sequence[str] = REVIEW_KEY, keep: Column | None = None) -> DataFrame:
    """One row per key: the smallest by content, so the choice never depends on row placement.

    An aggregate rather than a window: copies shrink before the shuffle, so a
    key that owns a third of all rows costs one row per map task. Rows that
    fail ``keep`` take no part; judging them here, behind the projection,
    evaluates an expensive condition once instead of pushing copies of it
    down into the scan.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*rest)
    best = df.groupBy(*keys).agg(F.min(row if keep is None else F.when(keep, row)).alias("__row"))
    if keep is not None:
        best = best.filter(F.col("__row").isNotNull())
    return best.select(*keys, "__row.*").select(*df.columns)


def add_derived(df: DataFrame) -> DataFrame:
    when = scores.epoch_to_timestamp(F.col("unixReviewTime"))
    return df.withColumns(
        {
            "review_length": F.length("reviewText"),
            "review_word_count": text.word_count(F.col("reviewText"), cleaned=True),
            "helpful_votes": F.element_at("helpful", 1),
            "total_votes": F.element_at("helpful", 2),
            "helpful_ratio": scores.helpfulness_ratio(F.element_at("helpful", 1), F.element_at("helpful", 2)),
            "review_date": when,
            "review_year": F.year(when),
            "review_month": F.month(when),
            "review_dayofweek": scores.weekday(when),
            "rating_category": scores.rating_category(F.col("overall")),
        }
    )


def clean_reviews(df: DataFrame, min_unique_ratio: float = 0.1) -> DataFrame:
    """All steps (their order only matters for ``cleaning_stats``), then dedup and derived columns."""
    steps = dict(rules(min_unique_ratio))
    # Conditions on ids, rating and time are cheap and reach the scan.
    cheap = steps["product"] & steps["rating"] & valid_reviewer(F.col("reviewerID")) & valid_time(F.col("unixReviewTime"))
    judged = normalise(df.filter(cheap))
    keep = F.lit(True)
    for condition in steps.values():
        keep = keep & condition
    judged = judged.withColumn("__keep", keep).drop("__had_text")
    kept = dedup_reviews(judged, keep=F.col("__keep")).drop("__keep")
    return add_derived(kept)


def cleaning_stats(df: DataFrame, min_unique_ratio: float = 0.1) -> DataFrame:
    """Rows removed by each step (a row counts for the first step it fails) and the retention rate."""
    steps = rules(min_unique_ratio)
    first = F.coalesce(*[F.when(~condition, name) for name, condition in steps])
    failed = normalise(df).select(first.alias("failed"), *REVIEW_KEY)
    ok = F.col("failed").isNull()
    out = failed.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.count_if(F.col("failed") == name).alias(f"removed_{name}") for name, _ in steps],
        F.count_if(ok).alias("__passed"),
        F.count_distinct(F.when(ok, F.struct(*REVIEW_KEY))).alias("cleaned_records"),
    )
    return out.select(
        "total_records",
        *[f"removed_{name}" for name, _ in steps],
        (F.col("__passed") - F.col("cleaned_records")).alias("removed_duplicates"),
        "cleaned_records",
        F.try_divide("cleaned_records", "total_records").alias("retention_rate"),
    )
