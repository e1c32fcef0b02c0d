"""Adapters that give the driver's tables the shape of product reviews.

Each adapter has a DuckDB twin in ``reviewmill.plans.views``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions import scores, text
from reviewmill.operators.joins import attach_totals
from reviewmill.session import materialise
from reviewmill.sources.readers import spread_small

TIES = ("asin", "overall", "helpful_votes", "total_votes", "category", "doc_id")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per order line: customer = reviewer, part = product."""
    lines, orders = spread_small(table(spark, sf_dir, "lineitem")), table(spark, sf_dir, "orders")
    docs = table(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("__docs"))
    bucket = F.col("l_quantity").cast("int") % 20
    rating = (
        F.when(bucket == 0, 1)
        .when(bucket == 1, 2)
        .when(bucket.isin(2, 3), 3)
        .when(bucket.between(4, 7), 4)
        .otherwise(5)
    )
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return attach_totals(joined, docs).select(
        F.concat(F.lit("A"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("reviewerID"),
        F.concat(F.lit("B"), F.lpad(F.col("l_partkey").cast("string"), 9, "0")).alias("asin"),
        rating.cast("double").alias("overall"),
        F.least(F.round(F.col("l_discount") * 100).cast("int"), F.col("l_linenumber") - 1).alias(
            "helpful_votes"
        ),
        (F.col("l_linenumber") - 1).alias("total_votes"),
        F.col("l_shipdate").alias("review_timestamp"),
        F.when(F.col("l_partkey") % 2 == 0, "electronics").otherwise("clothing").alias("category"),
        (F.col("l_orderkey") % F.col("__docs")).alias("doc_id"),
    )


def categories(df: DataFrame) -> list[str | None]:
    """The datasets that the rows name, in order; there are a few of them, each with a report of its own."""
    return [r["category"] for r in df.select("category").distinct().orderBy("category").collect()]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, spread over the cores when the scan alone gives fewer tasks than that.

    A single-row-group file is one task; a table large enough to matter has
    more splits than cores and is left as scanned.
    """
    docs = table(spark, sf_dir, "documents")
    return spread_small(docs)


def document_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text features once per document; reviews join them by doc_id."""
    return text_columns(documents(spark, sf_dir), "doc_id")


def text_columns(docs: DataFrame, *kept: str) -> DataFrame:
    """The kept columns of ``docs`` and the features of their text."""
    cleaned = docs.select(*kept, text.clean_text(F.col("text")).alias("__t"))
    body = F.col("__t")
    return cleaned.select(
        *kept,
        *[c.alias(n) for n, c in text.text_features(body, cleaned=True).items()],
        text.text_complexity(body, cleaned=True).alias("text_complexity"),
        text.sentiment_intensity(body, cleaned=True).alias("sentiment_intensity"),
    )


def frame(spark: SparkSession, sf_dir: str, intensity: bool = False) -> DataFrame:
    """Reviews with text counts, helpfulness and rating-based sentiment."""
    docs = document_features(spark, sf_dir)
    if not intensity:
        docs = docs.select("doc_id", "word_count", "char_count")
    joined = reviews(spark, sf_dir).join(docs, "doc_id", "left")
    return joined.withColumns(
        {
            "helpfulness_ratio": scores.helpfulness_ratio(F.col("helpful_votes"), F.col("total_votes")),
            "sentiment_score": scores.rating_sentiment(F.col("overall")),
            "rating_category": scores.rating_category(F.col("overall")),
        }
    )


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``frame`` with review counts and buckets of user and product (cuts that fit the tables)."""
    # Stored once: the counts of either side and the rows would each make the joins and the text features again.
    df = materialise(frame(spark, sf_dir))
    users = df.groupBy("reviewerID").agg(F.count(F.lit(1)).alias("user_review_count"))
    products = df.groupBy("asin").agg(F.count(F.lit(1)).alias("product_review_count"))
    out = df.join(users, "reviewerID", "left").join(products, "asin", "left")
    return out.withColumns(
        {
            "user_experience": scores.experience(F.col("user_review_count")),
            "product_popularity": scores.popularity(F.col("product_review_count"), 35, 25),
        }
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw record per document, with every kind of dirt the cleaning removes."""
    d = F.col("doc_id")
    key = F.when(d % 23 == 1, d - 1).otherwise(d)
    pad = F.lpad(key.cast("string"), 9, "0")
    seconds = (F.lit(900000000) + key * 86400).cast("long")
    day = scores.epoch_to_timestamp(seconds)
    return documents(spark, sf_dir).select(
        F.when(d % 37 == 5, F.lower(F.concat(F.lit("a"), pad)))
        .when(d % 41 == 7, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("A"), pad))
        .alias("reviewerID"),
        F.when(d % 43 == 3, F.concat(F.lit("B"), F.substring(pad, 2, 8)))
        .otherwise(F.concat(F.lit("B"), pad))
        .alias("asin"),
        F.when(d % 29 == 2, F.lit(None).cast("string"))
        .when(d % 31 == 4, F.lit("!"))
        .otherwise(F.concat(F.lit("  Jo. "), F.col("lang"), F.lit("-"), F.col("source"), F.lit(" é ")))
        .alias("reviewerName"),
        F.when(d % 19 == 6, F.lit(None).cast("array<int>"))
        .when(d % 19 == 8, F.array((d % 7).cast("int")))
        .otherwise(F.array((d % 5).cast("int"), (d % 5 + d % 3).cast("int")))
        .alias("helpful"),
        F.when(d % 47 == 9, F.lit(None).cast("string")).otherwise(F.col("text")).alias("reviewText"),
        F.when(d % 53 == 10, F.lit(None).cast("double"))
        .otherwise((key % 7).cast("double"))
        .alias("overall"),
        F.col("text").alias("summary"),
        F.when(d % 59 == 11, F.lit(100000000).cast("long")).otherwise(seconds).alias("unixReviewTime"),
        F.when(d % 61 == 12, F.lit("not a date"))
        .otherwise(F.date_format(day, "MM dd, yyyy"))
        .alias("reviewTime"),
    )


def ab_metrics(spark: SparkSession, sf_dir: str, split: float = 0.5) -> DataFrame:
    """Per-user metric log of an experiment over the event stream."""
    from reviewmill.operators import experiments

    events = table(spark, sf_dir, "events").withColumn(
        "user_id", F.concat(F.lit("user_"), F.col("user_id").cast("string"))
    )
    kind = F.col("event_type")
    views, clicks = F.count_if(kind == "view"), F.count_if(kind == "click")
    buys = F.count_if(kind == "purchase")
    per_user = events.groupBy("user_id").agg(
        F.try_divide(clicks, views + clicks).alias("ctr"),
        F.try_divide(buys, views + buys).alias("conversion"),
        scores.exact_mean(F.col("value")).alias("value"),
    )
    long = per_user.select(
        "user_id",
        F.explode(
            F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("v")) for m in ("ctr", "conversion", "value")])
        ).alias("__m"),
    ).select("user_id", "__m.metric", F.col("__m.v").alias("value"))
    return experiments.assign(long.filter(F.col("value").isNotNull()), split)
