"""Cleaning and enrichment queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewmill.functions import scores, text
from reviewmill.operators import cleaning, enrich
from reviewmill.operators.joins import attach_stats
from reviewmill.plans.registry import Catalog, r6, rounded
from reviewmill.plans.views import sql
from reviewmill.session import materialise
from reviewmill.sources import testviews as tv

catalog = Catalog()
AS_OF = "2002-01-01"
TIES_DESC = "review_timestamp desc, asin desc, overall desc, helpful_votes desc, total_votes desc, category desc, doc_id desc"
TIES_ASC = "review_timestamp, asin, overall, helpful_votes, total_votes, category, doc_id"

_CLEAN_SQL = """
select "reviewerID", asin, "reviewerName", helpful[1] as helpful_votes, helpful[2] as total_votes,
  md5("reviewText") as text_md5, overall, summary, "unixReviewTime", "reviewTime",
  cast(length("reviewText") as int) as review_length,
  cast(len(list_filter(string_split("reviewText", ' '), lambda x: x <> '')) as int) as review_word_count,
  round(case when helpful[2] > 0 then helpful[1] / helpful[2] else 0e0 end, 6) as helpful_ratio,
  year(d) as review_year, month(d) as review_month, isodow(d) - 1 as review_dayofweek,
  case when overall <= 2 then 'negative' when overall = 3 then 'neutral' else 'positive' end as rating_category
from (select *, timestamp '1970-01-01' + to_seconds("unixReviewTime") as d,
        row_number() over (partition by "reviewerID", asin, "unixReviewTime"
          order by overall, "reviewerName", helpful, "reviewText", summary, "reviewTime") as rn
      from checked where failed is null)
where rn = 1"""


@catalog.add("clean_reviews", sql(_CLEAN_SQL, "checked"))
def clean_reviews(spark, sf_dir):
    out = cleaning.clean_reviews(tv.raw_reviews(spark, sf_dir))
    return out.select(
        "reviewerID", "asin", "reviewerName", "helpful_votes", "total_votes",
        F.md5("reviewText").alias("text_md5"), "overall", "summary", "unixReviewTime", "reviewTime",
        "review_length", "review_word_count", r6("helpful_ratio").alias("helpful_ratio"),
        "review_year", "review_month", "review_dayofweek", "rating_category",
    )


@catalog.add("spam_flags", sql(
    """select doc_id, (length(t) < 10
      or len(list_distinct(string_split(t, ''))) < least(length(t), 95) * 0.1e0
      or length(regexp_replace(t, '[^A-Z]', '', 'g')) > length(t) * 0.9e0
      or regexp_matches(t, '(?i)http[s]?://\\S+|www\\.\\S+|click here|buy\\s+now|free\\s+trial|money\\s+back|\\.com')
    ) as is_spam from cleaned_docs""", "cleaned_docs"))
def spam_flags(spark, sf_dir):
    docs = tv.documents(spark, sf_dir).select("doc_id", text.clean_text(F.col("text")).alias("t"))
    return docs.select("doc_id", text.is_spam(F.col("t")).alias("is_spam"))


@catalog.add("dedup_reviews", sql("""
select "reviewerID", asin, review_timestamp, overall, helpful_votes, total_votes, category, doc_id from (
  select *, row_number() over (partition by "reviewerID", asin, review_timestamp
    order by overall, helpful_votes, total_votes, category, doc_id) as rn from reviews) where rn = 1""", "reviews"))
def dedup_reviews(spark, sf_dir):
    return cleaning.dedup_reviews(tv.reviews(spark, sf_dir), ["reviewerID", "asin", "review_timestamp"])


@catalog.add("cleaning_stats", sql("""
select count(*) as total_records,
  count(*) filter (failed = 'reviewer') as removed_reviewer, count(*) filter (failed = 'product') as removed_product,
  count(*) filter (failed = 'rating') as removed_rating, count(*) filter (failed = 'text') as removed_text,
  count(*) filter (failed = 'spam') as removed_spam, count(*) filter (failed = 'time') as removed_time,
  count(*) filter (failed is null)
    - count(distinct case when failed is null then ("reviewerID", asin, "unixReviewTime") end) as removed_duplicates,
  count(distinct case when failed is null then ("reviewerID", asin, "unixReviewTime") end) as cleaned_records,
  round(count(distinct case when failed is null then ("reviewerID", asin, "unixReviewTime") end) / count(*), 6)
    as retention_rate
from checked""", "checked"))
def cleaning_stats(spark, sf_dir):
    return rounded(cleaning.cleaning_stats(tv.raw_reviews(spark, sf_dir)), "retention_rate")


@catalog.add("text_features", sql("""
select doc_id, md5(t) as text_md5, word_count, char_count, round(avg_word_length, 6) as avg_word_length,
  cast(len(string_split(t, ' ')) as int) as word_count_by_space
from docs join cleaned_docs using (doc_id)""", "docs"))
def text_features(spark, sf_dir):
    docs = tv.documents(spark, sf_dir).select("doc_id", text.clean_text(F.col("text")).alias("t"))
    out = docs.withColumns(text.text_features(F.col("t")))
    return out.select(
        "doc_id", F.md5("t").alias("text_md5"), "word_count", "char_count",
        r6("avg_word_length").alias("avg_word_length"),
        text.word_count(F.col("t"), "space").alias("word_count_by_space"),
    )


@catalog.add("clean_text_basic", sql(r"""
select doc_id, md5(b) as text_md5, cast(len(string_split(b, ' ')) as int) as word_count
from (select doc_id, trim(regexp_replace(text, '[^\x20-\x7E]', '', 'g')) as b from documents)"""))
def clean_text_basic(spark, sf_dir):
    docs = tv.documents(spark, sf_dir).select("doc_id", text.clean_text_basic(F.col("text")).alias("b"))
    return docs.select("doc_id", F.md5("b").alias("text_md5"), text.word_count(F.col("b"), "space").alias("word_count"))


_ENRICH_SQL = f"""
, seq as (
  select f.*, row_number() over (partition by "reviewerID" order by {TIES_DESC}) as recency_rank,
    date_diff('day', lag(review_timestamp) over (partition by "reviewerID" order by {TIES_ASC})::date,
      review_timestamp::date) as days_since_last_review,
    count(*) over (partition by "reviewerID" order by review_timestamp desc
      range between unbounded preceding and current row) as user_total_reviews
  from frame f)
select s."reviewerID", s.asin, s.overall, s.helpful_votes, s.total_votes, s.review_timestamp, s.category, s.doc_id,
  word_count, char_count, recency_rank, cast(days_since_last_review as int) as days_since_last_review,
  user_total_reviews, user_review_count, round(user_avg_rating, 6) as user_avg_rating,
  round(user_rating_std, 6) as user_rating_std, user_first_review, user_last_review, product_review_count,
  round(product_avg_rating, 6) as product_avg_rating, round(product_rating_std, 6) as product_rating_std,
  round((s.overall - (select avg(overall) from reviews)) / (select stddev_samp(overall) from reviews), 6)
    as rating_zscore,
  cast(date_diff('day', s.review_timestamp::date, date '{AS_OF}') as int) as days_since_epoch,
  sentiment_score, rating_category, s.review_timestamp::date as review_date_only,
  round(helpful_votes / greatest(total_votes, 1), 6) as engagement_score,
  round(helpfulness_ratio, 6) as helpfulness_ratio,
  round(case when total_votes > 0 then helpful_votes / total_votes * least(total_votes / 10e0, 1e0) else 0e0 end, 6)
    as helpfulness_score,
  case when product_review_count >= 35 then 'high' when product_review_count >= 25 then 'medium' else 'low' end
    as product_popularity,
  case when user_review_count >= 50 then 'expert' when user_review_count >= 10 then 'intermediate'
    else 'beginner' end as user_experience,
  cast(date_diff('day', user_first_review::date, user_last_review::date) as int) as user_activity_days,
  round(case when word_count >= 20 then 1e0 else 0.5e0 end * case when helpfulness_ratio > 0.5 then 1.2e0 else 1e0 end
    * case when rating_category = 'positive' then 1.1e0 else 1e0 end, 6) as review_quality,
  round(s.overall * helpfulness_ratio * ln(user_review_count + 1), 6) as interaction_strength
from seq s join user_stats u on s."reviewerID" = u."reviewerID" join product_stats p on s.asin = p.asin"""


@catalog.add("enrich_reviews", sql(_ENRICH_SQL, "frame", "user_stats", "product_stats"))
def enrich_reviews(spark, sf_dir):
    source = tv.frame(spark, sf_dir).drop("helpfulness_ratio", "sentiment_score", "rating_category")
    # Stored once: timeline, statistics and the score pass over it, not over the joins behind it.
    out = enrich.enrich(materialise(source), AS_OF, tv.TIES, popularity_cuts=(35, 25))
    return rounded(
        out, "user_avg_rating", "user_rating_std", "product_avg_rating", "product_rating_std", "rating_zscore",
        "engagement_score", "helpfulness_ratio", "helpfulness_score", "review_quality", "interaction_strength",
    )


@catalog.add("recency_rank", sql(
    f"""select *, row_number() over (partition by "reviewerID" order by {TIES_DESC}) as recency_rank from reviews""",
    "reviews"))
def recency_rank(spark, sf_dir):
    return enrich.recency_rank(tv.reviews(spark, sf_dir), tv.TIES)


@catalog.add("review_gaps", sql(f"""
select *, cast(date_diff('day', lag(review_timestamp) over (partition by "reviewerID" order by {TIES_ASC})::date,
  review_timestamp::date) as int) as days_since_last_review from reviews""", "reviews"))
def review_gaps(spark, sf_dir):
    return enrich.days_between_reviews(tv.reviews(spark, sf_dir), tv.TIES)


@catalog.add("running_reviews", sql("""
select *, count(*) over (partition by "reviewerID" order by review_timestamp desc
  range between unbounded preceding and current row) as user_total_reviews from reviews""", "reviews"))
def running_reviews(spark, sf_dir):
    # Stored once: it is counted, then joined to the counts.
    return enrich.running_reviews(materialise(tv.reviews(spark, sf_dir)))


@catalog.add("product_stats", sql("""
select asin, product_review_count, round(product_avg_rating, 6) as product_avg_rating,
  round(product_rating_std, 6) as product_rating_std from product_stats""", "product_stats"))
def product_stats(spark, sf_dir):
    return rounded(enrich.product_stats(tv.reviews(spark, sf_dir)), "product_avg_rating", "product_rating_std")


@catalog.add("user_stats", sql("""
select "reviewerID", user_review_count, round(user_avg_rating, 6) as user_avg_rating,
  round(user_rating_std, 6) as user_rating_std, user_first_review, user_last_review from user_stats""", "user_stats"))
def user_stats(spark, sf_dir):
    return rounded(enrich.user_stats(tv.reviews(spark, sf_dir)), "user_avg_rating", "user_rating_std")


@catalog.add("attach_user_product_stats", sql("""
select r.*, user_review_count, round(user_avg_rating, 6) as user_avg_rating, product_review_count,
  round(product_avg_rating, 6) as product_avg_rating
from reviews r left join user_stats u on r."reviewerID" = u."reviewerID" left join product_stats p on r.asin = p.asin""",
    "user_stats", "product_stats"))
def attach_user_product_stats(spark, sf_dir):
    df = tv.reviews(spark, sf_dir)
    users = enrich.user_stats(df).select("reviewerID", "user_review_count", "user_avg_rating")
    products = enrich.product_stats(df).select("asin", "product_review_count", "product_avg_rating")
    out = attach_stats(attach_stats(df, users, "reviewerID"), products, "asin")
    return rounded(out, "user_avg_rating", "product_avg_rating")


@catalog.add("attach_product_stats_small", sql("""
select r.*, product_review_count, round(product_avg_rating, 6) as product_avg_rating
from reviews r left join product_stats p on r.asin is not distinct from p.asin""", "product_stats"))
def attach_product_stats_small(spark, sf_dir):
    """The product table is counted and sent to every executor if it has at most 100 000 rows, else shuffled."""
    df = tv.reviews(spark, sf_dir)
    products = enrich.product_stats(df).select("asin", "product_review_count", "product_avg_rating")
    return rounded(attach_stats(df, products, "asin", null_safe=True, broadcast_rows=100_000), "product_avg_rating")


@catalog.add("rating_zscores", sql("""
select "reviewerID", asin, doc_id, review_timestamp, round((overall - (select avg(overall) from reviews))
  / (select stddev_samp(overall) from reviews), 6) as rating_zscore from reviews""", "reviews"))
def rating_zscores(spark, sf_dir):
    out = enrich.zscore(tv.reviews(spark, sf_dir), "overall", "rating_zscore")
    return out.select("reviewerID", "asin", "doc_id", "review_timestamp", r6("rating_zscore").alias("rating_zscore"))


@catalog.add("vote_scores", sql("""
select "reviewerID", asin, doc_id, review_timestamp,
  round(helpful_votes / greatest(total_votes, 1), 6) as engagement_score,
  round(case when total_votes > 0 then helpful_votes / total_votes else 0e0 end, 6) as helpfulness_ratio,
  round(case when total_votes > 0 then helpful_votes / total_votes * least(total_votes / 10e0, 1e0) else 0e0 end, 6)
    as helpfulness_score,
  case when overall <= 2 then -1e0 when overall = 3 then 0e0 else 1e0 end as sentiment_score,
  epoch(review_timestamp)::bigint as "unixReviewTime" from reviews""", "reviews"))
def vote_scores(spark, sf_dir):
    df = tv.reviews(spark, sf_dir)
    h, t = F.col("helpful_votes"), F.col("total_votes")
    return df.select(
        "reviewerID", "asin", "doc_id", "review_timestamp",
        r6(scores.engagement(h, t)).alias("engagement_score"),
        r6(scores.helpfulness_ratio(h, t)).alias("helpfulness_ratio"),
        r6(scores.helpfulness_score(h, t)).alias("helpfulness_score"),
        scores.rating_sentiment(F.col("overall")).alias("sentiment_score"),
        scores.timestamp_to_epoch(F.col("review_timestamp")).alias("unixReviewTime"),
    )
