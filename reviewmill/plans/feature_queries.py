"""Feature engineering queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from reviewmill.operators import features, selection
from reviewmill.plans.etl_queries import TIES_ASC
from reviewmill.plans.registry import Catalog, r6, rounded
from reviewmill.plans.views import sql
from reviewmill.sources import testviews as tv
from reviewmill.session import materialise, shared_folder
from reviewmill.sources import writers

catalog = Catalog()
ID = ("reviewerID", "asin", "doc_id", "review_timestamp")
ID_SQL = '"reviewerID", asin, doc_id, review_timestamp'


@catalog.add("calendar_features", sql(f"""
select {ID_SQL}, year(review_timestamp) as review_year, month(review_timestamp) as review_month,
  day(review_timestamp) as review_day, isodow(review_timestamp) - 1 as review_weekday,
  hour(review_timestamp) as review_hour, dayofyear(review_timestamp) as review_dayofyear,
  (isodow(review_timestamp) >= 6)::int as is_weekend,
  (month(review_timestamp) in (11, 12, 1, 7, 8))::int as is_holiday from reviews""", "reviews"))
def calendar_features(spark, sf_dir):
    out = features.season_flags(features.calendar_features(tv.reviews(spark, sf_dir)))
    return out.drop("overall", "helpful_votes", "total_votes", "category")


@catalog.add("cyclic_features", sql(f"""
select {ID_SQL}, round(sin(2 * pi() * month(review_timestamp) / 12), 6) as month_sin,
  round(cos(2 * pi() * month(review_timestamp) / 12), 6) as month_cos,
  round(sin(2 * pi() * (isodow(review_timestamp) - 1) / 7), 6) as weekday_sin,
  round(cos(2 * pi() * (isodow(review_timestamp) - 1) / 7), 6) as weekday_cos from reviews""", "reviews"))
def cyclic_features(spark, sf_dir):
    out = features.cyclic(features.calendar_features(tv.reviews(spark, sf_dir)))
    cols = ("month_sin", "month_cos", "weekday_sin", "weekday_cos")
    return out.select(*ID, *[r6(c).alias(c) for c in cols])


@catalog.add("recency_features", sql(f"""
select {ID_SQL}, cast(floor((epoch(m) - epoch(review_timestamp)) / 86400) as int) as days_before_newest,
  cast(floor(floor((epoch(m) - epoch(review_timestamp)) / 86400) / 7) as int) as weeks_before_newest
from reviews, (select max(review_timestamp) as m from reviews)""", "reviews"))
def recency_features(spark, sf_dir):
    return features.recency(tv.reviews(spark, sf_dir)).select(*ID, "days_before_newest", "weeks_before_newest")


_USERS = """
select "reviewerID", count(*) as user_popularity,
  cast(floor((epoch(max(review_timestamp)) - epoch(min(review_timestamp))) / 86400) as int) as user_activity_days,
  round(count(*) / (floor((epoch(max(review_timestamp)) - epoch(min(review_timestamp))) / 86400) + 1), 6)
    as user_review_frequency,
  count(distinct asin) as user_product_diversity, round(avg(overall), 6) as user_avg_rating,
  round(stddev_samp(overall), 6) as user_rating_std from reviews group by 1"""


@catalog.add("user_activity", sql(_USERS, "reviews"))
def user_activity(spark, sf_dir):
    out = features.user_profile(tv.reviews(spark, sf_dir))
    return rounded(out, "user_review_frequency", "user_avg_rating", "user_rating_std")


@catalog.add("product_lifetime", sql("""
select asin, count(*) as product_popularity_count,
  cast(floor((epoch(max(review_timestamp)) - epoch(min(review_timestamp))) / 86400) as int) as product_lifetime_days,
  count(distinct "reviewerID") as product_user_diversity, round(avg(overall), 6) as product_avg_rating,
  round(stddev_samp(overall), 6) as product_rating_std from reviews group by 1""", "reviews"))
def product_lifetime(spark, sf_dir):
    return rounded(features.product_profile(tv.reviews(spark, sf_dir)), "product_avg_rating", "product_rating_std")


_INTERACT = """
, u as (select "reviewerID", count(*) as un, count(distinct asin) as ud, avg(overall) as ua, stddev_samp(overall) as us
        from frame group by 1),
p as (select asin, count(*) as pn, count(distinct "reviewerID") as pd, avg(overall) as pa, stddev_samp(overall) as ps
      from frame group by 1),
ur as (select *, (rank() over (order by un) + (count(*) over (partition by un) - 1) / 2e0) / count(*) over () as urs from u),
pr as (select *, (rank() over (order by pn) + (count(*) over (partition by pn) - 1) / 2e0) / count(*) over () as prs from p),
joined as (select f.*, ur.* exclude ("reviewerID"), pr.* exclude (asin),
  case when us < 1.5 and ps < 1.5 then 1e0 when us < 2 and ps < 2 then 0.7e0 else 0.3e0 end as conf
  from frame f join ur on f."reviewerID" = ur."reviewerID" join pr on f.asin = pr.asin)
"""


@catalog.add("rarity_scores", sql(_INTERACT + """
select 'user' as kind, "reviewerID" as id, un as reviews, round(urs, 6) as rarity_score from ur
union all select 'product', asin, pn, round(prs, 6) from pr""", "frame"))
def rarity_scores(spark, sf_dir):
    df = tv.reviews(spark, sf_dir)
    parts = []
    for kind, key in (("user", "reviewerID"), ("product", "asin")):
        per = df.groupBy(key).agg(F.count(F.lit(1)).alias("reviews"))
        ranked = features.rarity(per, "reviews", "rarity_score")
        parts.append(ranked.select(F.lit(kind).alias("kind"), F.col(key).alias("id"), "reviews",
                                   r6("rarity_score").alias("rarity_score")))
    return parts[0].unionByName(parts[1])


@catalog.add("diversity_consensus", sql(_INTERACT + f"""
select {ID_SQL}, ud as user_product_diversity, round(ua, 6) as user_avg_rating, round(us, 6) as user_rating_std,
  pd as product_user_diversity, round(pa, 6) as product_avg_rating, round(ps, 6) as product_rating_std,
  conf as rating_confidence, round(helpfulness_ratio * word_count / 100 * conf, 6) as engagement_intensity,
  un * pn as popularity_match, ud * pd as diversity_match, round(urs, 6) as user_rarity_score,
  round(prs, 6) as product_rarity_score from joined""", "frame"))
def diversity_consensus(spark, sf_dir):
    df = tv.frame(spark, sf_dir)
    out = features.interaction_features(df, features.user_profile(df), features.product_profile(df))
    return rounded(
        out.select(*ID, "user_product_diversity", "user_avg_rating", "user_rating_std", "product_user_diversity",
                   "product_avg_rating", "product_rating_std", "rating_confidence", "engagement_intensity",
                   "popularity_match", "diversity_match", "user_rarity_score", "product_rarity_score"),
        "user_avg_rating", "user_rating_std", "product_avg_rating", "product_rating_std", "engagement_intensity",
        "user_rarity_score", "product_rarity_score",
    )


@catalog.add("rating_confidence", sql(_INTERACT + """
select conf as rating_confidence, count(*) as reviews from joined group by 1""", "frame"))
def rating_confidence(spark, sf_dir):
    df = tv.reviews(spark, sf_dir)
    users = features.user_profile(df).select("reviewerID", "user_rating_std")
    products = features.product_profile(df).select("asin", "product_rating_std")
    joined = df.join(users, "reviewerID", "left").join(products, "asin", "left")
    level = features.rating_confidence(F.col("user_rating_std"), F.col("product_rating_std"))
    return joined.groupBy(level.alias("rating_confidence")).agg(F.count(F.lit(1)).alias("reviews"))


@catalog.add("text_complexity", sql("select doc_id, round(text_complexity, 6) as text_complexity from docs", "docs"))
def text_complexity(spark, sf_dir):
    return rounded(tv.document_features(spark, sf_dir).select("doc_id", "text_complexity"), "text_complexity")


@catalog.add("sentiment_intensity", sql(
    "select doc_id, round(sentiment_intensity, 6) as sentiment_intensity from docs", "docs"))
def sentiment_intensity(spark, sf_dir):
    return rounded(tv.document_features(spark, sf_dir).select("doc_id", "sentiment_intensity"), "sentiment_intensity")


@catalog.add("content_features", sql(f"""
select {ID_SQL}, round((word_count > 10)::int * 0.3e0 + (char_count > 50)::int * 0.3e0
    + (helpfulness_ratio > 0.5)::int * 0.4e0, 6) as review_completeness,
  round(overall * ln(1 + word_count), 6) as rating_length_interaction,
  round(sentiment_score * word_count / 100, 6) as sentiment_length_correlation,
  case when dd < 30 then 1e0 when dd < 90 then 0.7e0 else 0.3e0 end as content_freshness,
  case when (overall >= 4 and sentiment_score > 0) or (overall <= 2 and sentiment_score < 0) then 1e0
    when overall = 3 then 0.5e0 else 0e0 end as rating_sentiment_consistency
from (select *, floor((epoch(max(review_timestamp) over ()) - epoch(review_timestamp)) / 86400) as dd from frame)""",
    "frame"))
def content_features(spark, sf_dir):
    out = features.content_features(features.recency(tv.frame(spark, sf_dir)))
    cols = ("review_completeness", "rating_length_interaction", "sentiment_length_correlation")
    return out.select(*ID, *[r6(c).alias(c) for c in cols], "content_freshness", "rating_sentiment_consistency")


@catalog.add("user_rolling", sql(f"""
select {ID_SQL}, round(avg(overall) over w, 6) as user_rolling_avg_rating,
  round(stddev_samp(overall) over w, 6) as user_rolling_std_rating,
  round(avg(word_count) over w, 6) as user_rolling_avg_length,
  sentiment_score - first_value(sentiment_score) over w as user_rolling_sentiment_trend from frame
window w as (partition by "reviewerID" order by {TIES_ASC} rows between 4 preceding and current row)""", "frame"))
def user_rolling(spark, sf_dir):
    out = features.user_rolling(tv.frame(spark, sf_dir), tv.TIES)
    out = out.select(*ID, "user_rolling_avg_rating", "user_rolling_std_rating", "user_rolling_avg_length",
                     "user_rolling_sentiment_trend")
    return rounded(out, "user_rolling_avg_rating", "user_rolling_std_rating", "user_rolling_avg_length")


@catalog.add("product_rolling", sql("""
select "reviewerID", asin, doc_id, review_timestamp, round(avg(overall) over w, 6) as product_rolling_avg_rating,
  overall - first_value(overall) over w as product_rolling_rating_trend,
  round(avg(user_review_count) over w, 6) as product_rolling_popularity_trend from profile
window w as (partition by asin
  order by review_timestamp, "reviewerID", overall, helpful_votes, total_votes, category, doc_id
  rows between 9 preceding and current row)""", "profile"))
def product_rolling(spark, sf_dir):
    ties = ["reviewerID", *[t for t in tv.TIES if t != "asin"]]
    out = features.product_rolling(tv.profile(spark, sf_dir), ties)
    out = out.select(*ID, "product_rolling_avg_rating", "product_rolling_rating_trend",
                     "product_rolling_popularity_trend")
    return rounded(out, "product_rolling_avg_rating", "product_rolling_popularity_trend")


@catalog.add("vs_global", sql(f"""
select {ID_SQL}, round(overall - avg(overall) over (), 6) as rating_vs_global,
  round(word_count - avg(word_count) over (), 6) as length_vs_global,
  round(sentiment_score - avg(sentiment_score) over (), 6) as sentiment_vs_global from frame""", "frame"))
def vs_global(spark, sf_dir):
    out = features.vs_global(tv.frame(spark, sf_dir))
    cols = ("rating_vs_global", "length_vs_global", "sentiment_vs_global")
    return out.select(*ID, *[r6(c).alias(c) for c in cols])


def _pct(col: str) -> str:
    return (f"round((rank() over (order by {col}) + (count(*) over (partition by {col}) - 1) / 2e0)"
            f" / count(*) over (), 6)")


@catalog.add("percentile_ranks", sql(f"""
select {ID_SQL}, {_pct('overall')} as rating_percentile, {_pct('word_count')} as length_percentile,
  {_pct('helpfulness_ratio')} as helpfulness_percentile from frame""", "frame"))
def percentile_ranks(spark, sf_dir):
    out = features.percentile_ranks(tv.frame(spark, sf_dir), features.PERCENTILES)
    return out.select(*ID, *[r6(c).alias(c) for c in features.PERCENTILES.values()])


_SEL = ("helpful_votes", "total_votes", "word_count", "char_count", "helpfulness_ratio", "sentiment_score",
        "user_review_count", "product_review_count")


@catalog.add("select_by_variance", sql("\nunion all\n".join(
    f"""select '{c}' as feature, round(var_pop(coalesce({c}, 0)), 6) as variance,
      var_pop(coalesce({c}, 0)) > 0.1 as selected from profile""" for c in _SEL), "profile"))
def select_by_variance(spark, sf_dir):
    return rounded(selection.variance_scores(tv.profile(spark, sf_dir), _SEL, 0.1), "variance")


@catalog.add("select_k_best", sql(
    ", f as (" + "\nunion all\n".join(f"""
select '{c}' as feature, (sum(n * m * m) - sum(n * m) * sum(n * m) / sum(n)) / (count(*) - 1)
  / (sum(n * v) / (sum(n) - count(*))) as f_score from (
  select overall, count(*)::double as n, avg({c}) as m, var_pop({c}) as v from profile group by 1)""" for c in _SEL)
    + """) select feature, round(f_score, 4) as f_score from f order by f.f_score desc, feature limit 5""", "profile"))
def select_k_best(spark, sf_dir):
    scored = selection.anova_scores(tv.profile(spark, sf_dir), _SEL, "overall")
    best = selection.top_features(scored, "f_score", 5)
    return best.withColumn("f_score", F.round("f_score", 4))


@catalog.add("select_by_corr", sql(
    ", f as (" + "\nunion all\n".join(
        f"select '{c}' as feature, abs(corr({c}, overall)) as correlation from profile" for c in _SEL)
    + """) select feature, round(correlation, 6) as correlation from f order by f.correlation desc, feature limit 5""",
    "profile"))
def select_by_corr(spark, sf_dir):
    scored = selection.corr_scores(tv.profile(spark, sf_dir), _SEL, "overall")
    return rounded(selection.top_features(scored, "correlation", 5), "correlation")


@catalog.add("scale_standard", sql(f"""
select {ID_SQL}, round((word_count - avg(word_count) over ()) / stddev_pop(word_count) over (), 6) as word_count_scaled,
  round((helpfulness_ratio - avg(helpfulness_ratio) over ()) / stddev_pop(helpfulness_ratio) over (), 6)
    as helpfulness_ratio_scaled from frame""", "frame"))
def scale_standard(spark, sf_dir):
    out = selection.scale(tv.frame(spark, sf_dir), ["word_count", "helpfulness_ratio"], "standard")
    return out.select(*ID, r6("word_count_scaled").alias("word_count_scaled"),
                      r6("helpfulness_ratio_scaled").alias("helpfulness_ratio_scaled"))


@catalog.add("scale_minmax", sql(f"""
select {ID_SQL}, round((word_count - min(word_count) over ()) / (max(word_count) over () - min(word_count) over ()), 6)
  as word_count_scaled, 0e0 as constant_scaled from frame""", "frame"))
def scale_minmax(spark, sf_dir):
    df = tv.frame(spark, sf_dir).withColumn("constant", F.lit(7.0))
    out = selection.scale(df, ["word_count", "constant"], "minmax")
    return out.select(*ID, r6("word_count_scaled").alias("word_count_scaled"), "constant_scaled")


_BUILD = _INTERACT + f"""
, b as (select j.*, year(review_timestamp) as ry, month(review_timestamp) as rm, isodow(review_timestamp) - 1 as wd,
    floor((epoch(max(review_timestamp) over ()) - epoch(review_timestamp)) / 86400) as dd,
    min(review_timestamp) over pu as u0, max(review_timestamp) over pu as u1,
    min(review_timestamp) over pp as p0, max(review_timestamp) over pp as p1
  from joined j window pu as (partition by "reviewerID"), pp as (partition by asin))
select {ID_SQL}, overall, category, helpful_votes, total_votes, word_count, char_count, sentiment_score, rating_category,
  round(avg_word_length, 6) as avg_word_length,
  round(helpfulness_ratio, 6) as helpfulness_ratio, round(text_complexity, 6) as text_complexity,
  round(sentiment_intensity, 6) as sentiment_intensity, ry as review_year, rm as review_month,
  day(review_timestamp) as review_day, wd as review_weekday, hour(review_timestamp) as review_hour,
  dayofyear(review_timestamp) as review_dayofyear, (wd >= 5)::int as is_weekend,
  (rm in (11, 12, 1, 7, 8))::int as is_holiday, round(sin(2 * pi() * rm / 12), 6) as month_sin,
  round(cos(2 * pi() * rm / 12), 6) as month_cos, round(sin(2 * pi() * wd / 7), 6) as weekday_sin,
  round(cos(2 * pi() * wd / 7), 6) as weekday_cos, dd::int as days_before_newest, floor(dd / 7)::int as weeks_before_newest,
  un as user_popularity, floor((epoch(u1) - epoch(u0)) / 86400)::int as user_activity_days,
  round(un / (floor((epoch(u1) - epoch(u0)) / 86400) + 1), 6) as user_review_frequency, ud as user_product_diversity,
  round(ua, 6) as user_avg_rating, round(us, 6) as user_rating_std, round(urs, 6) as user_rarity_score,
  un as user_review_count, pn as product_popularity_count,
  floor((epoch(p1) - epoch(p0)) / 86400)::int as product_lifetime_days, pd as product_user_diversity,
  round(pa, 6) as product_avg_rating, round(ps, 6) as product_rating_std, round(prs, 6) as product_rarity_score,
  round(avg(overall) over wu, 6) as user_rolling_avg_rating, round(stddev_samp(overall) over wu, 6) as user_rolling_std_rating,
  round(avg(word_count) over wu, 6) as user_rolling_avg_length,
  sentiment_score - first_value(sentiment_score) over wu as user_rolling_sentiment_trend,
  round(avg(overall) over wp, 6) as product_rolling_avg_rating, overall - first_value(overall) over wp
    as product_rolling_rating_trend, round(avg(un) over wp, 6) as product_rolling_popularity_trend,
  conf as rating_confidence, round(helpfulness_ratio * word_count / 100 * conf, 6) as engagement_intensity,
  un * pn as popularity_match, ud * pd as diversity_match,
  round((word_count > 10)::int * 0.3e0 + (char_count > 50)::int * 0.3e0 + (helpfulness_ratio > 0.5)::int * 0.4e0, 6)
    as review_completeness, round(overall * ln(1 + word_count), 6) as rating_length_interaction,
  round(sentiment_score * word_count / 100, 6) as sentiment_length_correlation,
  case when dd < 30 then 1e0 when dd < 90 then 0.7e0 else 0.3e0 end as content_freshness,
  case when (overall >= 4 and sentiment_score > 0) or (overall <= 2 and sentiment_score < 0) then 1e0
    when overall = 3 then 0.5e0 else 0e0 end as rating_sentiment_consistency,
  round(overall - avg(overall) over (), 6) as rating_vs_global, round(word_count - avg(word_count) over (), 6) as length_vs_global,
  round(sentiment_score - avg(sentiment_score) over (), 6) as sentiment_vs_global,
  {_pct('overall')} as rating_percentile, {_pct('word_count')} as length_percentile,
  {_pct('helpfulness_ratio')} as helpfulness_percentile
from b window wu as (partition by "reviewerID" order by {TIES_ASC} rows between 4 preceding and current row),
  wp as (partition by asin order by review_timestamp, "reviewerID", overall, helpful_votes, total_votes, category, doc_id
    rows between 9 preceding and current row)"""


@catalog.add("build_features", sql(_BUILD, "frame"))
def build_features(spark, sf_dir):
    out = features.build_features(materialise(tv.frame(spark, sf_dir, intensity=True)), tv.TIES)
    doubles = [name for name, kind in out.dtypes if kind == "double"]
    return rounded(out, *doubles)


_CANDIDATES = (
    "helpful_votes", "total_votes", "word_count", "char_count", "avg_word_length", "text_complexity",
    "sentiment_intensity", "helpfulness_ratio", "review_year", "review_month", "review_day", "review_weekday",
    "review_hour", "review_dayofyear", "is_weekend", "is_holiday", "month_sin", "month_cos", "weekday_sin", "weekday_cos",
    "days_before_newest", "weeks_before_newest", "user_popularity", "user_activity_days", "user_review_frequency",
    "user_product_diversity", "user_rarity_score", "user_review_count", "user_rolling_avg_length",
    "product_popularity_count", "product_lifetime_days", "product_user_diversity", "product_rarity_score",
    "product_rolling_popularity_trend", "popularity_match", "diversity_match", "review_completeness",
    "content_freshness", "length_vs_global", "length_percentile", "helpfulness_percentile",
)
_SPLIT = _BUILD.index(f"\nselect {ID_SQL}, overall, category")
_STORE = _BUILD[:_SPLIT] + f", built as ({_BUILD[_SPLIT:]}), f as (" + "\nunion all\n".join(f"""
select '{c}' as feature, case when sum(n * v) > 1e-18 then
  (sum(n * m * m) - sum(n * m) * sum(n * m) / sum(n)) / (count(*) - 1) / (sum(n * v) / (sum(n) - count(*))) end as f_score
from (select overall, count(*)::double as n, avg({c}) as m, var_pop({c}) as v from built group by 1)"""
    for c in _CANDIDATES) + "), best as (select feature from f order by f_score desc nulls last, feature limit 25), means as (" + (
    "\nunion all\n".join(f"select '{c}' as feature, count(*) as records, round(avg({c}), 4) as mean_value from built"
                          for c in _CANDIDATES)) + """)
select feature, records, mean_value, 0e0 as scaled_mean, '1.0' as feature_version, 25 as feature_count
from means where feature in (select feature from best)"""


@catalog.add("feature_store", sql(_STORE, "frame"))
def feature_store(spark, sf_dir):
    """Selects, scales, publishes and reads back; a row per stored feature."""
    df = materialise(features.build_features(materialise(tv.frame(spark, sf_dir, intensity=True)), tv.TIES))
    candidates = selection.numeric_columns(df, exclude=["overall", "doc_id", *features.TARGET_DERIVED])
    chosen = selection.select_k_best(df, candidates, "overall", 25)
    path = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    writers.publish_features(selection.scale(df, chosen), chosen, path, "1.0", "2002-01-01T00:00:00")
    stored = spark.read.parquet(f"{path}/feature_version=1.0")
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"), F.col(f"{c}_scaled").alias("scaled"))
        for c in chosen
    ])).alias("__p")
    return stored.select("feature_version", "feature_count", pairs).groupBy(
        "__p.feature", "feature_version", "feature_count"
    ).agg(
        F.count(F.lit(1)).alias("records"), F.round(F.avg("__p.value"), 4).alias("mean_value"),
        (F.round(F.avg("__p.scaled"), 4) + 0.0).alias("scaled_mean"),
    )
