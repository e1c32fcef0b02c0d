"""Validation, profiling, quality and drift queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewmill.operators import drift, enrich, quality, validate
from reviewmill.plans.registry import Catalog, r6, rounded
from reviewmill.plans.views import sql
from reviewmill.session import materialise
from reviewmill.sources import testviews as tv

catalog = Catalog()
NUMERIC = ("overall", "word_count", "sentiment_score", "helpfulness_ratio")
CATEGORICAL = ("rating_category", "user_experience", "product_popularity")
CUT = "1998-07-01"


def _five(table: str, col: str, section: str) -> str:
    return f"""
select '{section}' as section, unnest(['mean','median','std','min','max']) as key,
  unnest([round(avg({col}), 6), round(quantile_cont({col}, 0.5), 6), round(stddev_samp({col}), 6),
          round(min({col}), 6), round(max({col}), 6)]) as value from {table}"""


def _tidy(df):
    return df.withColumn("value", r6("value"))


@catalog.add("key_completeness", sql("""
select count(*) as total_records, count("reviewerID") as "reviewerID_not_null", count(asin) as asin_not_null,
  count(overall) as overall_not_null from raw_reviews""", "raw_reviews"))
def key_completeness(spark, sf_dir):
    return validate.key_completeness(tv.raw_reviews(spark, sf_dir), ["reviewerID", "asin", "overall"])


@catalog.add("range_checks", sql("""
select count(*) as total_records, count(*) filter (overall between 1 and 5) as rating_range_valid,
  count(*) filter (helpfulness_ratio between 0 and 1) as ratio_range_valid,
  count(*) filter ((overall - m) / s between -3 and 3) as zscore_in_range,
  count(*) filter (helpfulness_ratio * least(total_votes / 10e0, 1) between 0 and 10) as positive_helpfulness
from frame, (select avg(overall) as m, stddev_samp(overall) as s from reviews)""", "frame"))
def range_checks(spark, sf_dir):
    df = enrich.zscore(tv.frame(spark, sf_dir), "overall", "z")
    score = F.col("helpfulness_ratio") * F.least(F.col("total_votes") / F.lit(10.0), F.lit(1.0))
    return validate.range_checks(
        df,
        {
            "rating_range_valid": F.col("overall").between(1, 5),
            "ratio_range_valid": F.col("helpfulness_ratio").between(0, 1),
            "zscore_in_range": F.col("z").between(-3, 3),
            "positive_helpfulness": score.between(0, 10),
        },
    )


@catalog.add("uniqueness", sql("""
select cast(sum(n) as bigint) as total_records, count(*) as unique_records,
  round(count(*) / sum(n), 6) as uniqueness_ratio
from (select count(*) as n from reviews group by "reviewerID", asin, review_timestamp)""", "reviews"))
def uniqueness(spark, sf_dir):
    out = validate.uniqueness(tv.reviews(spark, sf_dir), ["reviewerID", "asin", "review_timestamp"])
    return rounded(out, "uniqueness_ratio")


@catalog.add("rating_distribution", sql(
    "select overall, count(*) as count from reviews group by 1 order by 1", "reviews"))
def rating_distribution(spark, sf_dir):
    return validate.rating_distribution(tv.reviews(spark, sf_dir))


@catalog.add("category_distributions", sql("""
select 'rating_category' as "column", rating_category as value, count(*) as count from profile group by 2
union all select 'user_experience', user_experience, count(*) from profile group by 2
union all select 'product_popularity', product_popularity, count(*) from profile group by 2
union all select 'sentiment_score', case sentiment_score when -1 then '-1.0' when 0 then '0.0' else '1.0' end, count(*)
  from profile group by 2""", "profile"))
def category_distributions(spark, sf_dir):
    return validate.value_counts(tv.profile(spark, sf_dir), [*CATEGORICAL, "sentiment_score"])


@catalog.add("feature_means", sql("\nunion all\n".join(
    f"""select '{c}' as "column", round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std from frame"""
    for c in NUMERIC), "frame"))
def feature_means(spark, sf_dir):
    return rounded(validate.feature_means(tv.frame(spark, sf_dir), NUMERIC), "mean", "std")


@catalog.add("value_ranges", sql("\nunion all\n".join(
    f"""select '{c}' as "column", round(min({c}), 6) as min, round(max({c}), 6) as max from frame"""
    for c in NUMERIC), "frame"))
def value_ranges(spark, sf_dir):
    return rounded(validate.value_ranges(tv.frame(spark, sf_dir), NUMERIC), "min", "max")


_CORR_COLS = (*NUMERIC, "constant")


@catalog.add("correlation_matrix", sql(", k as (select *, 1e0 as constant from frame)\n" + "\nunion all\n".join(
    f"""select '{a}' as x, '{b}' as y, """ + (
        "null::double as correlation" if "constant" in (a, b) else f"round(corr({a}, {b}), 6) as correlation from k")
    for a in _CORR_COLS for b in _CORR_COLS), "frame"))
def correlation_matrix(spark, sf_dir):
    df = tv.frame(spark, sf_dir).withColumn("constant", F.lit(1.0))
    return rounded(validate.correlation_matrix(df, _CORR_COLS), "correlation")


@catalog.add("entity_counts", sql("""
select count(*) as total_records, count(distinct "reviewerID") as unique_users,
  count(distinct asin) as unique_products from reviews""", "reviews"))
def entity_counts(spark, sf_dir):
    return validate.entity_counts(tv.reviews(spark, sf_dir))


@catalog.add("run_report", sql("""
select category as "table", 'success' as status, count(*) as records, 0::bigint as errors,
  null::double as duration_seconds from reviews group by 1
union all select 'total', 'success', count(*), 0, null from reviews""", "reviews"))
def run_report(spark, sf_dir):
    df = tv.reviews(spark, sf_dir)
    names = tv.categories(df)
    return validate.run_report({c: df.filter(F.col("category").eqNullSafe(c)) for c in names})


_RAW_COLS = ("reviewerID", "asin", "reviewerName", "helpful", "reviewText", "overall", "summary", "unixReviewTime", "reviewTime")


@catalog.add("completeness", sql("\nunion all\n".join(
    f"""select '{c}' as "column", count("{c}") as non_null_count, round(count("{c}") * 100 / count(*), 6)
      as completeness_rate from raw_reviews""" for c in _RAW_COLS) + f"""
union all select 'all_columns', count(*), round(({' + '.join(f'count("{c}") * 100 / count(*)' for c in _RAW_COLS)}) / 9, 6)
from raw_reviews""", "raw_reviews"))
def completeness(spark, sf_dir):
    return rounded(quality.completeness(tv.raw_reviews(spark, sf_dir)), "completeness_rate")


@catalog.add("missing_values", sql("\nunion all\n".join(
    f"""select '{c}' as "column", count(*) - count("{c}") as missing,
      round((count(*) - count("{c}")) * 100 / count(*), 6) as missing_percent from raw_reviews""" for c in _RAW_COLS)
    + f"""
union all select 'total', 9 * count(*) - ({' + '.join(f'count("{c}")' for c in _RAW_COLS)}),
  round((9 * count(*) - ({' + '.join(f'count("{c}")' for c in _RAW_COLS)})) * 100 / (9 * count(*)), 6)
from raw_reviews""", "raw_reviews"))
def missing_values(spark, sf_dir):
    return rounded(quality.missing(tv.raw_reviews(spark, sf_dir)), "missing_percent")


@catalog.add("rating_summary", sql(_five("frame", "overall", "rating_stats") + """
union all select 'overall', cast(cast(overall as int) as varchar) || '.0', count(*)::double from frame group by 2
union all select 'rating_category', rating_category, count(*)::double from frame group by 2""", "frame"))
def rating_summary(spark, sf_dir):
    return _tidy(quality.rating_summary(tv.frame(spark, sf_dir)))


def _entity_sql(key: str, other: str, kind: str) -> str:
    return f"""
, per as (select {key}, count(*) as n, count(distinct {other}) as partners, avg(overall) as rating
          from reviews group by 1)
select '{kind}' as section,
  unnest(['total','avg_reviews','max_reviews','single_review','avg_partners','avg_rating','single_review_percent',
          'median_reviews']) as key,
  unnest([count(*)::double, round(avg(n), 6), max(n)::double, (count(*) filter (n = 1))::double,
          round(avg(partners), 6), round(avg(rating), 6), round((count(*) filter (n = 1)) * 100 / count(*), 6),
          round(quantile_cont(n, 0.5), 6)]) as value from per"""


@catalog.add("user_summary", sql(_entity_sql('"reviewerID"', "asin", "user"), "reviews"))
def user_summary(spark, sf_dir):
    return _tidy(quality.entity_summary(tv.reviews(spark, sf_dir), "user"))


@catalog.add("product_summary", sql(_entity_sql("asin", '"reviewerID"', "product"), "reviews"))
def product_summary(spark, sf_dir):
    return _tidy(quality.entity_summary(tv.reviews(spark, sf_dir), "product"))


_TEMPORAL = """
select 'year' as section, year(review_timestamp)::varchar as key, count(*)::double as value from reviews group by 2
union all select 'month', month(review_timestamp)::varchar, count(*) from reviews group by 2
union all select 'dayofweek', (isodow(review_timestamp) - 1)::varchar, count(*) from reviews group by 2
union all select 'quarter', quarter(review_timestamp)::varchar, count(*) from reviews group by 2
union all select 'period', unnest(['start_day','end_day','total_days']),
  unnest([floor(epoch(min(review_timestamp)) / 86400), floor(epoch(max(review_timestamp)) / 86400),
    floor((epoch(max(review_timestamp)) - epoch(min(review_timestamp))) / 86400)]) from reviews"""


@catalog.add("temporal_summary", sql(_TEMPORAL, "reviews"))
def temporal_summary(spark, sf_dir):
    return quality.temporal_summary(tv.reviews(spark, sf_dir))


@catalog.add("text_summary", sql(
    _five("docs", "char_count", "char_count") + "\nunion all" + _five("docs", "word_count", "word_count"), "docs"))
def text_summary(spark, sf_dir):
    return _tidy(quality.text_summary(tv.document_features(spark, sf_dir), "char_count", "word_count"))


_FRAME_COLS = ("doc_id", "reviewerID", "asin", "overall", "helpful_votes", "total_votes", "review_timestamp", "category",
               "word_count", "char_count", "helpfulness_ratio", "sentiment_score", "rating_category")
_REPORT_PARTS = (
    "select 'completeness' as section, unnest([" + ", ".join(f"'{c}'" for c in (*_FRAME_COLS, "all_columns")) + "]) as key, unnest(["
    + ", ".join(f'round(count("{c}") * 100 / count(*), 6)' for c in _FRAME_COLS) + ", round(("
    + " + ".join(f'count("{c}") * 100 / count(*)' for c in _FRAME_COLS) + f") / {len(_FRAME_COLS)}, 6)]) as value from frame",
    _five("frame", "overall", "rating_stats"),
    "select 'overall', cast(cast(overall as int) as varchar) || '.0', count(*)::double from frame group by 2",
    "select 'rating_category', rating_category, count(*)::double from frame group by 2",
    _TEMPORAL,
    _five("frame", "char_count", "char_count"),
    _five("frame", "word_count", "word_count"),
)


@catalog.add("quality_report", sql(
    ", users as (with " + _entity_sql('"reviewerID"', "asin", "user").strip()[1:].strip() + "), products as (with "
    + _entity_sql("asin", '"reviewerID"', "product").strip()[1:].strip() + ")\nselect 'reviews' as dataset, section, key, value from (\n"
    + "\nunion all\n".join([f"(select * from ({part}))" for part in _REPORT_PARTS])
    + "\nunion all select * from users union all select * from products)", "frame"))
def quality_report(spark, sf_dir):
    return _tidy(quality.quality_report(tv.frame(spark, sf_dir), "reviews"))


@catalog.add("histogram", sql("""
, v as (select word_count::double as value from frame where word_count is not null),
b as (select min(value) as lo, max(value) as hi from v)
select bin, round(lo + bin * (hi - lo) / 20, 6) as low, round(lo + (bin + 1) * (hi - lo) / 20, 6) as high, count(*) as count
from (select lo, hi, cast(least(floor((value - lo) / ((hi - lo) / 20)), 19) as int) as bin from v, b) group by 1, lo, hi""",
    "frame"))
def histogram(spark, sf_dir):
    return rounded(quality.histogram(tv.frame(spark, sf_dir), "word_count", 20), "low", "high")


@catalog.add("histogram_clipped", sql("""
, v as (select char_count::double as value from docs), c as (select quantile_cont(value, 0.95) as cap from v),
k as (select value from v, c where value <= cap), b as (select min(value) as lo, max(value) as hi from k)
select bin, round(lo + bin * (hi - lo) / 50, 6) as low, round(lo + (bin + 1) * (hi - lo) / 50, 6) as high, count(*) as count
from (select lo, hi, cast(least(floor((value - lo) / ((hi - lo) / 50)), 49) as int) as bin from k, b) group by 1, lo, hi""",
    "docs"))
def histogram_clipped(spark, sf_dir):
    docs = tv.document_features(spark, sf_dir)
    return rounded(quality.histogram(docs, "char_count", 50, clip_q=0.95), "low", "high")


@catalog.add("profile_basic", sql("""
select 'basic' as section, unnest(['total_records','total_columns','type_bigint','type_double','type_int','type_string',
  'type_timestamp_ntz']) as key, unnest([count(*), 8, 1, 1, 2, 3, 1])::double as value from reviews""", "reviews"))
def profile_basic(spark, sf_dir):
    return quality.profile_basic(tv.reviews(spark, sf_dir))


@catalog.add("duplicates", sql("""
, w as (select count(*) as n, "reviewerID" as u, asin as p from reviews
        group by "reviewerID", asin, overall, helpful_votes, total_votes, review_timestamp, category, doc_id),
k as (select sum(n) as n, sum(n - 1) as extra from w group by u, p)
select sum(n)::bigint as total_records, sum(extra)::bigint as total_duplicates,
  sum(n - 1)::bigint as user_product_duplicates, round(sum(extra) * 100 / sum(n), 6) as duplicate_percent,
  round(sum(n - 1) * 100 / sum(n), 6) as user_product_duplicate_percent from k""", "reviews"))
def duplicates(spark, sf_dir):
    out = quality.duplicates(tv.reviews(spark, sf_dir))
    return rounded(out, "duplicate_percent", "user_product_duplicate_percent")


@catalog.add("iqr_outliers", sql("\nunion all\n".join(f"""
select '{c}' as "column", round(lo, 6) as lower_bound, round(hi, 6) as upper_bound,
  count(*) filter ({c} < lo or {c} > hi) as count,
  round((count(*) filter ({c} < lo or {c} > hi)) * 100 / count(*), 6) as percentage,
  min({c})::double as min_value, round(max({c})::double, 6) as max_value
from frame, (select q1 - 1.5 * (q3 - q1) as lo, q3 + 1.5 * (q3 - q1) as hi from (
  select quantile_cont({c}::double, 0.25) as q1, quantile_cont({c}::double, 0.75) as q3 from frame)) group by lo, hi"""
    for c in (*NUMERIC, "total_votes")), "frame"))
def iqr_outliers(spark, sf_dir):
    out = quality.iqr_outliers(tv.frame(spark, sf_dir), [*NUMERIC, "total_votes"])
    return rounded(out, "lower_bound", "upper_bound", "percentage", "max_value")


@catalog.add("distributions", sql("""
select 'rating_category' as section, rating_category as key, count(*)::double as value from profile group by 2
union all select 'user_experience', user_experience, count(*) from profile group by 2
union all select 'product_popularity', product_popularity, count(*) from profile group by 2""" + "".join(f"""
union all select '{c}', unnest(['mean','std','min','max','p25','median','p75','p90','p95']),
  unnest([round(avg({c}), 6), round(stddev_samp({c}), 6), min({c}), max({c}), round(quantile_cont({c}, 0.25), 6),
    round(quantile_cont({c}, 0.5), 6), round(quantile_cont({c}, 0.75), 6), round(quantile_cont({c}, 0.9), 6),
    round(quantile_cont({c}, 0.95), 6)]) from profile""" for c in ("overall", "word_count")), "profile"))
def distributions(spark, sf_dir):
    return _tidy(quality.distributions(tv.profile(spark, sf_dir), [*CATEGORICAL, "overall", "word_count"]))


@catalog.add("box_stats", sql("""
, b as (select category, quantile_cont(word_count::double, 0.25) as q1, quantile_cont(word_count::double, 0.5) as median,
  quantile_cont(word_count::double, 0.75) as q3 from frame group by 1)
select category, round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3, count(*) as n,
  min(word_count) filter (word_count >= q1 - 1.5 * (q3 - q1))::double as low_whisker,
  max(word_count) filter (word_count <= q3 + 1.5 * (q3 - q1))::double as high_whisker
from frame join b using (category) group by category, q1, median, q3""", "frame"))
def box_stats(spark, sf_dir):
    return rounded(quality.box_stats(tv.frame(spark, sf_dir), "category", "word_count"), "q1", "median", "q3")


@catalog.add("sparsity", sql("""
select count(*) as reviews, count(distinct "reviewerID") as users, count(distinct asin) as products,
  round(1 - count(*) / (count(distinct "reviewerID") * count(distinct asin)), 6) as sparsity from reviews""", "reviews"))
def sparsity(spark, sf_dir):
    return rounded(quality.sparsity(tv.reviews(spark, sf_dir)), "sparsity")


@catalog.add("describe", sql("\nunion all\n".join(
    f"""select '{c}' as "column", count({c})::double as count, round(avg({c}), 6) as mean,
      round(stddev_samp({c}), 6) as stddev, round(min({c})::double, 6) as min, round(max({c})::double, 6) as max from frame"""
    for c in NUMERIC), "frame"))
def describe(spark, sf_dir):
    return rounded(quality.describe(tv.frame(spark, sf_dir), NUMERIC), "mean", "stddev", "min", "max")


_VALIDATE = """
, facts as (select count(*) as n, count("reviewerID") as u, count(asin) as p, count(overall) as o,
    count(*) filter (overall between 1 and 5) as okr, count(*) filter (helpfulness_ratio between 0 and 1) as okh,
    count(distinct overall) filter (overall in (1, 2, 3, 4, 5)) as levels,
    count(*) filter (overall in (4, 5)) / count(*) as pos,
    count(distinct ("reviewerID", asin, review_timestamp)) as uniq,
    avg(word_count) as aw, min(word_count) as mw from frame),
marks as (select *, case when least(u, p, o) = n then 1e0 else 0e0 end as s1,
    case when okr = n and okh = n then 1e0 else 0.5e0 end as s2,
    case when levels = 5 and pos between 0.3e0 and 0.8e0 then 1e0 else 0.5e0 end as s3,
    least(uniq / n * 2, 1e0) as s4, case when aw > 5 and mw > 0 then 1e0 else 0.5e0 end as s5 from facts)
"""


@catalog.add("quality_validation", sql(_VALIDATE + """
select 'reviews' as dataset, n as total_records, uniq as unique_reviews, round(aw, 6) as avg_word_count,
  mw as min_word_count, round(pos, 6) as positive_ratio, round(uniq / n, 6) as uniqueness_ratio,
  s1 as key_score, s2 as range_score, s3 as distribution_score, round(s4, 6) as uniqueness_score, s5 as text_score,
  concat_ws('; ', case when s1 < 1 then 'null values in key columns' end,
    case when okr <> n then 'ratings outside [1-5]' end, case when okh <> n then 'helpfulness ratio outside [0-1]' end,
    case when levels < 5 then 'rating levels missing' end,
    case when not pos between 0.3 and 0.8 then printf('unusual share of positive ratings: %.2f', pos) end,
    case when uniq / n < 0.95 then printf('low uniqueness: %.2f', uniq / n) end,
    case when not aw > 5 then 'reviews too short on average' end,
    case when not mw > 0 then 'reviews with 0 words' end) as issues,
  round((s1 + s2 + s3 + s4 + s5) / 5, 6) as overall_score from marks""", "frame"))
def quality_validation(spark, sf_dir):
    out = quality.validate_quality(tv.frame(spark, sf_dir), "reviews")
    out = out.withColumn("issues", F.concat_ws("; ", "issues"))
    return rounded(out, "avg_word_count", "positive_ratio", "uniqueness_ratio", "uniqueness_score", "overall_score")


@catalog.add("simple_monitor", sql("""
, per as (select "reviewerID", count(*) as n from frame group by 1)
select 'reviews' as dataset, n as total_records, users as unique_users, single as single_review_users,
  round(pos, 6) as positive_ratio,
  concat_ws(' | ', case when pos > 0.9 then printf('MEDIUM BIASED_DISTRIBUTION %.2f', pos) end,
    case when single / users > 0.7 then printf('HIGH COLD_START %.3f', single / users) end) as alerts,
  round((1 + case when pos <= 0.8 then 1e0 else 0.7e0 end + case when n >= 1000 then 1e0 else 0.5e0 end
    + case when users >= 100 then 1e0 else 0.7e0 end) / 4, 6) as overall_score
from (select count(*) as n, count(*) filter (overall in (4, 5)) / count(*) as pos from frame),
  (select count(*) as users, count(*) filter (n = 1) as single from per)""", "frame"))
def simple_monitor(spark, sf_dir):
    out = quality.simple_monitor(tv.frame(spark, sf_dir), "reviews")
    return rounded(out.withColumn("alerts", F.concat_ws(" | ", "alerts")), "positive_ratio", "overall_score")


def _halves(spark, sf_dir, source=tv.profile):
    # Stored once: both halves are read several times by a report.
    df = materialise(source(spark, sf_dir))
    new = F.col("review_timestamp") >= F.lit(CUT).cast("timestamp_ntz")
    return df.filter(new), df.filter(~new)


_KS = f"""
, sides as (select *, case when review_timestamp >= timestamp '{CUT}' then 1 else 0 end as cur from profile),
long as (""" + "\nunion all\n".join(
    f"select '{c}' as metric, {c}::double as value, cur from sides where {c} is not null" for c in NUMERIC) + """),
cnt as (select metric, value, sum(cur)::double as c, sum(1 - cur)::double as r from long group by 1, 2),
tot as (select metric, sum(c) as n_cur, sum(r) as n_ref from cnt group by 1),
cum as (select cnt.metric, sum(c) over w / n_cur as fc, sum(r) over w / n_ref as fr, n_cur, n_ref
  from cnt join tot on cnt.metric = tot.metric
  window w as (partition by cnt.metric order by value rows between unbounded preceding and current row)),
ks as (select metric, n_cur::bigint as n_cur, n_ref::bigint as n_ref, max(abs(fc - fr)) as d from cum group by 1, 2, 3),
walk as (
  select metric, n_cur as n, n_ref as m, round(d * n_cur * n_ref)::bigint as gap, 0::bigint as k, 0::bigint as lo, [1e0] as h
  from ks where d > 0 and greatest(n_cur, n_ref) <= 10000
  union all
  select metric, n, m, gap, k + 1, a, list_transform(range(a, b + 1),
    lambda i: (coalesce(h[i - lo], 0) * i + coalesce(h[i - lo + 1], 0) * (k + 1 - i)) / (k + 1))
  from (select *, greatest(0, k + 1 - m, floor(((k + 1) * n - gap) / (n + m))::bigint + 1) as a,
      least(n, k + 1, ceil(((k + 1) * n + gap) / (n + m))::bigint - 1) as b from walk where k < n + m)),
kp as (select ks.*, case when d = 0 then 1e0 when h is not null then greatest(0e0, 1 - coalesce(h[1], 0))
  else least(1e0, greatest(0e0, list_sum(list_transform(range(1, 101),
  lambda k: (case when k % 2 = 1 then 2e0 else -2e0 end)
    * exp(-2e0 * k * k * (n_cur::double * n_ref / (n_cur + n_ref)) * d * d))))) end as p
  from ks left join walk on ks.metric = walk.metric and walk.k = walk.n + walk.m),
mom as (select metric, avg(value) filter (cur = 1) as mc, avg(value) filter (cur = 0) as mr,
  stddev_samp(value) filter (cur = 1) as sc, stddev_samp(value) filter (cur = 0) as sr from long group by 1),
num as (select metric, d, p, case when mr = 0 then 0 else abs(mc - mr) / mr end as md,
  case when sr = 0 then 0 else abs(sc - sr) / sr end as sd from kp join mom using (metric)),
cats as (""" + "\nunion all\n".join(
    f"select '{c}' as metric, {c} as value, cur from sides" for c in CATEGORICAL) + """),
sh as (select metric, value, sum(cur)::double as c, sum(1 - cur)::double as r from cats group by 1, 2),
st as (select metric, sum(c) as nc, sum(r) as nr from sh group by 1),
hel as (select metric, sqrt(sum(power(sqrt(c / nc) - sqrt(r / nr), 2)) / 2) as h from sh join st using (metric) group by 1),
rep as (select metric, (d + md + sd) / 3 as s, p < 0.05 or (d + md + sd) / 3 > 0.1 as f from num
  union all select metric, h, h > 0.1 from hel),
full_rep as (select * from rep union all select 'all_metrics', avg(s), bool_or(f) from rep)
"""


@catalog.add("ks_drift", sql(_KS + """
select metric, n_cur, n_ref, round(d, 6) as ks_statistic, round(p, 6) as ks_pvalue from kp""", "profile"))
def ks_drift(spark, sf_dir):
    current, reference = _halves(spark, sf_dir, tv.frame)
    return rounded(drift.ks_drift(current, reference, NUMERIC), "ks_statistic", "ks_pvalue")


@catalog.add("numeric_drift", sql(_KS + """
select metric, round(d, 6) as ks_statistic, round(p, 6) as ks_pvalue, round(md, 6) as mean_drift,
  round(sd, 6) as std_drift, round((d + md + sd) / 3, 6) as drift_score,
  p < 0.05 or (d + md + sd) / 3 > 0.1 as drift_detected from num""", "profile"))
def numeric_drift(spark, sf_dir):
    current, reference = _halves(spark, sf_dir, tv.frame)
    out = drift.numeric_drift(current, reference, NUMERIC)
    return rounded(out, "ks_statistic", "ks_pvalue", "mean_drift", "std_drift", "drift_score")


@catalog.add("hellinger_drift", sql(_KS + """
select metric, round(h, 6) as hellinger_distance, round(h, 6) as drift_score, h > 0.1 as drift_detected from hel""",
    "profile"))
def hellinger_drift(spark, sf_dir):
    current, reference = _halves(spark, sf_dir)
    return rounded(drift.hellinger_drift(current, reference, CATEGORICAL), "hellinger_distance", "drift_score")


@catalog.add("drift_report", sql(_KS + """
select 'reviews' as dataset, metric, round(s, 6) as drift_score, f as drift_detected from full_rep""", "profile"))
def drift_report(spark, sf_dir):
    current, reference = _halves(spark, sf_dir)
    return rounded(drift.drift_report(current, reference, NUMERIC, CATEGORICAL, "reviews"), "drift_score")


# A current period in which only good ratings arrived, so that the rules fire.
@catalog.add("alerts", sql(_KS + _VALIDATE.replace("from frame)", "from sides where cur = 1)") + """
, iss as (select unnest(list_filter([case when s1 < 1 then 'null values in key columns' end,
    case when okr <> n then 'ratings outside [1-5]' end, case when okh <> n then 'helpfulness ratio outside [0-1]' end,
    case when levels < 5 then 'rating levels missing' end,
    case when not pos between 0.3 and 0.8 then printf('unusual share of positive ratings: %.2f', pos) end,
    case when uniq / n < 0.95 then printf('low uniqueness: %.2f', uniq / n) end,
    case when not aw > 5 then 'reviews too short on average' end,
    case when not mw > 0 then 'reviews with 0 words' end], lambda x: x is not null)) as issue from marks)
select 'QUALITY' as type, 'HIGH' as severity, printf('low quality score: %.2f', (s1 + s2 + s3 + s4 + s5) / 5) as message,
  'reviews' as dataset from marks where (s1 + s2 + s3 + s4 + s5) / 5 < 0.7
union all select 'VOLUME', 'MEDIUM', printf('low volume: %d rows', n), 'reviews' from marks where n < 1000
union all select 'QUALITY', 'MEDIUM', concat('quality issue: ', issue), 'reviews' from iss
union all select 'DRIFT', case when metric = 'all_metrics' or s > 0.2 then 'HIGH' else 'MEDIUM' end,
  case when metric = 'all_metrics' then printf('data drift detected, score: %.3f', s)
    else printf('drift detected for %s: %.3f', metric, s) end, 'reviews' from full_rep where f""", "profile"))
def alerts(spark, sf_dir):
    current, reference = _halves(spark, sf_dir)
    report = drift.drift_report(current, reference, NUMERIC, CATEGORICAL, "reviews")
    return quality.alerts(quality.validate_quality(current, "reviews"), report)


def _dataset_sql(name: str) -> str:
    """Scores and alert counts of one category, as one row."""
    pick = f"from profile where category = '{name}')"
    drifted = _KS.replace("from profile)", pick).strip()[1:]
    judged = _VALIDATE.replace("from frame)", "from sides where cur = 1)")
    return f"""(with recursive {drifted} {judged}
select '{name}' as dataset, (s1 + s2 + s3 + s4 + s5) / 5 as quality,
  (select s from full_rep where metric = 'all_metrics') as drift,
  ((s1 + s2 + s3 + s4 + s5) / 5 < 0.7)::int + (n < 1000)::int + (s1 < 1)::int + (okr <> n)::int + (okh <> n)::int
    + (levels < 5)::int + (not pos between 0.3 and 0.8)::int + (uniq / n < 0.95)::int + (not aw > 5)::int
    + (not mw > 0)::int + (select count(*) from full_rep where f) as raised,
  ((s1 + s2 + s3 + s4 + s5) / 5 < 0.7)::int
    + (select count(*) from full_rep where f and (metric = 'all_metrics' or s > 0.2)) as high from marks)"""


@catalog.add("monitor_rollup", sql(f"""
, per as (select * from {_dataset_sql('electronics')} union all select * from {_dataset_sql('clothing')})
select count(*) as total_datasets, round(avg(quality), 6) as avg_quality_score, round(avg(drift), 6) as avg_drift_score,
  count(*) filter (quality < 0.7 or drift > 0.1) as datasets_with_issues, sum(raised)::bigint as total_alerts,
  sum(high)::bigint as high_severity_alerts from per""", "profile"))
def monitor_rollup(spark, sf_dir):
    current, reference = _halves(spark, sf_dir)
    scores = drifts = raised = None
    for name in tv.categories(tv.reviews(spark, sf_dir)):
        mine = F.col("category").eqNullSafe(name)
        validation = quality.validate_quality(current.filter(mine), name)
        report = drift.drift_report(current.filter(mine), reference.filter(mine), NUMERIC, CATEGORICAL, name)
        score = validation.select("dataset", "overall_score")
        change = report.filter(F.col("metric") == drift.ALL_METRICS).select("dataset", "drift_score")
        alarm = quality.alerts(validation, report)
        scores = score if scores is None else scores.unionByName(score)
        drifts = change if drifts is None else drifts.unionByName(change)
        raised = alarm if raised is None else raised.unionByName(alarm)
    return rounded(quality.monitor_rollup(scores, drifts, raised), "avg_quality_score", "avg_drift_score")
