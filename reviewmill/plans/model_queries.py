"""Supervised model queries."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from reviewmill.operators import metrics, models, recommend
from reviewmill.plans.recommend_queries import _SCORED, KEYS, _scored
from reviewmill.plans.registry import Catalog, rounded
from reviewmill.plans.views import sql
from reviewmill.session import materialise
from reviewmill.sources import testviews as tv

catalog = Catalog()
NUMERIC = ("word_count", "char_count", "avg_word_length", "text_complexity", "sentiment_intensity")


def labelled(spark, sf_dir):
    """Text features and language of the labelled documents; label = quality."""
    labels = tv.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    # Only labelled texts are looked at. Written once: every fit below passes over it many times.
    docs = tv.table(spark, sf_dir, "documents").select("doc_id", "lang", "text").join(labels, "doc_id")
    return materialise(tv.text_columns(docs, "doc_id", "lang", "label"))


def parts(spark, sf_dir):
    return recommend.hash_split(labelled(spark, sf_dir), ["doc_id"])


@catalog.add("model_frame", sql("""
select overall, word_count, round(helpfulness_ratio, 6) as helpfulness_ratio, user_review_count, product_review_count,
  user_experience, product_popularity from profile where word_count is not null""", "profile"))
def model_frame(spark, sf_dir):
    return rounded(models.model_frame(tv.profile(spark, sf_dir), "overall"), "helpfulness_ratio")


@catalog.add("train_only_stats", sql(_SCORED + """
, us as (select "reviewerID", count(*) as n, avg(overall) as m from cut where is_train group by 1),
ps as (select asin, count(*) as n, avg(overall) as m from cut where is_train group by 1)
select c."reviewerID", c.asin, c.review_timestamp, c.doc_id, coalesce(us.n, 0) as user_review_count,
  round(coalesce(us.m, g.m), 6) as user_avg_rating, coalesce(ps.n, 0) as product_review_count,
  round(coalesce(ps.m, g.m), 6) as product_avg_rating
from cut c left join us on c."reviewerID" = us."reviewerID" left join ps on c.asin = ps.asin, g where not is_train""",
    "reviews"))
def train_only_stats(spark, sf_dir):
    train, test = recommend.hash_split(tv.reviews(spark, sf_dir), KEYS, store=(*KEYS, "overall"))
    out = models.attach_train_stats(test, train)
    return rounded(
        out.select(*KEYS, "user_review_count", "user_avg_rating", "product_review_count", "product_avg_rating"),
        "user_avg_rating", "product_avg_rating",
    )


@catalog.add("encode_categories", sql("""
select doc_id, lang, source, dense_rank() over (order by lang) - 1 as lang_code,
  dense_rank() over (order by source) - 1 as source_code from documents"""))
def encode_categories(spark, sf_dir):
    docs = tv.table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return models.encode(docs, ["lang", "source"]).select("doc_id", "lang", "source", "lang_code", "source_code")


_PRED = _SCORED + """
, pred as (select (overall >= 4)::int as label, (round(score, 6) >= 4.2)::int as prediction, round(score, 6) as score
  from scored)"""


def _predicted(spark, sf_dir):
    _, scored = _scored(spark, sf_dir)
    return scored.select(
        (F.col("rating") >= 4).cast("int").alias("label"), (F.col("score") >= 4.2).cast("int").alias("prediction"), "score"
    )


@catalog.add("confusion_matrix", sql(_PRED + """
select label, count(*) filter (prediction = 0) as pred_0, count(*) filter (prediction = 1) as pred_1
from pred group by 1""", "reviews"))
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(_predicted(spark, sf_dir), [0, 1])


_PRF = """
, c as (select l as class, count(*) filter (label = l) as support, count(*) filter (label = l and prediction = l) as tp,
    count(*) filter (prediction = l) as claimed from pred, (values (0), (1)) as k(l) group by 1),
s as (select support, tp, coalesce(tp / nullif(claimed, 0), 0) as p, coalesce(tp / nullif(support, 0), 0) as r from c),
f as (select *, coalesce(2 * p * r / nullif(p + r, 0), 0) as f1 from s)
"""


@catalog.add("weighted_prf", sql(_PRED + _PRF + """
select round(sum(tp) / sum(support), 6) as accuracy, round(sum(support * p) / sum(support), 6) as precision,
  round(sum(support * r) / sum(support), 6) as recall, round(sum(support * f1) / sum(support), 6) as f1 from f""",
    "reviews"))
def weighted_prf(spark, sf_dir):
    return rounded(metrics.weighted_prf(_predicted(spark, sf_dir)), "accuracy", "precision", "recall", "f1")


@catalog.add("roc_auc", sql(_PRED + """
, r as (select label, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2e0 as rk from pred)
select round((sum(rk) filter (label = 1) - (count(*) filter (label = 1)) * (count(*) filter (label = 1) + 1) / 2)
  / ((count(*) filter (label = 1)) * (count(*) filter (label = 0))), 6) as auc from r""", "reviews"))
def roc_auc(spark, sf_dir):
    return rounded(metrics.auc(_predicted(spark, sf_dir), "score"), "auc")


@catalog.add("model_compare")
def model_compare(spark, sf_dir):
    train, test = parts(spark, sf_dir)
    return models.train_all(train, test, "classification", NUMERIC, ["lang"])[1]


@catalog.add("best_model")
def best_model(spark, sf_dir):
    train, test = parts(spark, sf_dir)
    results = models.train_all(train, test, "classification", NUMERIC, ["lang"])[1]
    return models.best_model(results, "classification")


@catalog.add("regression_compare")
def regression_compare(spark, sf_dir):
    kept = (*KEYS, "overall", "word_count", "helpfulness_ratio")
    train, test = recommend.hash_split(tv.frame(spark, sf_dir), KEYS, store=kept)
    numeric = ["word_count", "helpfulness_ratio", "user_review_count", "user_avg_rating", "product_review_count",
               "product_avg_rating"]
    # Stored, because the preparation is fitted on it before its result is cached.
    ready = materialise(models.attach_train_stats(train, train).withColumn("label", F.col("overall")))
    held = models.attach_train_stats(test, train).withColumn("label", F.col("overall"))
    return models.train_all(ready, held, "regression", numeric)[1]


@catalog.add("feature_importance")
def feature_importance(spark, sf_dir):
    train, _ = parts(spark, sf_dir)
    forest = models.classifiers()["random_forest"]
    fitted = Pipeline(stages=[*models.feature_pipeline(NUMERIC, ["lang"]), forest]).fit(train)
    names = models.feature_names(fitted.transform(train), "__raw")
    return models.feature_importance(fitted.stages[-1], names, spark)


@catalog.add("learning_curve")
def learning_curve(spark, sf_dir):
    est = LogisticRegression(labelCol="label", maxIter=20)
    return models.learning_curve(labelled(spark, sf_dir), est, "classification", NUMERIC, ["doc_id"],
                                 )


@catalog.add("cv_summary")
def cv_summary(spark, sf_dir):
    est = LogisticRegression(labelCol="label", maxIter=20)
    return models.cv_summary(labelled(spark, sf_dir), est, "classification", NUMERIC, ["doc_id"], ["lang"])


@catalog.add("stratified_folds", """
with classes as (
  select quality as label, count(*) as n from documents join labels using (doc_id) where quality is not null group by 1)
select label, fold::int as fold, n // 5 + (fold < n % 5)::int as rows from classes, (select unnest(range(5)) as fold)""")
def stratified_folds(spark, sf_dir):
    rows = tv.table(spark, sf_dir, "labels").join(tv.table(spark, sf_dir, "documents").select("doc_id"), "doc_id")
    placed = models.stratified_folds(
        rows.filter("quality is not null").withColumn("label", F.col("quality")), "label", ["doc_id"], 5
    )
    return placed.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("rows"))


@catalog.add("model_test")
def model_test(spark, sf_dir):
    train, test = parts(spark, sf_dir)
    pipeline = Pipeline(stages=[*models.feature_pipeline(NUMERIC, ["lang"]), LogisticRegression(labelCol="label", maxIter=20)])
    return models.model_test(pipeline, train, test, "classification")


@catalog.add("prediction_distribution")
def prediction_distribution(spark, sf_dir):
    train, test = parts(spark, sf_dir)
    pipeline = Pipeline(stages=[*models.feature_pipeline(NUMERIC), LogisticRegression(labelCol="label", maxIter=20)])
    return models.prediction_distribution(pipeline.fit(train).transform(test), "classification")
