"""Facts about fitted models: what must hold whatever the optimiser does, next to SQL that foretells it.

A model's numbers have no SQL form. Its row counts, unknown keys, bounds and orders have, and that a fit is
better than a constant can be stated as true.
"""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.operators import factors, models, recommend
from reviewmill.operators.joins import attach_totals
from reviewmill.operators.metrics import regression_metrics
from reviewmill.plans.model_queries import NUMERIC, labelled, parts
from reviewmill.plans.recommend_queries import _SPLIT, KEYS, ORDER, customers, train_als
from reviewmill.plans.registry import Catalog
from reviewmill.plans.views import sql
from reviewmill.session import materialise, shared_folder
from reviewmill.sources import testviews as tv

catalog = Catalog()

# Test rows whose user or product the training part lacks.
_UNKNOWN = _SPLIT + """
, us as (select distinct "reviewerID" from cut where is_train),
its as (select distinct asin from cut where is_train),
test as (select *, "reviewerID" in (from us) and asin in (from its) as known from cut where not is_train)
"""


def _lists(ranked: DataFrame, k: int) -> DataFrame:
    """One row: users, rows, and whether every list has ranks 1..k, k different products and falling scores."""
    per = ranked.groupBy("reviewerID").agg(
        F.sort_array(F.collect_list(F.struct("rank", "score", "asin"))).alias("l")
    ).select(F.transform("l", lambda x: x["rank"]).alias("ranks"), F.transform("l", lambda x: x["score"]).alias("scores"),
             F.size(F.array_distinct(F.transform("l", lambda x: x["asin"]))).alias("items"))
    return per.agg(
        F.count(F.lit(1)).alias("users"), F.sum(F.size("ranks")).alias("rows"),
        F.bool_and(F.col("ranks") == F.sequence(F.lit(1), F.lit(k))).alias("ranks_dense"),
        F.bool_and(F.col("items") == F.size("ranks")).alias("no_repeats"),
        F.bool_and(F.col("scores") == F.reverse(F.array_sort("scores"))).alias("scores_fall"),
    )


def _rmse(pred: DataFrame, name: str) -> DataFrame:
    return regression_metrics(pred, "overall").select(F.col("rmse").alias(name))


@catalog.add("als_users_checks", sql(_UNKNOWN + """
select count(distinct "reviewerID") as users, count(distinct "reviewerID") * 10 as rows, true as ranks_dense,
  true as no_repeats, true as scores_fall, true as best_of_all from test where "reviewerID" in (from us)""", "reviews"))
def als_users_checks(spark, sf_dir):
    """Lists of the given users only, and that no product of the catalogue beats the last of a list."""
    model, _, test, _ = train_als(spark, sf_dir)
    model = factors.Factors(materialise(model.users), materialise(model.items), model.rank, model.als)
    ranked = materialise(factors.recommend_for(model, test.select("reviewerID"), 10))
    # Every list against every product: none outside a list may beat its last score.
    return attach_totals(_lists(ranked, 10), factors.count_beaten(model, ranked).select((F.col("beaten") == 0).alias("best_of_all")))


@catalog.add("embedding_checks", sql(_UNKNOWN + """
select count(*) as rows, count(*) filter (id not in (from us)) as unknown, 10 as width, true as unknown_are_zero,
  true as known_are_not from (select concat('A', lpad(c_custkey::varchar, 9, '0')) as id from customer)""", "reviews"))
def embedding_checks(spark, sf_dir):
    """Looked-up vectors: the zero vector for ids without a training row, and for no other."""
    model, train, _, _ = train_als(spark, sf_dir)
    found = factors.embeddings(model.users, customers(spark, sf_dir), "reviewerID", model.rank)
    seen = train.select("reviewerID").distinct().withColumn("known", F.lit(True))
    told = found.join(seen, "reviewerID", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    zero = F.forall("vec", lambda x: x == 0)
    return told.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("known")).alias("unknown"), F.max(F.size("vec")).alias("width"),
        F.coalesce(F.bool_and(F.when(~F.col("known"), zero)), F.lit(True)).alias("unknown_are_zero"),
        F.bool_and(F.when(F.col("known"), ~zero)).alias("known_are_not"),
    )


@catalog.add("fm_checks", sql(_UNKNOWN + """
select count(*) as rows, count(*) filter (not known) as unknown, true as unknown_get_default, true as better_than_mean,
  true as better_than_als from test""", "reviews"))
def fm_checks(spark, sf_dir):
    """The factorisation machine: unknown keys, its fit against the mean, and held-out ratings against ALS without biases."""
    als, train, test, indexed = train_als(spark, sf_dir)
    model = factors.train_fm(indexed)
    ratings = materialise(recommend.interactions(train, ORDER))
    held = test.select("reviewerID", "asin", "overall")
    ids = model.users.select("reviewerID", F.lit(True).alias("u")), model.items.select("asin", F.lit(True).alias("i"))
    told = materialise(factors.predict_fm(model, held).join(ids[0], "reviewerID", "left").join(ids[1], "asin", "left"))
    known = F.col("u").isNotNull() & F.col("i").isNotNull()
    facts = told.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~known).alias("unknown"),
        F.coalesce(F.bool_and(F.when(~known, F.col("prediction") == factors.UNKNOWN_RATING)), F.lit(True)).alias(
            "unknown_get_default"),
    )
    for other in (
        _rmse(factors.predict_fm(model, ratings), "fit"), ratings.agg(F.stddev_pop("overall").alias("spread")),
        _rmse(told, "fm"), _rmse(factors.predict(als, held), "als"),
    ):
        facts = attach_totals(facts, other)
    return facts.select("rows", "unknown", "unknown_get_default", (F.col("fit") < F.col("spread")).alias("better_than_mean"),
                        (F.col("fm") < F.col("als")).alias("better_than_als"))


@catalog.add("svd_checks", sql("""
select 50 as components, count(distinct "reviewerID") as users, count(distinct asin) as items, true as values_fall,
  true as within_total, true as columns_orthogonal, true as lists_are_best
from reviews where "reviewerID" is not null and asin is not null""", "reviews"))
def svd_checks(spark, sf_dir):
    """Fifty components: falling singular values, no more of them than the matrix has, uncorrelated columns."""
    indexed = factors.index_ratings(recommend.interactions(tv.reviews(spark, sf_dir), ORDER))
    model, singular = factors.train_svd(indexed, k=50)
    total = indexed.ratings.agg(F.sum(F.col("overall") * F.col("overall")).alias("total"))
    told = F.array(*[F.lit(v) for v in singular])
    # Columns of the user side are orthogonal and as long as their singular values.
    first, second = F.col("vec")[0], F.col("vec")[1]
    side = model.users.agg(
        F.count(F.lit(1)).alias("users"), F.sum(first * first).alias("a"), F.sum(first * second).alias("ab"),
        F.sum(second * second).alias("b"),
    )
    ranked = factors.recommend_all(model, 10)
    pairs = ranked.filter("rank = 10").select("reviewerID", "score")
    # The mean score over all products is never above the tenth best.
    centre = model.items.select(F.posexplode("vec")).groupBy("pos").agg(F.avg("col").alias("m")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "m"))), lambda x: x["m"]).alias("centre"))
    tenth = attach_totals(pairs.join(model.users, "reviewerID"), centre).agg(
        F.bool_and(factors.dot(F.col("vec"), F.col("centre")) <= F.col("score") + 1e-6).alias("lists_are_best"))
    facts = side
    for other in (model.items.agg(F.count(F.lit(1)).alias("items")), total, tenth):
        facts = attach_totals(facts, other)
    top, next_ = F.lit(singular[0] ** 2), F.lit(singular[1] ** 2)
    return facts.select(
        F.lit(len(singular)).alias("components"), "users", "items",
        (told == F.reverse(F.array_sort(told))).alias("values_fall"),
        (F.lit(sum(v * v for v in singular)) <= F.col("total") * (1 + 1e-9)).alias("within_total"),
        ((F.abs(F.col("ab")) <= 1e-6 * top) & (F.abs(F.col("a") - top) <= 1e-6 * top)
         & (F.abs(F.col("b") - next_) <= 1e-6 * top)).alias("columns_orthogonal"),
        "lists_are_best",
    )


@catalog.add("ncf_checks", sql(_UNKNOWN + """
select count(*) as rows, count(*) filter (not known) as unknown, true as unknown_are_half, true as within_bounds,
  true as steps_in_order, true as stopped_by_rule, true as kept_is_least, true as reloaded_equal from test""", "reviews"))
def ncf_checks(spark, sf_dir):
    """The two-stage model at rank 64: unknown pairs, bounds, the steps of its training and a saved copy."""
    train, test = recommend.hash_split(tv.reviews(spark, sf_dir), KEYS)
    most, patience = 8, 2
    model = factors.train_ncf(train, most=most, patience=patience, order=ORDER)
    users = model.factors.users.select("reviewerID", F.lit(True).alias("u"))
    items = model.factors.items.select("asin", F.lit(True).alias("i"))
    pairs = materialise(test.select("reviewerID", "asin").join(users, "reviewerID", "left").join(items, "asin", "left"))
    path = f"{shared_folder(spark)}/models/{uuid.uuid4().hex}"
    factors.save_neural(model, path)
    again = factors.ncf_predict(factors.load_neural(spark, path), pairs)
    scored = materialise(factors.ncf_predict(model, pairs))
    gone = scored.exceptAll(again.select(*scored.columns)).agg(F.count(F.lit(1)).alias("gone"))
    known = F.col("u").isNotNull() & F.col("i").isNotNull()
    facts = scored.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~known).alias("unknown"),
        F.coalesce(F.bool_and(F.when(~known, F.col("probability") == 0.5)), F.lit(True)).alias("unknown_are_half"),
        F.bool_and(F.col("probability").between(0, 1)).alias("within_bounds"),
    )
    steps = model.history
    kept = [s.valid_loss for s in steps if s.kept]
    last = len(steps) == most or not any(s.kept for s in steps[-patience:])
    return attach_totals(facts, gone).select(
        "rows", "unknown", "unknown_are_half", "within_bounds",
        F.lit([s.step for s in steps] == list(range(1, len(steps) + 1))).alias("steps_in_order"),
        F.lit(last).alias("stopped_by_rule"), F.lit(kept == sorted(kept, reverse=True)).alias("kept_is_least"),
        (F.col("gone") == 0).alias("reloaded_equal"),
    )


_LABELLED = """
with rows as (select d.doc_id, lang, quality, ('0x' || substr(md5('42|' || d.doc_id::varchar), 1, 8))::bigint % 1000 < 800
    as is_train from documents d join labels using (doc_id))
"""


@catalog.add("model_checks", _LABELLED + """
select model, 'classification' as kind, 5::bigint as metrics, true as succeeded, true as within_bounds,
  true as better_than_chance from (values ('logistic_regression'), ('random_forest'), ('gradient_boosting')) as m(model)
union all select 'best', 'classification', 1, true, true, true""")
def model_checks(spark, sf_dir):
    """Every classifier reports five metrics between 0 and 1 and ranks better than chance; the best is the one with most AUC."""
    train, test = parts(spark, sf_dir)
    results = materialise(models.train_all(train, test, "classification", NUMERIC, ["lang"])[1])
    auc = F.max(F.when(F.col("metric") == "auc", F.col("value")))
    per = results.groupBy("model").agg(
        F.lit("classification").alias("kind"), F.count(F.lit(1)).alias("metrics"),
        F.bool_and(F.col("status") == "success").alias("succeeded"),
        F.bool_and(F.col("value").between(0, 1) & F.col("cv_score").between(0, 1)).alias("within_bounds"),
        (auc > 0.5).alias("better_than_chance"),
    )
    best = models.best_model(results, "classification")
    top = results.filter("metric = 'auc'").agg(F.max("value").alias("top"))
    chosen = attach_totals(best, top).groupBy().agg(F.count(F.lit(1)).alias("metrics"), F.bool_and(
        F.col("value") == F.col("top")).alias("succeeded"))
    return per.unionByName(chosen.select(
        F.lit("best").alias("model"), F.lit("classification").alias("kind"), "metrics", "succeeded",
        F.lit(True).alias("within_bounds"), F.lit(True).alias("better_than_chance")))


@catalog.add("importance_checks", _LABELLED + """
select 5 + count(distinct lang) + (count(*) filter (lang is null) > 0)::int as features, true as all_named, true as sums_to_one,
  true as none_negative from rows where is_train""")
def importance_checks(spark, sf_dir):
    """A forest's importances: one per numeric column and language, not negative, one in all."""
    train, _ = parts(spark, sf_dir)
    forest = models.classifiers()["random_forest"]
    fitted = Pipeline(stages=[*models.feature_pipeline(NUMERIC, ["lang"]), forest]).fit(train)
    table = models.feature_importance(fitted.stages[-1], models.feature_names(fitted.transform(train), "__raw"), spark)
    return table.agg(
        F.count(F.lit(1)).alias("features"), (F.count_distinct("feature") == F.count(F.lit(1))).alias("all_named"),
        (F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one"), F.bool_and(F.col("importance") >= 0).alias("none_negative"),
    )


@catalog.add("fold_checks", """
select 'cv' as part, 5::bigint as rows, true as within_bounds, true as consistent
union all select 'curve', 2, true, true""")
def fold_checks(spark, sf_dir):
    """Scores per fold with their mean and gap, and a learning curve over nested samples."""
    rows = labelled(spark, sf_dir)
    est = LogisticRegression(labelCol="label", maxIter=20)
    folds = models.cv_summary(rows, est, "classification", NUMERIC, ["doc_id"], ["lang"])
    inside = F.bool_and(F.col("train_score").between(0, 1) & F.col("test_score").between(0, 1)).alias("within_bounds")
    gap = F.abs(F.avg("train_score") - F.avg("test_score"))
    cv = folds.agg(
        F.lit("cv").alias("part"), F.count(F.lit(1)).alias("rows"), inside,
        ((F.abs(F.avg("test_score") - F.max("mean")) < 1e-9) & (F.abs(gap - F.max("gap")) < 1e-9)
         & (F.max("overfit") == (F.max("gap") > 0.1)) & (F.count_distinct("fold") == 5)).alias("consistent"),
    )
    curve = models.learning_curve(rows, est, "classification", NUMERIC, ["doc_id"], fractions=(0.2, 1.0), folds=3)
    # With all rows the curve is no worse than the larger class.
    share = rows.agg(F.greatest(F.avg("label"), 1 - F.avg("label")).alias("share"))
    whole = F.max(F.when(F.col("fraction") == 1.0, F.col("test_score")))
    return cv.unionByName(attach_totals(curve, share).agg(
        F.lit("curve").alias("part"), F.count(F.lit(1)).alias("rows"), inside,
        (whole >= F.max("share") - 0.05).alias("consistent")))


@catalog.add("test_checks", _LABELLED + """
select count(*) as rows, count(*) filter (quality = 1) as positives, 5::bigint as metrics, true as within_bounds,
  true as classes_known, true as reloaded_equal from rows where not is_train""")
def test_checks(spark, sf_dir):
    """A fitted pipeline on the test part: rows, classes, metrics, and the same predictions once saved and read back."""
    train, test = parts(spark, sf_dir)
    train, test = materialise(train), materialise(test)
    pipeline = Pipeline(stages=[*models.feature_pipeline(NUMERIC, ["lang"]), LogisticRegression(labelCol="label", maxIter=20)])
    table = models.model_test(pipeline, train, test, "classification")
    fitted = pipeline.fit(train)
    path = f"{shared_folder(spark)}/models/{uuid.uuid4().hex}"
    models.save_model(fitted, path)
    loaded, _ = models.load_model(spark, path)
    cols = ("doc_id", "label", "prediction")
    pred = materialise(fitted.transform(test).select(*cols))
    gone = pred.exceptAll(loaded.transform(test).select(*cols)).agg(F.count(F.lit(1)).alias("gone"))
    spread = models.prediction_distribution(pred, "classification")
    facts = pred.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("label") == 1).alias("positives"))
    told = table.agg(F.count(F.lit(1)).alias("metrics"), F.bool_and(F.col("value").between(0, 1)).alias("within_bounds"))
    total = spread.agg(F.sum("count").alias("listed"), F.count(F.lit(1)).alias("classes"))
    for other in (told, total, gone):
        facts = attach_totals(facts, other)
    return facts.select("rows", "positives", "metrics", "within_bounds",
                        ((F.col("listed") == F.col("rows")) & (F.col("classes") <= 2)).alias("classes_known"),
                        (F.col("gone") == 0).alias("reloaded_equal"))
