import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from reviewmill.operators import metrics, models, selection


@pytest.fixture(scope="module")
def data(spark):
    df = spark.range(400).select(
        "id", (F.col("id") % 10).cast("double").alias("x"), (F.xxhash64("id") % 7).cast("double").alias("noise"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("c"),
    )
    return df.withColumn("label", (F.col("x") >= 5).cast("double")).cache()


def test_train_all_isolates_failures(data):
    train, test = data.filter("id % 5 > 0"), data.filter("id % 5 = 0")
    chosen = {"logistic_regression": models.classifiers()["logistic_regression"], "unknown": models.classifiers()["random_forest"]}
    fitted, results = models.train_all(train, test, "classification", ["x", "noise"], ["c"], models=chosen, folds=2)
    rows = results.collect()
    assert list(fitted) == ["logistic_regression"]
    assert [r.model for r in rows if r.status == "error"] == ["unknown"]
    assert {r.metric: r.value for r in rows if r.status == "success"}["auc"] == pytest.approx(1.0)
    assert models.best_model(results, "classification").first().model == "logistic_regression"


def test_save_and_load(spark, data, tmp_path):
    fitted, _ = models.train_all(data, data, "regression", ["x"], models={"linear_regression": models.regressors()["linear_regression"]}, folds=2)
    maps = {"c": data.select("c").distinct()}
    models.save_model(fitted["linear_regression"], str(tmp_path / "m"), maps)
    again, back = models.load_model(spark, str(tmp_path / "m"), ["c"])
    assert again.transform(data).count() == 400 and back["c"].count() == 2


def test_cv_summary_gap(data):
    out = models.cv_summary(data, LogisticRegression(labelCol="label"), "classification", ["x"], ["id"], folds=3).collect()
    assert len(out) == 3 and out[0].mean > 0.95 and not out[0].overfit


def test_encode_and_non_finite(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", float("inf")), ("b", float("nan")), ("c", None)], "c string, v double")
    assert {(r.c, r.c_code) for r in models.encode(df, ["c"]).collect()} == {("a", 0), ("b", 1), ("c", 2)}
    assert [r.v for r in models.drop_non_finite(df, ["v"]).collect()] == [1.0]


def test_metrics_by_hand(spark):
    pred = spark.createDataFrame([(1, 1, 0.9), (1, 0, 0.4), (0, 0, 0.4), (0, 1, 0.6)], "label int, prediction int, score double")
    row = metrics.classification_metrics(pred).first()
    assert row.accuracy == 0.5 and row.f1 == pytest.approx(0.5)
    # pairs (pos, neg): .9>.4, .9>.6, .4=.4, .4<.6
    assert row.auc == pytest.approx(2.5 / 4)


def test_selection_edges(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0, 5.0), (2.0, 1.0, 2.0, 5.0), (2.0, 3.0, 2.0, 5.0)], "label double, a double, perfect double, flat double")
    scores = {r.feature: r.f_score for r in selection.anova_scores(df, ["a", "perfect", "flat"], "label").collect()}
    assert scores["perfect"] == float("inf") and scores["flat"] is None
    # class means 1 and 2, within squares 2, between squares 2/3
    assert scores["a"] == pytest.approx((2 / 3) / 2)
    assert selection.select_k_best(df, ["a", "perfect", "flat"], "label", 1) == ["perfect"]
    scaled = selection.scale(df, ["a", "flat"]).collect()
    assert [r.flat_scaled for r in scaled] == [0.0, 0.0, 0.0]
    assert sum(r.a_scaled for r in scaled) == pytest.approx(0.0)
