"""Classifiers and regressors on MLlib: frames, pipelines, search, evaluation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.operators import metrics
from reviewmill.operators.enrich import product_stats, user_stats
from reviewmill.operators.joins import attach_stats, attach_totals
from reviewmill.operators.ordered import number_rows
from reviewmill.operators.recommend import index_ids, split_point

# Columns a model may see. The rating and its sentiment are left out: the label is made of them.
MODEL_COLUMNS = (
    "word_count", "helpfulness_ratio", "user_review_count", "user_avg_rating", "product_review_count",
    "product_avg_rating", "user_experience", "product_popularity",
)


def model_frame(df: DataFrame, label: str, cols: Sequence[str] = MODEL_COLUMNS) -> DataFrame:
    """Label and the named columns that exist, rows with nulls dropped."""
    kept = [c for c in cols if c in df.columns and c != label]
    if not kept:
        raise ValueError("none of the model columns is present")
    return df.select(label, *kept).na.drop()


def attach_train_stats(df: DataFrame, train: DataFrame) -> DataFrame:
    """User and product statistics taken from the training part only; unseen keys get neutral values."""
    users = user_stats(train).select("reviewerID", "user_review_count", "user_avg_rating")
    products = product_stats(train).select("asin", "product_review_count", "product_avg_rating")
    overall = train.agg(F.avg("overall").alias("__mean"))
    out = attach_totals(attach_stats(attach_stats(df, users, "reviewerID"), products, "asin"), overall)
    return out.withColumns(
        {
            "user_review_count": F.coalesce("user_review_count", F.lit(0)),
            "product_review_count": F.coalesce("product_review_count", F.lit(0)),
            "user_avg_rating": F.coalesce("user_avg_rating", "__mean"),
            "product_avg_rating": F.coalesce("product_avg_rating", "__mean"),
        }
    ).drop("__mean")


def drop_non_finite(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Infinite and NaN values count as missing; rows with missing values are dropped."""
    bad = [float("inf"), float("-inf")]
    types = dict(df.dtypes)
    clean = {
        c: F.when(F.isnan(c) | F.col(c).isin(bad), None).otherwise(F.col(c))
        for c in cols
        if types[c] in ("double", "float")
    }
    return (df.withColumns(clean) if clean else df).na.drop(subset=list(cols))


def encode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Adds ``<c>_code``: index of the category in sorted order, built as a joined table."""
    out = df
    for c in cols:
        out = attach_stats(out, index_ids(df, c, f"{c}_code"), c)
    return out


def feature_pipeline(numeric: Sequence[str], categorical: Sequence[str] = ()) -> list[Estimator]:
    """Index -> one-hot -> assemble -> standardise into ``features``."""
    stages: list = []
    if categorical:
        codes = [f"{c}__code" for c in categorical]
        hot = [f"{c}__hot" for c in categorical]
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=codes, handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=codes, outputCols=hot))
    else:
        hot = []
    stages.append(VectorAssembler(inputCols=[*numeric, *hot], outputCol="__raw", handleInvalid="skip"))
    stages.append(StandardScaler(inputCol="__raw", outputCol="features", withMean=True, withStd=True))
    return stages


def classifiers(label: str = "label", seed: int = 42) -> dict[str, Estimator]:
    return {
        "logistic_regression": LogisticRegression(labelCol=label, maxIter=50),
        "random_forest": RandomForestClassifier(labelCol=label, numTrees=20, maxDepth=5, seed=seed),
        "gradient_boosting": GBTClassifier(labelCol=label, maxIter=10, maxDepth=4, seed=seed),
    }


def regressors(label: str = "label", seed: int = 42) -> dict[str, Estimator]:
    return {
        "linear_regression": LinearRegression(labelCol=label, maxIter=50),
        "random_forest": RandomForestRegressor(labelCol=label, numTrees=20, maxDepth=5, seed=seed),
        "gradient_boosting": GBTRegressor(labelCol=label, maxIter=10, maxDepth=4, seed=seed),
    }


def grid(name: str, est: Estimator, size: str = "small") -> list[dict]:
    """Parameter maps of one estimator; ``size="full"`` is the complete search."""
    full = size == "full"
    builder = ParamGridBuilder()
    if name in ("logistic_regression", "linear_regression"):
        builder.addGrid(est.regParam, [0.01, 0.1, 1.0] if full else [0.0, 0.1])
        builder.addGrid(est.elasticNetParam, [0.0, 1.0] if full else [0.0])
        if name == "linear_regression" and full:
            builder.addGrid(est.fitIntercept, [True, False])
    elif name == "random_forest":
        builder.addGrid(est.numTrees, [50, 100, 200] if full else [10])
        builder.addGrid(est.maxDepth, [5, 10, 15] if full else [3, 5])
        builder.addGrid(est.minInstancesPerNode, [1, 5, 10] if full else [1])
    elif name == "gradient_boosting":
        builder.addGrid(est.maxIter, [50, 100, 200] if full else [5])
        builder.addGrid(est.maxDepth, [5, 8, 12] if full else [3])
        builder.addGrid(est.stepSize, [0.05, 0.1, 0.2] if full else [0.1, 0.2])
    else:
        raise ValueError(f"no grid for {name}")
    return builder.build()


@dataclass
class Trained:
    models: dict[str, Model] = field(default_factory=dict)
    rows: list[tuple] = field(default_factory=list)


RESULTS = "model string, status string, metric string, value double, cv_score double, error string"


def with_score(pred: DataFrame) -> DataFrame:
    """Adds ``score``, the probability of class 1."""
    return pred.withColumn("score", vector_to_array("probability")[1])


def _evaluate(pred: DataFrame, kind: str, label: str) -> dict[str, float]:
    table = (
        metrics.classification_metrics(with_score(pred), label=label)
        if kind == "classification"
        else metrics.regression_metrics(pred, label)
    )
    return {k: float(v) for k, v in table.first().asDict().items() if v is not None}


def train_all(
    train: DataFrame,
    test: DataFrame,
    kind: str,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    label: str = "label",
    models: dict[str, Estimator] | None = None,
    size: str = "small",
    folds: int = 3,
    seed: int = 42,
    parallelism: int = 2,
) -> tuple[dict[str, Model], DataFrame]:
    """Cross-validated search per model and scoring on the test part.

    Returns the fitted models and one row per (model, metric). A model that
    fails is reported with its error and does not stop the others. The
    features are prepared once and cached for all fits.
    """
    estimators = models or (classifiers(label, seed) if kind == "classification" else regressors(label, seed))
    judge = (
        BinaryClassificationEvaluator(labelCol=label)
        if kind == "classification"
        else RegressionEvaluator(labelCol=label, metricName="rmse")
    )
    prepared = Pipeline(stages=feature_pipeline(numeric, categorical)).fit(train)
    ready = prepared.transform(train).select("features", label).cache()
    held = prepared.transform(test).select("features", label).cache()
    done = Trained()
    for name, est in estimators.items():
        try:
            search = CrossValidator(
                estimator=est, estimatorParamMaps=grid(name, est, size), evaluator=judge, numFolds=folds,
                seed=seed, parallelism=parallelism,
            ).fit(ready)
            best = max(search.avgMetrics) if judge.isLargerBetter() else min(search.avgMetrics)
            for metric, value in _evaluate(search.bestModel.transform(held), kind, label).items():
                done.rows.append((name, "success", metric, value, float(best), None))
            done.models[name] = PipelineModel(stages=[*prepared.stages, search.bestModel])
        except Exception as error:  # reported per model; the other models still train
            done.rows.append((name, "error", None, None, None, str(error)))
    ready.unpersist()
    held.unpersist()
    if not done.models:
        raise RuntimeError("no model could be trained: " + "; ".join(f"{r[0]}: {r[5]}" for r in done.rows))
    return done.models, train.sparkSession.createDataFrame(done.rows, RESULTS)


def best_model(results: DataFrame, kind: str, metric: str | None = None) -> DataFrame:
    """(model, value) with the largest AUC (or chosen metric) / the smallest RMSE; failures are left out."""
    metric = metric or ("auc" if kind == "classification" else "rmse")
    larger = metric not in ("rmse", "mae")
    ok = results.filter((F.col("status") == "success") & (F.col("metric") == metric))
    key = F.struct(F.col("value") if larger else -F.col("value"), F.col("model"))
    return ok.agg(F.max_by("model", key).alias("model"), F.max_by("value", key).alias("value"))


def feature_names(frame: DataFrame, col: str = "features") -> list[str]:
    """Names in vector order, from the assembler's metadata."""
    attrs = frame.schema[col].metadata.get("ml_attr", {}).get("attrs", {})
    named = sorted((a["idx"], a["name"]) for group in attrs.values() for a in group)
    return [n for _, n in named]


def feature_importance(model: Model, names: Sequence[str], spark: SparkSession) -> DataFrame:
    """(feature, importance): tree importances or absolute coefficients, largest first."""
    values = model.featureImportances if hasattr(model, "featureImportances") else model.coefficients
    rows = [(n, abs(float(v))) for n, v in zip(names, values.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")


def fold_of(keys: Sequence[str], folds: int, seed: int = 42) -> Column:
    return (split_point(keys, seed) * folds / 1000).cast("int")


def stratified_folds(df: DataFrame, label: str, keys: Sequence[str], folds: int, name: str = "fold") -> DataFrame:
    """Adds the fold of each row: the rows of a class, in order of a digest of their keys, take the folds in turn.

    So every class is spread over the folds with at most one row of difference.
    """
    order = [split_point(keys).asc(), *[F.col(k).asc() for k in keys]]
    placed = number_rows(df, [label], order, "__place")
    return placed.withColumn(name, ((F.col("__place") - 1) % folds).cast("int")).drop("__place")


def _stage_scores(est_pipeline: Pipeline, train: DataFrame, test: DataFrame, kind: str, label: str) -> tuple[float, float]:
    fitted = est_pipeline.fit(train)

    def score(part: DataFrame) -> float:
        pred = fitted.transform(part)
        if kind == "classification":
            return float(metrics.weighted_prf(pred, label).first()["accuracy"])
        return float(metrics.regression_metrics(pred, label).first()["rmse"])

    return score(train), score(test)


def cv_summary(
    df: DataFrame,
    est: Estimator,
    kind: str,
    numeric: Sequence[str],
    keys: Sequence[str],
    categorical: Sequence[str] = (),
    label: str = "label",
    folds: int = 5,
) -> DataFrame:
    """(fold, train_score, test_score, mean, std, gap, overfit): like-for-like train and test scores per fold.

    Classes are spread evenly over the folds; a regression has no classes, its rows go by a digest of their keys.
    """
    pipeline = Pipeline(stages=[*feature_pipeline(numeric, categorical), est])
    if kind == "classification":
        placed = stratified_folds(df, label, keys, folds, "__fold").cache()
    else:
        placed = df.withColumn("__fold", fold_of(keys, folds)).cache()
    rows = []
    for fold in range(folds):
        train, test = placed.filter(F.col("__fold") != fold), placed.filter(F.col("__fold") == fold)
        rows.append((fold, *_stage_scores(pipeline, train, test, kind, label)))
    placed.unpersist()
    table = df.sparkSession.createDataFrame(rows, "fold int, train_score double, test_score double")
    gap = F.abs(F.avg("train_score") - F.avg("test_score"))
    summary = table.agg(
        F.avg("test_score").alias("mean"), F.stddev_pop("test_score").alias("std"), gap.alias("gap"),
        (gap > 0.1).alias("overfit"),
    )
    return attach_totals(table, summary)


def learning_curve(
    df: DataFrame,
    est: Estimator,
    kind: str,
    numeric: Sequence[str],
    keys: Sequence[str],
    categorical: Sequence[str] = (),
    label: str = "label",
    fractions: Sequence[float] = tuple(i / 10 for i in range(1, 11)),
    folds: int = 5,
) -> DataFrame:
    """(fraction, train_score, test_score): mean over folds, training on nested digest samples."""
    pipeline = Pipeline(stages=[*feature_pipeline(numeric, categorical), est])
    placed = df.withColumns(
        {"__fold": fold_of(keys, folds), "__part": split_point(keys, seed=7) / F.lit(1000.0)}
    ).cache()
    rows = []
    for fraction in fractions:
        for fold in range(folds):
            train = placed.filter((F.col("__fold") != fold) & (F.col("__part") < fraction))
            test = placed.filter(F.col("__fold") == fold)
            rows.append((float(fraction), *_stage_scores(pipeline, train, test, kind, label)))
    placed.unpersist()
    table = df.sparkSession.createDataFrame(rows, "fraction double, train_score double, test_score double")
    return table.groupBy("fraction").agg(F.avg("train_score").alias("train_score"), F.avg("test_score").alias("test_score"))


def model_test(
    pipeline: Pipeline, train: DataFrame, test: DataFrame, kind: str, label: str = "label"
) -> DataFrame:
    """(metric, value) of a freshly fitted pipeline on the test part."""
    pred = pipeline.fit(train).transform(test)
    rows = sorted(_evaluate(pred, kind, label).items())
    return train.sparkSession.createDataFrame(rows, "metric string, value double")


def prediction_distribution(pred: DataFrame, kind: str, bins: int = 20) -> DataFrame:
    from reviewmill.operators import quality, validate

    if kind == "classification":
        return validate.value_counts(pred, ["prediction"])
    return quality.histogram(pred, "prediction", bins)


def save_model(model: PipelineModel, path: str, maps: dict[str, DataFrame] | None = None) -> None:
    """A fitted pipeline and its id maps side by side."""
    model.write().overwrite().save(f"{path}/model")
    for name, table in (maps or {}).items():
        table.write.mode("overwrite").parquet(f"{path}/maps/{name}")


def load_model(spark: SparkSession, path: str, maps: Sequence[str] = ()) -> tuple[PipelineModel, dict[str, DataFrame]]:
    return PipelineModel.load(f"{path}/model"), {n: spark.read.parquet(f"{path}/maps/{n}") for n in maps}
