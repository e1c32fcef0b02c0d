"""Model metrics as aggregates over (label, prediction) tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.operators import ordered
from reviewmill.operators.joins import attach_totals


def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """RMSE, MAE and R2 from one pass; rows without a prediction are left out."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    scored = pred.filter(y.isNotNull() & p.isNotNull() & ~F.isnan(p))
    error = y - p
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.sum(error * error), F.var_pop(y) * F.count(F.lit(1)))).alias("r2"),
    )


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, count), the only table the class metrics need."""
    return pred.groupBy(F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")).agg(
        F.count(F.lit(1)).alias("count")
    )


def confusion_matrix(pred: DataFrame, classes: list[int], label: str = "label", prediction: str = "prediction") -> DataFrame:
    wide = confusion(pred, label, prediction).groupBy("label").pivot("prediction", classes).agg(F.sum("count"))
    return wide.na.fill(0).select("label", *[F.col(str(c)).alias(f"pred_{c}") for c in classes])


def _share(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def weighted_prf(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1."""
    table = confusion(pred, label, prediction)
    hit = F.col("label") == F.col("prediction")
    per_label = table.groupBy(F.col("label").alias("class")).agg(
        F.sum("count").alias("support"), F.sum(F.when(hit, F.col("count")).otherwise(0)).alias("tp")
    )
    predicted = table.groupBy(F.col("prediction").alias("class")).agg(F.sum("count").alias("claimed"))
    joined = per_label.join(predicted, "class", "left").na.fill(0, ["claimed"])
    precision, recall = _share(F.col("tp"), F.col("claimed")), _share(F.col("tp"), F.col("support"))
    f1 = _share(2 * precision * recall, precision + recall)
    weight = F.col("support")
    total = F.sum(weight)
    return joined.agg(
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(weight * precision) / total).alias("precision"),
        (F.sum(weight * recall) / total).alias("recall"),
        (F.sum(weight * f1) / total).alias("f1"),
    )


def auc(pred: DataFrame, score: str, label: str = "label") -> DataFrame:
    """Exact area under the ROC curve from average ranks of the distinct scores."""
    counts = pred.groupBy(F.col(score).alias("value")).agg(
        F.count_if(F.col(label) == 1).alias("__p"), F.count(F.lit(1)).alias("__t")
    )
    cum = ordered.group_totals(counts, [], "value", {"__cum": F.col("__t")})
    pos, size = F.col("__p").cast("double"), F.col("__t").cast("double")
    rank = F.col("__cum") - size + (size + 1) / 2
    n_pos, n_neg = F.sum(pos), F.sum(size - pos)
    area = F.try_divide(F.sum(pos * rank) - n_pos * (n_pos + 1) / 2, n_pos * n_neg)
    return cum.agg(area.alias("auc"))


def classification_metrics(pred: DataFrame, score: str = "score", label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: AUC, accuracy, weighted precision, recall and F1."""
    return attach_totals(auc(pred, score, label), weighted_prf(pred, label, prediction))
