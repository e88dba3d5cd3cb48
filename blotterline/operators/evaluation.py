"""Accuracy, F1 and confusion of predictions.

Input frames have ``label`` and ``prediction`` (0/1). ``weight`` names a column that says
how many predictions a row stands for, as in the result of :func:`score_tally`.

One rule for gaps: a row without a label or without a prediction (for the curve measures: a
score) is no prediction and counts nowhere.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SCORE_COLUMNS = {"probability": "probability", "raw": "rawPrediction"}


def score_of(predictions: DataFrame, score: str) -> Column:
    """The score for class 1: an element of a vector column, or a numeric column.

    ``'probability'`` is comparable across the leaves of a tree; ``'raw'`` is not, as a
    tree's raw prediction holds unnormalised class counts.
    """
    name = _SCORE_COLUMNS.get(score, score)
    if isinstance(predictions.schema[name].dataType, VectorUDT):
        return vector_to_array(F.col(name))[1]
    return F.col(name).cast("double")


def rows_of(weight: str | None) -> Column:
    return F.lit(1).cast("bigint") if weight is None else F.col(weight).cast("bigint")


def score_tally(predictions: DataFrame, score: str = "probability") -> DataFrame:
    """Predictions counted by ``score, label, prediction`` into ``rows``.

    All measures can be computed from this compact frame, so a model is applied once.
    """
    return (
        predictions.select(
            score_of(predictions, score).alias("score"),
            F.col("label").cast("int").alias("label"),
            F.col("prediction").cast("double").alias("prediction"),
        )
        .groupBy("score", "label", "prediction")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def accuracy(predictions: DataFrame, weight: str | None = None) -> DataFrame:
    """One row, ``accuracy``: the part of rows predicted right."""
    rows = rows_of(weight)
    right = F.col("label") == F.col("prediction")
    return predictions.agg(
        F.try_divide(
            F.sum(F.when(right, rows).when(right.isNotNull(), 0)),
            F.sum(F.when(right.isNotNull(), rows)),
        ).alias("accuracy")
    )


def confusion(predictions: DataFrame, weight: str | None = None) -> DataFrame:
    """Rows per ``label`` and ``prediction``: the four cells of 0 and 1, absent ones as 0, and any
    other pair that occurs."""
    cells = predictions.sparkSession.range(4).select(
        F.shiftright("id", 1).cast("int").alias("label"),
        (F.col("id") % 2).cast("int").alias("prediction"),
        F.lit(0).cast("bigint").alias("rows"),
    )
    prediction = F.col("prediction").cast("double")
    whole = prediction == prediction.cast("int")
    counted = predictions.select(
        F.col("label").cast("int").alias("label"),
        F.when(whole | prediction.isNull(), prediction.cast("int"))
        .otherwise(F.raise_error(F.lit("a prediction is no class number")).cast("int"))
        .alias("prediction"),
        rows_of(weight).alias("rows"),
    ).where(F.col("label").isNotNull() & F.col("prediction").isNotNull())
    return (
        counted.unionByName(cells)
        .groupBy("label", "prediction")
        .agg(F.sum("rows").alias("count"))
        .orderBy("label", "prediction")
    )


def weighted_f1(predictions: DataFrame, weight: str | None = None) -> DataFrame:
    """One row, ``f1``: the F1 of each class, averaged by the class's true rows."""
    pairs = (
        predictions.select(
            F.col("label").cast("double").alias("label"),
            F.col("prediction").cast("double").alias("prediction"),
            rows_of(weight).alias("rows"),
        )
        .dropna(subset=["label", "prediction"])
        .groupBy("label", "prediction")
        .agg(F.sum("rows").alias("rows"))
    )
    # Each pair counts once for its true class and once for its predicted class.
    hit = F.col("label") == F.col("prediction")
    as_true = F.struct(
        F.col("label").alias("class"),
        F.col("rows").alias("actual"),
        F.lit(0).cast("bigint").alias("predicted"),
        F.when(hit, F.col("rows")).otherwise(0).alias("hits"),
    )
    as_predicted = F.struct(
        F.col("prediction").alias("class"),
        F.lit(0).cast("bigint").alias("actual"),
        F.col("rows").alias("predicted"),
        F.lit(0).cast("bigint").alias("hits"),
    )
    per_class = (
        pairs.select(F.inline(F.array(as_true, as_predicted)))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "hits")])
    )
    class_f1 = 2 * F.col("hits") / (F.col("actual") + F.col("predicted"))
    return per_class.agg(
        F.try_divide(F.sum(F.col("actual") * class_f1), F.sum("actual")).alias("f1")
    )


def metrics_long(runs: DataFrame) -> DataFrame:
    """Run rows as ``classifier, metric, value``, one row per bar of a grouped bar chart."""
    return runs.unpivot("classifier", ["accuracy", "f1", "auc"], "metric", "value")
