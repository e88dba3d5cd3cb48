"""Exact area under ROC and ROC points.

Both need running sums over all scores in order. Rows are counted per score first, which
takes care of scores that very many rows share. The distinct scores are then partitioned
by range; each range is summed on its own and starts from the totals of the ranges above
it. No task holds more than one partition, and the result is exact whatever the ranges.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotterline.operators.evaluation import rows_of, score_of
from blotterline.session import materialize

_COUNTS = ["positives", "negatives", "scores"]


@dataclass
class _Curve:
    """Steps of a ROC curve, highest score first, with the totals as plain numbers.

    ``steps`` has ``score, positives, negatives`` of each distinct score, and ``tp, fp,
    step``: the positives, negatives and scores from the top down to and including it.
    """

    steps: DataFrame
    positives: int
    negatives: int
    scores: int


def _counts_by_score(
    predictions: DataFrame, score: str, weight: str | None, ranges: int | None
) -> DataFrame:
    """``score, positives, negatives, scores`` (1) per distinct score, and its ``range``.

    Ranges are Spark's partitions in descending order of score, numbered from 0. The
    result is stored, which fixes the numbers and makes the predictions once.
    """
    positive = F.col("label") == 1
    by_score = (
        predictions.select(
            score_of(predictions, score).alias("score"),
            F.col("label").cast("int").alias("label"),
            rows_of(weight).alias("rows"),
        )
        .filter(F.col("score").isNotNull() & F.col("label").isNotNull())
        .groupBy("score")
        .agg(
            F.sum(F.when(positive, F.col("rows")).otherwise(0)).alias("positives"),
            F.sum(F.when(positive, 0).otherwise(F.col("rows"))).alias("negatives"),
        )
        .withColumn("scores", F.lit(1).cast("bigint"))
    )
    # Without a number, adaptive execution makes as many ranges as the size asks for.
    number = () if ranges is None else (ranges,)
    ranged = by_score.repartitionByRange(*number, F.desc("score"))
    return materialize(ranged.withColumn("range", F.spark_partition_id()), "by-score")


def _curve(
    predictions: DataFrame, score: str, weight: str | None, ranges: int | None
) -> _Curve:
    by_score = _counts_by_score(predictions, score, weight, ranges)
    totals = by_score.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _COUNTS]).head()

    # One row per range: fit for one window.
    above = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        by_score.groupBy("range")
        .agg(*[F.sum(c).alias(c) for c in _COUNTS])
        .select(
            "range",
            *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in _COUNTS],
        )
    )
    upto = (
        Window.partitionBy("range")
        .orderBy(F.desc("score"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    within = by_score.withColumns({f"{c}_within": F.sum(c).over(upto) for c in _COUNTS})
    tp, fp, step = [F.col(f"{c}_above") + F.col(f"{c}_within") for c in _COUNTS]
    steps = within.join(starts, "range").select(
        "score",
        "positives",
        "negatives",
        tp.alias("tp"),
        fp.alias("fp"),
        step.alias("step"),
    )
    return _Curve(steps, totals["positives"], totals["negatives"], totals["scores"])


def auc(
    predictions: DataFrame,
    score: str = "probability",
    weight: str | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """One row, ``auc``: the exact area under ROC, null when a class is absent.

    ``score`` is ``'probability'``, ``'raw'`` or the name of a score column. Runs at once
    as far as the counts by score, which go to the shared work folder. ``ranges`` fixes
    the number of score ranges, which is otherwise chosen by size.
    """
    curve = _curve(predictions, score, weight, ranges)
    # Twice the number of (positive, negative) pairs in right order, ties as half, in
    # whole numbers: the sum does not depend on the order of its terms.
    below = F.lit(curve.negatives).cast("bigint") - F.col("fp")
    right_pairs = F.sum(
        F.col("positives").cast("decimal(19,0)")
        * (2 * below + F.col("negatives")).cast("decimal(19,0)")
    )
    pairs = float(2 * curve.positives * curve.negatives)
    return curve.steps.agg(
        F.try_divide(right_pairs.cast("double"), F.lit(pairs)).alias("auc")
    )


def roc_points(
    predictions: DataFrame,
    max_points: int | None = None,
    score: str = "probability",
    weight: str | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """ROC points ``threshold, tp, fp, tpr, fpr``, one per distinct score and the origin.

    ``max_points`` thins the curve for drawing: points on it are kept at even steps,
    always with both ends. See :func:`auc` for the other parameters.
    """
    if max_points is not None and max_points < 2:
        raise ValueError("max_points must be at least 2")
    curve = _curve(predictions, score, weight, ranges)
    steps = curve.steps
    if max_points is not None and curve.scores > max_points - 1:
        stride = math.ceil(curve.scores / (max_points - 1))
        steps = steps.filter((F.col("step") % stride == 0) | (F.col("step") == curve.scores))
    origin = predictions.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("score"),
        F.lit(0).cast("bigint").alias("tp"),
        F.lit(0).cast("bigint").alias("fp"),
    )
    points = origin.unionByName(steps.select("score", "tp", "fp"))
    return points.select(
        F.col("score").alias("threshold"),
        "tp",
        "fp",
        F.try_divide("tp", F.lit(curve.positives)).alias("tpr"),
        F.try_divide("fp", F.lit(curve.negatives)).alias("fpr"),
    )
