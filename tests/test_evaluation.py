from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

import blotterline as bl


def frame(spark, rows):
    return spark.createDataFrame(rows, "label int, prediction double, score double")


@pytest.fixture(scope="module")
def predictions(spark):
    """Three thousand predictions, a third of them with one score."""
    rng = np.random.default_rng(5)
    label = rng.integers(0, 2, 3000)
    score = np.where(rng.random(3000) < 0.33, 0.5, np.round(rng.random(3000) + 0.2 * label, 3))
    rows = [(int(a), float(s > 0.55), float(s)) for a, s in zip(label, score)]
    return frame(spark, rows).repartition(5).cache()


def brute_auc(rows) -> float | None:
    positive = np.array([s for label, _, s in rows if label == 1])
    negative = np.array([s for label, _, s in rows if label == 0])
    if not len(positive) or not len(negative):
        return None
    above = (positive[:, None] > negative[None, :]).sum()
    equal = (positive[:, None] == negative[None, :]).sum()
    return (above + equal / 2) / (len(positive) * len(negative))


def value(df):
    return df.head()[0]


def test_accuracy_and_f1_equal_sparks_evaluators(predictions):
    for name, mine in (("accuracy", bl.accuracy), ("f1", bl.weighted_f1)):
        evaluator = MulticlassClassificationEvaluator(metricName=name)
        assert value(mine(predictions)) == pytest.approx(evaluator.evaluate(predictions))


@pytest.mark.parametrize("ranges", [None, 1, 3, 200])
def test_auc_is_exact_for_any_number_of_ranges(predictions, ranges):
    found = value(bl.auc(predictions, "score", ranges=ranges))
    assert found == pytest.approx(brute_auc([tuple(r) for r in predictions.collect()]), abs=1e-14)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    assert found == pytest.approx(evaluator.evaluate(predictions))


def test_auc_does_not_change_under_increasing_maps_and_mirrors(predictions):
    auc = value(bl.auc(predictions, "score"))
    mapped = predictions.withColumn("score", F.exp("score") * 7 - 100)
    assert value(bl.auc(mapped, "score", ranges=20)) == auc
    mirrored = predictions.withColumn("score", -F.col("score"))
    assert value(bl.auc(mirrored, "score", ranges=20)) == pytest.approx(1 - auc)


@given(
    st.lists(
        st.tuples(
            st.integers(0, 1),
            st.just(0.0),
            st.sampled_from([0.0, -0.0, 1e-300, 0.25, 0.5, 1.0, math.inf, -math.inf, -3.0]),
        ),
        min_size=1,
        max_size=40,
    )
)
@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
def test_auc_of_any_scores(spark, rows):
    expected = brute_auc(rows)
    for ranges in (None, 5):
        found = value(bl.auc(frame(spark, rows), "score", ranges=ranges))
        assert found == (expected if expected is None else pytest.approx(expected))


def test_auc_without_one_class_is_null(spark):
    assert value(bl.auc(frame(spark, [(1, 1.0, 0.3), (1, 1.0, 0.4)]), "score")) is None
    assert value(bl.auc(frame(spark, []), "score")) is None


def test_auc_ranks_on_probability_unless_told(spark):
    rows = [
        (1, Vectors.dense(0.1, 0.9), Vectors.dense(1.0, 9.0)),
        (0, Vectors.dense(0.8, 0.2), Vectors.dense(80.0, 20.0)),
    ]
    given_rows = spark.createDataFrame(rows, ["label", "probability", "rawPrediction"])
    assert value(bl.auc(given_rows)) == 1.0
    assert value(bl.auc(given_rows, "raw")) == 0.0


def test_measures_of_a_tally_are_those_of_its_rows(predictions):
    tally = bl.score_tally(predictions, "score")
    assert tally.agg(F.sum("rows")).head()[0] == predictions.count()
    assert value(bl.accuracy(tally, "rows")) == value(bl.accuracy(predictions))
    assert value(bl.weighted_f1(tally, "rows")) == value(bl.weighted_f1(predictions))
    assert value(bl.auc(tally, "score", "rows")) == value(bl.auc(predictions, "score"))
    assert bl.confusion(tally, "rows").collect() == bl.confusion(predictions).collect()


def test_confusion_has_all_cells(spark, predictions):
    cells = {(r["label"], r["prediction"]): r["count"] for r in bl.confusion(predictions).collect()}
    assert set(cells) == {(0, 0), (0, 1), (1, 0), (1, 1)}
    assert sum(cells.values()) == predictions.count()
    one = bl.confusion(frame(spark, [(1, 0.0, 0.1)])).collect()
    assert [r["count"] for r in one] == [0, 0, 1, 0]


@pytest.mark.parametrize("ranges", [None, 9])
def test_roc_points(predictions, ranges):
    points = bl.roc_points(predictions, score="score", ranges=ranges)
    found = sorted((r["fpr"], r["tpr"]) for r in points.collect())
    assert found[0] == (0.0, 0.0)
    assert found[-1] == (1.0, 1.0)
    assert len(found) == predictions.select("score").distinct().count() + 1
    x, y = zip(*found)
    assert np.trapezoid(y, x) == pytest.approx(value(bl.auc(predictions, "score")))
    assert all(a <= b for a, b in zip(y, y[1:]))


@pytest.mark.parametrize("max_points", [2, 3, 10, 500])
def test_thinned_roc_points_lie_on_the_curve(predictions, max_points):
    whole = set(bl.roc_points(predictions, score="score").collect())
    thin = bl.roc_points(predictions, max_points, "score", ranges=9).collect()
    assert len(thin) <= max_points
    assert set(thin) <= whole
    assert {(0.0, 0.0), (1.0, 1.0)} <= {(r["fpr"], r["tpr"]) for r in thin}


def test_roc_points_need_two(predictions):
    with pytest.raises(ValueError):
        bl.roc_points(predictions, 1, "score")


def test_metrics_long_and_best_model(spark):
    runs = spark.createDataFrame(
        [("r1", "A", 0.9, 0.8, None), ("r2", "B", 0.5, 0.4, 0.7), ("r3", "C", 0.6, 0.3, 0.6)],
        "run_id string, classifier string, accuracy double, f1 double, auc double",
    ).withColumn("run_ts", F.current_timestamp())
    long = {(r["classifier"], r["metric"]): r["value"] for r in bl.metrics_long(runs).collect()}
    assert len(long) == 9
    assert long["A", "accuracy"] == 0.9
    assert bl.best_model(runs).head()["classifier"] == "B"
    assert bl.best_model(runs, by="f1").head()["classifier"] == "A"


def test_one_rule_for_gaps(spark):
    rows = [(1, 1.0, 0.9), (0, 1.0, 0.4), (None, 1.0, 0.5), (1, None, None), (2, 2.0, 0.1)]
    frame = spark.createDataFrame(rows, "label int, prediction double, score double")
    assert bl.accuracy(frame).head()[0] == pytest.approx(2 / 3)
    cells = {(r["label"], r["prediction"]): r["count"] for r in bl.confusion(frame).collect()}
    assert cells == {(0, 0): 0, (0, 1): 1, (1, 0): 0, (1, 1): 1, (2, 2): 1}
    tally = bl.score_tally(frame, "score")
    assert bl.accuracy(tally, "rows").head()[0] == pytest.approx(2 / 3)
    assert bl.weighted_f1(tally, "rows").head() == bl.weighted_f1(frame).head()
    with pytest.raises(Exception, match="no class number"):
        bl.confusion(frame.withColumn("prediction", F.lit(0.5))).collect()
