from __future__ import annotations

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

import blotterline as bl
from blotterline.schema import FEATURE_INPUTS, RUN_SCHEMA

TREES = ["DecisionTree", "RandomForest", "GBTClassifier"]


@pytest.fixture(scope="module")
def parts(spark):
    """Features whose label follows from hour and type: night thefts lead to arrests."""
    i = F.col("id")
    rows = spark.range(3000).select(
        i.cast("string").alias("ID"),
        F.concat(F.lit("type "), (i % 4).cast("string")).alias("Primary_Type"),
        F.concat(F.lit("place "), (i % 7).cast("string")).alias("Location_Description"),
        (i * 7 % 24).cast("int").alias("Hour"),
        (i % 7 + 1).cast("int").alias("DayOfWeek"),
        F.when((i % 7 + 1).isin(1, 7), 1).otherwise(0).alias("IsWeekend"),
        (41 + F.rand(1)).alias("Latitude"),
        (-87 - F.rand(2)).alias("Longitude"),
    )
    planted = (F.col("Hour") >= 16) & (F.col("Primary_Type") == "type 1")
    labelled = rows.withColumn("label", planted.cast("int"))
    return tuple(part.cache() for part in bl.split_by_hash(labelled))


@pytest.fixture(scope="module")
def trained(parts):
    return bl.train_all(*parts, parallelism=3)


def test_run_rows(trained, parts):
    runs, models = trained
    assert runs.schema == RUN_SCHEMA
    rows = {row["classifier"]: row for row in runs.collect()}
    assert list(models) == list(rows) == [
        "LogisticRegression", "DecisionTree", "RandomForest", "GBTClassifier", "NaiveBayes",
    ]
    assert len({row["run_id"] for row in rows.values()}) == 5
    test = parts[1]
    majority = 1 - test.agg(F.avg("label")).head()[0]
    for name in TREES:
        assert rows[name]["auc"] > 0.9
        if name != "RandomForest":
            assert rows[name]["accuracy"] > majority + 0.03


def test_measures_equal_sparks_evaluators(trained, parts):
    runs, models = trained
    for row in runs.collect():
        predictions = models[row["classifier"]].transform(parts[1]).cache()
        for metric, name in (("accuracy", "accuracy"), ("f1", "f1")):
            evaluator = MulticlassClassificationEvaluator(metricName=name)
            assert row[metric] == pytest.approx(evaluator.evaluate(predictions))
        on_probability = BinaryClassificationEvaluator(
            rawPredictionCol="probability", numBins=0
        )
        assert row["auc"] == pytest.approx(on_probability.evaluate(predictions))
        on_raw = BinaryClassificationEvaluator(rawPredictionCol="rawPrediction", numBins=0)
        assert bl.auc(predictions, "raw").head()[0] == pytest.approx(on_raw.evaluate(predictions))


def test_settings_of_the_classifiers():
    estimators = bl.classifiers()
    assert estimators["RandomForest"].getNumTrees() == 20
    assert estimators["GBTClassifier"].getMaxIter() == 10
    assert estimators["NaiveBayes"].getModelType() == "gaussian"
    assert {e.getFeaturesCol() for e in estimators.values()} == {"features"}
    assert all(estimators[name].getSeed() == 42 for name in TREES)


def test_training_again_gives_the_same_measures(parts, trained):
    again, _ = bl.train_all(*parts, names=["RandomForest", "GBTClassifier"])
    measured = ["classifier", "accuracy", "f1", "auc"]
    first = {tuple(row) for row in trained[0].select(*measured).collect()}
    assert {tuple(row) for row in again.select(*measured).collect()} <= first


def test_unseen_and_null_categories_give_zero_vectors(spark, parts):
    train, _ = parts
    prep = bl.fit_prep(train)
    strange = train.limit(2).withColumn("Primary_Type", F.lit("never seen")).unionByName(
        train.limit(1).withColumn("Primary_Type", F.lit(None).cast("string"))
    )
    rows = prep.transform(strange).collect()
    assert len(rows) == 3
    assert all(row["Type_Vec"].size == 4 and row["Type_Vec"].numNonzeros() == 0 for row in rows)
    assert all(row["features"].size == 5 + 4 + 7 for row in rows)


def test_both_ways_to_fit_the_preparation_agree(parts):
    train, test = parts
    stock, counted = bl.prep_pipeline().fit(train), bl.fit_prep(train)
    assert [list(stage.labels) for stage in counted.stages[:2]] == [
        list(labels) for labels in stock.stages[0].labelsArray
    ]
    kept = ["ID", "Type_Vec", "Loc_Vec", "features"]
    assert sorted(counted.transform(test).select(kept).collect()) == sorted(
        stock.transform(test).select(kept).collect()
    )
    metadata = [m.transform(test).schema["features"].metadata for m in (stock, counted)]
    assert metadata[0] == metadata[1]


def test_feature_order(parts):
    prep = bl.fit_prep(parts[0])
    row = prep.transform(parts[0].limit(1)).head()
    assert list(row["features"].toArray()[:5]) == [float(row[c]) for c in FEATURE_INPUTS[:5]]


def test_saved_models_predict_the_same_and_are_replaced(trained, parts, tmp_path):
    _, models = trained
    path = str(tmp_path / "model")
    for name in ("NaiveBayes", "GBTClassifier"):
        bl.save_model(models[name], path)
    loaded = PipelineModel.load(path)
    columns = ["ID", "prediction", "probability"]
    expected = models["GBTClassifier"].transform(parts[1]).select(*columns)
    assert sorted(loaded.transform(parts[1]).select(*columns).collect()) == sorted(
        expected.collect()
    )


def test_importances(trained):
    _, models = trained
    for name in TREES:
        slots = bl.importances(models[name]).collect()
        assert len(slots) == 16
        assert sum(row["importance"] for row in slots) == pytest.approx(1)
        assert [r["importance"] for r in slots] == sorted(r["importance"] for r in slots)
        assert {"Hour", "Latitude", "Type_Vec_type 1", "Loc_Vec_place 0"} <= {
            row["slot"] for row in slots
        }
        sources = {r["source"]: r["importance"] for r in bl.importances(models[name], "source").collect()}
        assert set(sources) == {
            "Hour", "DayOfWeek", "IsWeekend", "Latitude", "Longitude",
            "Primary_Type", "Location_Description",
        }
        assert sources["Hour"] + sources["Primary_Type"] > 0.5
    with pytest.raises(ValueError):
        bl.importances(models["DecisionTree"], by="column")


def test_run_table(spark, trained, tmp_path):
    path = str(tmp_path / "runs")
    bl.append_runs(trained[0], path)
    bl.append_runs(trained[0].limit(1), path)
    stored = bl.read_layer(spark, path)
    assert stored.count() == 6
    assert bl.metrics_long(stored).count() == 18
    best = bl.best_model(stored).head()
    assert best["auc"] == stored.agg(F.max("auc")).head()[0]


def test_nothing_stays_cached(spark, parts):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    bl.train_all(*parts, names=["DecisionTree"])
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def nodes_of(trained, name: str):
    model = trained[1][name]
    return bl.materialize(bl.node_table(model), "nodes"), bl.kind_of(model)


@pytest.mark.parametrize("name", TREES)
def test_node_tables_predict_as_the_models(trained, parts, name):
    nodes, kind = nodes_of(trained, name)
    both = bl.predict_from_nodes(trained[1][name].transform(parts[1]), nodes, kind)
    assert both.where("prediction <> table_prediction OR table_prediction IS NULL").count() == 0
    assert both.count() == parts[1].count()
    roots = nodes.where("node = 0").select("tree", "weight").collect()
    assert len(roots) == {"DecisionTree": 1, "RandomForest": 20, "GBTClassifier": 10}[name]
    assert {r["weight"] for r in roots} == ({1.0, 0.1} if kind == "margin" else {1.0})
    leaves = nodes.where("left < 0")
    assert leaves.where("feature >= 0 OR right >= 0 OR threshold IS NOT NULL").count() == 0


@pytest.mark.parametrize("name", TREES)
def test_importances_follow_from_the_nodes(trained, parts, name):
    nodes, kind = nodes_of(trained, name)
    model = trained[1][name]
    if kind == "margin":
        again = bl.boosted_stats(model.transform(parts[0]).select("features", "label"), nodes)
        both = nodes.select("tree", "node", "stats").join(
            again.select("tree", "node", F.col("stats").alias("again")), ["tree", "node"]
        )
        rows = both.collect()
        assert len(rows) == nodes.count()
        assert all(r["again"] == pytest.approx(r["stats"], rel=1e-9, abs=1e-9) for r in rows)
        nodes = again
    found = {r["feature"]: r["importance"] for r in bl.importances_from_nodes(nodes, kind).collect()}
    own = model.stages[-1].featureImportances.toArray()
    assert [found.get(slot, 0.0) for slot in range(len(own))] == pytest.approx(own, abs=1e-9)


def test_a_tree_of_one_leaf(trained, parts):
    prep = trained[1]["DecisionTree"].stages[:-1]
    vectors = PipelineModel(prep).transform(parts[0])
    model = PipelineModel([*prep, DecisionTreeClassifier(maxDepth=0).fit(vectors)])
    nodes = bl.node_table(model)
    assert nodes.count() == 1
    both = bl.predict_from_nodes(model.transform(parts[1]), nodes, "votes")
    assert both.where("prediction <> table_prediction OR table_prediction IS NULL").count() == 0
    assert bl.importances_from_nodes(nodes, "votes").count() == 0


def test_the_logistic_gradient_is_zero_at_the_fit_only(trained, parts):
    train = parts[0]
    # Exact separation has no optimum: one label in nine is turned around.
    noisy = train.withColumn("label", F.when(F.crc32("ID") % 9 == 0, 1 - F.col("label")).otherwise(F.col("label")))
    _, models = bl.train_all(noisy, parts[1], names=["LogisticRegression"])
    model = models["LogisticRegression"]
    found = {r["slot"]: r["gradient"] for r in bl.logistic_gradient(model, noisy).collect()}
    assert len(found) == model.stages[-1].numFeatures + 1 and "intercept" in found
    assert max(map(abs, found.values())) < 1e-3
    # Other labels have another optimum.
    other = {r["slot"]: r["gradient"] for r in bl.logistic_gradient(model, train).collect()}
    assert max(map(abs, other.values())) > 0.02
