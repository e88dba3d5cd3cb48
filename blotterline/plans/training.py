"""Training and comparison of the classifiers."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import reduce

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotterline.operators.encoding import classifiers, fit_prep
from blotterline.operators.evaluation import accuracy, confusion, score_tally, weighted_f1
from blotterline.operators.features import derive_features
from blotterline.operators.importance import importances
from blotterline.operators.ranking import auc, roc_points
from blotterline.operators.split import split_by_hash
from blotterline.schema import ENCODED, FEATURE_INPUTS, RUN_SCHEMA
from blotterline.session import materialize
from blotterline.sinks.tables import append_runs, save_model

#: Rows times slots of the feature vector that one task of a fit reads. Boosted trees keep some 18 bytes
#: of each.
TASK_CELLS = 1 << 23

# Ensembles whose feature importances are reported.
ENSEMBLES = ["RandomForest", "GBTClassifier"]


def train_all(
    train: DataFrame,
    test: DataFrame,
    names: list[str] | None = None,
    seed: int = 42,
    parallelism: int = 1,
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Fit the classifiers on ``train`` and measure them on ``test``.

    Returns one run row per classifier (``run_id, run_ts, classifier, accuracy, f1, auc``)
    and the fitted pipelines. ``names`` selects classifiers. ``parallelism`` of them are
    fitted at the same time, as a single fit of a small model seldom fills a cluster.

    The preparation is fitted once, on the train part alone, and shared. Each model is
    applied to the test part once; its measures come from the counted scores.
    """
    runs, models, _ = _train_and_measure(train, test, names, seed, parallelism)
    return runs, models


def _train_and_measure(
    train: DataFrame, test: DataFrame, names: list[str] | None, seed: int, parallelism: int
) -> tuple[DataFrame, dict[str, PipelineModel], dict[str, DataFrame]]:
    """As :func:`train_all`, with each model's counted scores on the test part."""
    chosen = classifiers(seed)
    if names is not None:
        chosen = {name: chosen[name] for name in names}
    prep = fit_prep(train)
    train_vectors = _prepared(prep, train)
    test_vectors = _prepared(prep, test)

    def run(name: str, estimator: Estimator) -> tuple[tuple, PipelineModel, DataFrame]:
        fitted = estimator.fit(train_vectors)
        tally = materialize(score_tally(fitted.transform(test_vectors)), f"scores-{name}")
        row = (
            uuid.uuid4().hex,
            datetime.now(timezone.utc),
            name,
            accuracy(tally, "rows").head()[0],
            weighted_f1(tally, "rows").head()[0],
            auc(tally, "score", "rows").head()[0],
        )
        return row, PipelineModel([*prep.stages, fitted]), tally

    in_thread = inheritable_thread_target(train.sparkSession)
    try:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            started = {
                name: pool.submit(in_thread(run), name, estimator)
                for name, estimator in chosen.items()
            }
            finished = {name: future.result() for name, future in started.items()}
    finally:
        train_vectors.unpersist()
        test_vectors.unpersist()
    runs = train.sparkSession.createDataFrame([row for row, *_ in finished.values()], RUN_SCHEMA)
    models = {name: model for name, (_, model, _) in finished.items()}
    return runs, models, {name: tally for name, (*_, tally) in finished.items()}


def _prepared(prep: PipelineModel, part: DataFrame) -> DataFrame:
    # Iterative fits read this many times. The lineage below is narrow unless large
    # partitions are dealt out, so a lost executor costs a rescan of its partitions only.
    vectors = prep.transform(part).select("features", "label")
    sizes = part.groupBy(F.spark_partition_id().alias("part")).count()
    largest, total, parts = sizes.agg(F.max("count"), F.sum("count"), F.count(F.lit(1))).head()
    task_rows = max(1, TASK_CELLS // vectors.schema["features"].metadata["ml_attr"]["num_attrs"])
    if (largest or 0) > task_rows:
        # Every fit reads whole partitions from here: their size must not grow with the input.
        vectors = vectors.repartition(max(parts, -(-total // task_rows)))
    return vectors.persist(StorageLevel.MEMORY_AND_DISK)


def best_model(runs: DataFrame, by: str = "auc") -> DataFrame:
    """The run with the highest ``by``; runs without a value come last."""
    return runs.orderBy(F.desc_nulls_last(by), "classifier", "run_ts").limit(1)


def train_and_record(
    gold: DataFrame,
    base: str,
    fmt: str = "parquet",
    parallelism: int = 1,
    max_roc_points: int | None = None,
) -> DataFrame:
    """The whole training job over gold; gives back the run rows.

    Below ``base``: ``runs`` gains the run rows; ``models/<classifier>`` and the tables
    ``importances`` (of the ensembles), ``confusion`` and ``roc`` (of the model with the
    best AUC) are replaced. ``roc`` has every point unless ``max_roc_points`` thins it.
    """
    inputs = [name for name in FEATURE_INPUTS if name not in ENCODED]
    categories = [source for _, source in ENCODED.values()]
    # Dates and coordinates are read once; the passes below scan these few columns.
    features = materialize(
        derive_features(gold).select("ID", *inputs, *categories, "label"), "features"
    )
    train, test = split_by_hash(features)
    runs, models, tallies = _train_and_measure(train, test, None, 42, parallelism)
    append_runs(runs, f"{base}/runs", fmt)
    for name, model in models.items():
        save_model(model, f"{base}/models/{name}")

    best = best_model(runs).head()["classifier"]
    tally = tallies[best]
    tables = {
        "importances": [(name, importances(models[name])) for name in ENSEMBLES],
        "confusion": [(best, confusion(tally, "rows"))],
        "roc": [(best, roc_points(tally, max_roc_points, "score", "rows"))],
    }
    for table, parts in tables.items():
        named = [part.select(F.lit(name).alias("classifier"), "*") for name, part in parts]
        rows = reduce(DataFrame.unionByName, named)
        rows.write.format(fmt).mode("overwrite").save(f"{base}/{table}")
    return runs
