"""Feature preparation and the five classifiers."""

from __future__ import annotations

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    OneHotEncoder,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotterline.schema import ENCODED, FEATURE_INPUTS


_INDEXES = [index for index, _ in ENCODED.values()]
_SOURCES = [source for _, source in ENCODED.values()]


def _encoder() -> OneHotEncoder:
    return OneHotEncoder(inputCols=_INDEXES, outputCols=list(ENCODED))


def _assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=FEATURE_INPUTS, outputCol="features")


def prep_pipeline() -> Pipeline:
    """Index and one-hot both categories, then assemble ``features``.

    Categories unseen in training, and null, become the all-zero vector. One indexer
    counts both columns in one pass.
    """
    indexer = StringIndexer(inputCols=_SOURCES, outputCols=_INDEXES, handleInvalid="keep")
    return Pipeline(stages=[indexer, _encoder(), _assembler()])


def fit_prep(train: DataFrame) -> PipelineModel:
    """``prep_pipeline().fit(train)`` for very many partitions or values.

    Spark's indexer merges one map of all values per partition in a single task. Here the
    values of all columns are counted in one pass, so only the finished lists of values, which
    the model holds anyway, reach the driver.
    """
    pairs = [F.struct(F.lit(s).alias("source"), F.col(s).alias("value")) for s in _SOURCES]
    counts = (
        train.select(F.inline(F.array(*pairs)))
        .where(F.col("value").isNotNull())
        .groupBy("source", "value")
        .count()
        .orderBy("source", F.desc("count"), "value")
        .collect()
    )
    indexers = [
        StringIndexerModel.from_labels(
            [row["value"] for row in counts if row["source"] == source],
            inputCol=source,
            outputCol=index,
            handleInvalid="keep",
        )
        for index, source in ENCODED.values()
    ]
    # The sizes of the one-hot vectors come from the indexers' metadata, without a job.
    encoder = _encoder().fit(PipelineModel(indexers).transform(train))
    return PipelineModel([*indexers, encoder, _assembler()])


def classifiers(seed: int = 42) -> dict[str, Estimator]:
    """The compared classifiers by name; parameters not given are Spark's defaults."""
    columns = {"featuresCol": "features", "labelCol": "label"}
    # Names and parameters.
    return {
        "LogisticRegression": LogisticRegression(**columns),
        "DecisionTree": DecisionTreeClassifier(**columns, seed=seed),
        "RandomForest": RandomForestClassifier(**columns, numTrees=20, seed=seed),
        "GBTClassifier": GBTClassifier(**columns, maxIter=10, seed=seed),
        "NaiveBayes": NaiveBayes(**columns, modelType="gaussian"),
    }
