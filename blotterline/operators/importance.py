"""Feature importances of tree ensembles as a table."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotterline.schema import ENCODED, FEATURE_INPUTS, GOLD_SCHEMA


def slot_names(model: PipelineModel) -> list[str]:
    """Names of the feature vector's slots, in order, from the column metadata."""
    spark = SparkSession.active()
    frame = spark.createDataFrame([], GOLD_SCHEMA).select(
        *[F.col(source) for _, source in ENCODED.values()],
        *[F.lit(0.0).alias(name) for name in FEATURE_INPUTS if name not in ENCODED],
    )
    for stage in model.stages[:-1]:
        frame = stage.transform(frame)
    groups = frame.schema["features"].metadata["ml_attr"]["attrs"].values()
    slots = {attr["idx"]: attr["name"] for group in groups for attr in group}
    return [slots[i] for i in range(len(slots))]


def _source_of(slot: str) -> str:
    for encoded, (_, source) in ENCODED.items():
        if slot.startswith(f"{encoded}_"):
            return source
    return slot


def importances(model: PipelineModel, by: str = "slot") -> DataFrame:
    """Importances of a fitted pipeline whose last stage is a tree model, ascending.

    ``by='slot'`` gives every slot of the feature vector as ``slot, source, importance``;
    ``by='source'`` sums the one-hot slots of a column into ``source, importance``.
    """
    if by not in ("slot", "source"):
        raise ValueError("by must be 'slot' or 'source'")
    values = model.stages[-1].featureImportances.toArray()
    # One row per slot of the fitted model, which the driver holds already.
    table = SparkSession.active().createDataFrame(
        [
            (name, _source_of(name), float(value))
            for name, value in zip(slot_names(model), values, strict=True)
        ],
        "slot string, source string, importance double",
    )
    if by == "source":
        summed = table.groupBy("source").agg(F.sum("importance").alias("importance"))
        return summed.orderBy("importance", "source")
    return table.orderBy("importance", "slot")
