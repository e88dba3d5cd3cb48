"""Scan of a stored layer."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotterline.functions import event_time
from blotterline.schema import EVENT_DAY, GOLD_SCHEMA
from blotterline.sinks.partitions import MISSING, stored, without_partitions


class LayerNotReady(RuntimeError):
    """The layer is absent or has no rows yet."""


def read_layer(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    on_missing: str = "error",
    schema: T.StructType | None = None,
) -> DataFrame:
    """The current content of a layer.

    Every call lists the table anew, so calling again is the refresh. The columns that
    only tell batches apart (``writer``, ``batch``) are left out.

    ``on_missing='error'`` raises :class:`LayerNotReady` for an absent or empty layer, as
    training needs; ``'empty'`` gives a frame of ``schema`` without rows for an absent one,
    as display needs. No local file check is made, so any file system works.
    """
    if on_missing not in ("error", "empty"):
        raise ValueError("on_missing must be 'error' or 'empty'")
    if on_missing == "empty" and schema is None:
        raise ValueError("on_missing='empty' needs a schema")
    try:
        layer = without_partitions(spark.read.format(fmt).load(path))
    except AnalysisException as error:
        if error.getCondition() not in MISSING:
            raise
        if on_missing == "empty":
            return spark.createDataFrame([], schema)
        raise LayerNotReady(f"no layer at {path}") from error
    if on_missing == "error" and layer.isEmpty():
        raise LayerNotReady(f"the layer at {path} has no rows")
    return layer


def read_period(
    spark: SparkSession, path: str, first: date, last: date, fmt: str = "parquet"
) -> DataFrame:
    """The rows of gold whose event is on one of the days from ``first`` to ``last``.

    Rows without a readable date are on no day. Files and row groups whose days lie outside are
    skipped by their statistics; compaction and backfills cut files by day. Batches that were
    written without that column are read whole. An absent layer has no rows.
    """
    days = T.StructType([*GOLD_SCHEMA.fields, T.StructField(EVENT_DAY, T.DateType())])
    if fmt == "parquet":
        layer = stored(spark, path, days)
        layer = spark.createDataFrame([], days) if layer is None else layer
    else:
        layer = spark.read.format(fmt).load(path)
    day = F.col(EVENT_DAY)
    written = event_time(F.col("Date")).cast("date").between(F.lit(first), F.lit(last))
    # In this form, the part that the files' statistics can decide is a filter of its own.
    inside = (day.between(F.lit(first), F.lit(last)) | day.isNull()) & (day.isNotNull() | written)
    return layer.where(inside).select(*GOLD_SCHEMA.names)
