"""The state of the deduplication as tables, read from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def dedup_state(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """ID and ``expires`` of every record that the refined query remembers.

    ``checkpoint`` is the one given to ``start_medallion``. ``batch`` is a past batch (the newest by
    default), as long as the checkpoint keeps it. ``expires`` is the event time that the watermark
    has to pass before an ID is forgotten; null for a state that keeps IDs for ever. Read by Spark's
    state source, one task per state partition.
    """
    reader = spark.read.format("statestore")
    if batch is not None:
        reader = reader.option("batchId", batch)
    state = reader.load(f"{checkpoint}/refined")
    value = state.schema["value"].dataType
    expires = F.lit(None).cast("timestamp")
    if "expiresAtMicros" in value.names:
        expires = F.timestamp_micros("value.expiresAtMicros")
    return state.select(F.col("key.ID").alias("ID"), expires.alias("expires"), "partition_id")


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """operator, stores, partitions and the batches that can be read, of the refined query."""
    found = spark.read.format("state-metadata").load(f"{checkpoint}/refined")
    return found.select(
        F.col("operatorName").alias("operator"),
        F.col("stateStoreName").alias("store"),
        F.col("numPartitions").alias("partitions"),
        F.col("minBatchId").alias("first_batch"),
        F.col("maxBatchId").alias("last_batch"),
    )


def watermark(spark: SparkSession, checkpoint: str, batch: int) -> int:
    """The watermark (milliseconds since 1970) that a batch of the refined query was planned with.

    0 before the first batch, which therefore drops records up to 1970 as Spark does.
    """
    if batch < 0:
        return 0
    lines = spark.read.text(f"{checkpoint}/refined/offsets/{batch}")
    return lines.agg(F.max(F.get_json_object("value", "$.batchWatermarkMs").try_cast("long"))).first()[0] or 0
