"""Batch form of the layer job, for history that is complete."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotterline.operators.layers import (
    parse_payload,
    to_bronze,
    to_gold,
    to_silver,
    with_event_day,
)
from blotterline.schema import EVENT_DAY
from blotterline.sinks.partitions import BACKFILL, strangers
from blotterline.sinks.tables import replace_batch


def backfill(envelope: DataFrame, base: str, fmt: str = "parquet") -> None:
    """Write bronze, silver and gold below ``base`` from a batch of messages, anew.

    Each layer is read back for the next, so messages are parsed and deduplicated once
    and gold always has the records of silver. A base that a stream has written to is refused: its
    checkpoint would go on as if its rows were there. History that a stream shall go on from is
    run as that stream's first batches instead.
    """
    spark = envelope.sparkSession
    layers = [f"{base}/{name}" for name in ("bronze", "silver", "gold")]
    if fmt == "parquet":
        for path in layers:
            others = strangers(spark, path, F.col("writer") == BACKFILL)
            if others:
                raise RuntimeError(f"{path} holds {others}, which no backfill wrote")

    def write(df: DataFrame, path: str) -> DataFrame:
        if fmt == "parquet":
            return replace_batch(df, path, fmt, BACKFILL, 0)
        df.write.format(fmt).mode("overwrite").save(path)
        return spark.read.format(fmt).load(path)

    bronze = write(to_bronze(envelope), layers[0])
    silver = write(to_silver(parse_payload(bronze)), layers[1])
    # History is read by period: its files are cut by the day of the event.
    gold = with_event_day(to_gold(silver)).repartitionByRange(EVENT_DAY).sortWithinPartitions(EVENT_DAY)
    write(gold, layers[2])
