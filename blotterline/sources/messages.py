"""Scans of the message feed, all in the shape of Spark's Kafka source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotterline.schema import ENVELOPE_SCHEMA


def kafka_source(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """Stream of a Kafka topic.

    ``starting`` counts only for a new checkpoint; a restart goes on where it stopped. With
    the defaults, records sent before the first start or expired in the broker are skipped
    without an error: use ``starting='earliest'`` for a backfill and
    ``fail_on_data_loss=True`` to be told.

    ``max_offsets_per_trigger`` bounds a micro-batch. ``min_partitions`` splits the offset
    ranges of a topic with few partitions over more tasks.

    Needs the ``spark-sql-kafka-0-10`` package on the class path. That package is not
    available where this library is tested; :func:`file_source` stands in for it there.
    """
    stream = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if max_offsets_per_trigger is not None:
        stream = stream.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    if min_partitions is not None:
        stream = stream.option("minPartitions", min_partitions)
    return stream.load()


def file_source(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    max_file_age: str = "36500d",
) -> DataFrame:
    """Stream of a folder of JSON-lines files, in the shape of :func:`kafka_source`.

    ``max_files_per_trigger`` paces the feed. Files older than the newest by ``max_file_age``
    are skipped without an error; the default skips none, whatever time stamps copies keep. The
    checkpoint remembers the names of files of that age.
    """
    stream = spark.readStream.format("text").option("maxFileAge", max_file_age)
    if max_files_per_trigger is not None:
        stream = stream.option("maxFilesPerTrigger", max_files_per_trigger)
    return as_envelope(stream.load(path))


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """All messages of a folder of JSON-lines files as a batch."""
    return as_envelope(spark.read.text(path))


def as_envelope(lines: DataFrame) -> DataFrame:
    """Message texts (``value``) with the other envelope columns as typed nulls."""

    def column(name: str) -> Column:
        return F.col(name) if name == "value" else F.lit(None)

    return lines.select(
        *[column(f.name).cast(f.dataType).alias(f.name) for f in ENVELOPE_SCHEMA.fields]
    )
