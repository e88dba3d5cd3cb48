"""Publication of records as JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_messages(df: DataFrame) -> DataFrame:
    """One JSON object per row in ``value``; null fields are written as ``null``."""
    return df.select(
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")
    )


def publish(
    df: DataFrame,
    path: str | None = None,
    servers: str | None = None,
    topic: str | None = None,
) -> None:
    """Append the rows to a folder of JSON-lines files, or send them to a Kafka topic.

    Kafka writes wait for all replicas and retry five times. They need the
    ``spark-sql-kafka-0-10`` package and are not tested where that is not available.
    """
    messages = to_messages(df)
    if path is not None and servers is None and topic is None:
        messages.write.mode("append").text(path)
    elif path is None and servers is not None and topic is not None:
        (
            messages.write.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("kafka.acks", "all")
            .option("kafka.retries", "5")
            .option("topic", topic)
            .save()
        )
    else:
        raise ValueError("give either path, or servers and topic")
