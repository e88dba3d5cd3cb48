"""From a message stream to the bronze, silver and gold tables."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from blotterline.operators.layers import (
    EVENT_TIME,
    is_complete,
    parse_payload,
    silver_and_dated,
    to_bronze,
    to_gold,
    to_silver,
    with_event_day,
)
from blotterline.operators.rejects import split_messages
from blotterline.plans.counts import partial_counts
from blotterline.schema import EVENT_DAY, SILVER_SCHEMA
from blotterline.session import conf_defaults
from blotterline.sinks.partitions import BACKFILL, strangers
from blotterline.sinks.tables import replace_batch
from blotterline.sources.layers import read_layer
from blotterline.streaming.state import watermark

# The deduplication keeps every ID. RocksDB holds that state on disk instead of in the
# executors' heap and checkpoints changes only.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

QUERY_ID = "sql.streaming.queryId"


def start_medallion(
    source: DataFrame,
    base: str,
    checkpoint: str,
    fmt: str = "parquet",
    trigger: dict[str, Any] | None = None,
    console: bool = False,
    delay: str | None = None,
    console_rows: int = 20,
    rejects: bool = False,
    counts: bool = False,
) -> list[StreamingQuery]:
    """Start the job and give back its two queries, bronze and refined.

    ``source`` is a message stream. Layers are written below ``base``, checkpoints below
    ``checkpoint``; a restart with the same checkpoint resumes. ``trigger`` is passed to
    Spark (``{'availableNow': True}`` for a bounded run); without it, micro-batches follow
    each other as fast as they can. ``console`` shows the first ``console_rows`` rows of each batch of
    gold.

    ``delay`` bounds the deduplication state, see :func:`to_silver`; the records that it drops
    behind the watermark are the layer ``late``. ``rejects`` adds the layer ``rejects``: payloads of
    each batch of bronze that silver does not take, with the reason (:func:`judge_messages`).
    ``counts`` adds the layer ``counts``: partial counts of each batch of gold, see
    :class:`CountsView`.

    History goes through the same job: its files as the first, bounded batches of the same
    checkpoint, so that the deduplication knows its IDs. A base that a batch backfill or
    anything else has written to is refused.

    Silver, late and gold share one deduplication. Gold and counts are made from the batch of silver
    as stored, so they agree even when a lost executor forces a recomputation in between, and
    a replayed batch replaces itself in all layers: it is written before the batch is committed.

    The number of state partitions is ``spark.sql.shuffle.partitions`` at the first start
    and is kept by the checkpoint.
    """
    spark = source.sparkSession
    if fmt == "parquet":
        for layer in ("bronze", "rejects", "silver", "late", "gold", "counts"):
            _refuse_strangers(spark, f"{base}/{layer}")

    def write_bronze(batch: DataFrame, batch_id: int) -> None:
        writer = _query_of(batch)
        stored = replace_batch(batch, f"{base}/bronze", fmt, writer, batch_id)
        if rejects:
            _, rejected = split_messages(stored)
            replace_batch(rejected, f"{base}/rejects", fmt, writer, batch_id)

    bronze = (
        _writer(to_bronze(source), f"{checkpoint}/bronze", trigger)
        .foreachBatch(write_bronze)
        .start()
    )

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # Named after the query as well: batches of a new checkpoint are new batches.
        writer = _query_of(batch)
        if delay is not None:
            # Late is what was behind the watermark of the batch before.
            bound = watermark(spark, checkpoint, batch_id - 1)
            is_late = F.unix_micros(EVENT_TIME) <= bound * 1000
            batch = batch.filter(F.col(EVENT_TIME).isNull() | is_late)
        if delay is not None or fmt != "parquet":
            # Stored once first, so that all layers are made of the same rows.
            path, schema = f"{checkpoint}/staged", batch.schema
            batch.write.mode("overwrite").parquet(path)
            batch = spark.read.schema(schema).parquet(path)
        if delay is not None:
            late = batch.filter(F.col(EVENT_TIME).isNotNull()).drop(EVENT_TIME)
            replace_batch(late, f"{base}/late", fmt, writer, batch_id)
            batch = batch.filter(F.col(EVENT_TIME).isNull()).drop(EVENT_TIME)
        silver = replace_batch(batch, f"{base}/silver", fmt, writer, batch_id)
        gold = with_event_day(to_gold(silver))
        gold = replace_batch(gold, f"{base}/gold", fmt, writer, batch_id).drop(EVENT_DAY)
        if counts:
            replace_batch(partial_counts(gold), f"{base}/counts", fmt, writer, batch_id)
        if console:
            print(f"Batch: {batch_id}")
            gold.show(console_rows, truncate=False)

    def intake(parsed: DataFrame) -> DataFrame:
        # Progress reports carry how many records came in and how many of them are incomplete.
        return parsed.observe(
            "intake",
            F.count(F.lit(1)).alias("records"),
            F.count_if(~is_complete()).alias("incomplete"),
        )

    parsed = parse_payload(source)
    refined_rows = to_silver(intake(parsed)) if delay is None else silver_and_dated(intake(parsed), parsed, delay)
    writer = _writer(refined_rows, f"{checkpoint}/refined", trigger)
    try:
        with conf_defaults(source.sparkSession, STATE_CONF):
            refined = writer.foreachBatch(write_batch).start()
    except Exception:
        bronze.stop()
        raise
    return [bronze, refined]


def _query_of(batch: DataFrame) -> str:
    query_id = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
    if query_id is None:
        raise RuntimeError("micro-batch without query id")
    return query_id


def _refuse_strangers(spark: SparkSession, path: str) -> None:
    """A layer that something else has written to is not appended to: the deduplication would
    not know its records."""
    others = strangers(spark, path, F.col("writer") != BACKFILL)
    if others:
        raise RuntimeError(
            f"{path} holds {others}, which no stream wrote; run history as the first batches "
            "of the stream, or use another base"
        )


def late_records(spark: SparkSession, base: str, fmt: str = "parquet") -> DataFrame:
    """The records that bounded state dropped behind its watermark, in all runs, as silver's columns.

    Copies of one record in one Arrow batch are one row, as the deduplication sees them.
    """
    return read_layer(spark, f"{base}/late", fmt, on_missing="empty", schema=SILVER_SCHEMA)


def _writer(stream: DataFrame, checkpoint: str, trigger: dict[str, Any] | None):
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger) if trigger else writer


def await_any(spark: SparkSession) -> None:
    """Wait until any running query ends; raise if it failed."""
    spark.streams.awaitAnyTermination()


def drain(queries: list[StreamingQuery]) -> None:
    """Wait for all queries of a bounded run; raise if one failed."""
    for query in queries:
        query.awaitTermination()
