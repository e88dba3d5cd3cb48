"""Bronze, silver and gold as functions of frames.

Each works on batches and streams alike; only sources and sinks know which it is.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotterline.functions import event_time, flag
from blotterline.operators.dedup import collapse_copies, dedup_first
from blotterline.schema import EVENT_DAY, FLAG_FIELDS, GOLD_FIELDS, INCIDENT_SCHEMA, REQUIRED_FIELDS

_EVENT_TIME = "__event_time"
#: Set in rows of :func:`silver_and_dated` that only show a record's event time.
EVENT_TIME = "__seen_at"


def to_bronze(envelope: DataFrame) -> DataFrame:
    """The raw messages with their time of arrival, the same for a whole micro-batch."""
    return envelope.withColumn("ingested_at", F.current_timestamp())


def parse_payload(envelope: DataFrame, schema: T.StructType = INCIDENT_SCHEMA) -> DataFrame:
    """The fields of the JSON payload; all null when it cannot be read.

    ``inline`` keeps filters on the fields above the parse. With ``select('data.*')`` they
    would be pushed below it and parse the payload again, once per tested field.
    """
    record = F.from_json(F.col("value").cast("string"), schema)
    return envelope.select(F.inline(F.array(record)))


def is_complete() -> Column:
    """All required fields are there. The empty string counts as there."""
    return reduce(and_, [F.col(name).isNotNull() for name in REQUIRED_FIELDS])


def clean_records(parsed: DataFrame) -> DataFrame:
    """Complete records with typed flags. Narrow: repeated records stay."""
    flags = {name: flag(F.col(name)) for name in FLAG_FIELDS}
    return parsed.filter(is_complete()).withColumns(flags)


def to_silver(parsed: DataFrame, delay: str | None = None) -> DataFrame:
    """:func:`clean_records`, one per ``ID``.

    On a stream, the first arrival of an ``ID`` wins over the whole life of the
    checkpoint, and the state keeps every ``ID`` ever seen. ``delay`` (such as
    ``'2 days'``) bounds that state: an ``ID`` is forgotten once the watermark on the
    event date has passed it by that delay, and records behind the watermark are dropped.
    That changes the result for copies further apart than the delay, and for records
    without a readable date, whose copies are then only found within one micro-batch.

    On a batch, the smallest copy in column order wins, so that reruns agree.
    """
    complete = clean_records(parsed)
    if not complete.isStreaming:
        return dedup_first(complete, ["ID"], [c for c in complete.columns if c != "ID"])

    fewer = collapse_copies(complete, "ID")
    if delay is None:
        return fewer.dropDuplicates(["ID"])
    return _within(fewer.withColumn(_EVENT_TIME, event_time(F.col("Date"))), delay).drop(_EVENT_TIME)


def _within(dated: DataFrame, delay: str) -> DataFrame:
    return dated.withWatermark(_EVENT_TIME, delay).dropDuplicatesWithinWatermark(["ID"])


def silver_and_dated(parsed: DataFrame, again: DataFrame, delay: str) -> DataFrame:
    """A stream of two kinds of rows: silver with bounded state (``EVENT_TIME`` is null), and every
    record that went into its deduplication and has a readable date, with that date.

    ``again`` has the same records as ``parsed``, for the second kind.

    Deduplication drops records behind the watermark without a trace; only the batch that it
    works on knows that watermark, and can tell from the second kind which records those were.
    """
    at = event_time(F.col("Date"))
    dated = collapse_copies(clean_records(parsed), "ID").withColumn(_EVENT_TIME, at)
    silver = _within(dated, delay).drop(_EVENT_TIME).withColumn(EVENT_TIME, F.lit(None).cast("timestamp"))
    seen = collapse_copies(clean_records(again), "ID").withColumn(EVENT_TIME, at)
    return silver.unionByName(seen.filter(F.col(EVENT_TIME).isNotNull()))


def with_event_day(gold: DataFrame) -> DataFrame:
    """Gold as it is stored: with the day of the event, whose minima and maxima per file and row group
    tell a scan of a period what to skip."""
    return gold.withColumn(EVENT_DAY, event_time(F.col("Date")).cast("date"))


def to_gold(silver: DataFrame) -> DataFrame:
    """The ten columns that analysis uses."""
    return silver.select(*GOLD_FIELDS)
