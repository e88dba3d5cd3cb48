"""Incident records made from the ``events`` table.

Clean data would test nothing, so gaps, bad dates and odd flags are planted by remainders of
``event_id``. Every event gives a record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotterline.schema import DATE_FORMAT, FIELDS


def _hit(divisor: int) -> Column:
    return F.col("event_id") % divisor == 0


def _fields() -> dict[str, Column]:
    ts = F.col("ts").cast("timestamp")
    user = F.col("user_id")
    return {
        "ID": F.col("event_id").cast("string"),
        "Date": F.when(_hit(101), None)
        .when(_hit(103), "bad date")
        .otherwise(F.date_format(ts, DATE_FORMAT)),
        "Primary_Type": F.when(_hit(107), None).when(_hit(109), "  ").otherwise(F.col("event_type")),
        "Description": F.concat(
            F.lit('said "'), F.col("event_type"), F.lit('",\nunit '), user.cast("string")
        ),
        "Location_Description": F.when(_hit(89), "").otherwise(
            F.concat(F.lit("SITE_"), (F.col("event_id") % 23).cast("string"))
        ),
        "Arrest": F.when(F.col("value") > 60, "true")
        .when(_hit(113), "TRUE")
        .when(_hit(127), None)
        .otherwise("false"),
        "Domestic": F.when(_hit(7), "true").otherwise("false"),
        "District": (user % 25 + 1).cast("string"),
        "Year": F.year(ts).cast("string"),
        "Latitude": F.when(_hit(97), "")
        .when(_hit(131), "Infinity")
        .when(_hit(137), "1e400")
        .when(_hit(139), "NaN")
        .when(_hit(149), "41.8f")
        .otherwise(
            F.concat(F.lit("41."), (user % 400 + 600).cast("string"))
        ),
        "Longitude": F.concat(F.lit("-87."), (user % 300 + 500).cast("string")),
    }


def spread(events: DataFrame, parts: int = 8) -> DataFrame:
    """The events over several partitions; the test tables are one file each."""
    return events.repartition(parts, "event_id")


def incident_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per event, all 21 fields as strings."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    made = _fields()
    return spread(events).select(
        *[made.get(name, F.lit(None)).cast("string").alias(name) for name in FIELDS]
    )


def message_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages (``value`` as text): each record one to three times, and the ``props`` of
    each event, which is JSON but no incident."""
    events = spread(spark.read.parquet(f"{sf_dir}/events.parquet"))
    made = _fields()
    record = F.struct(
        *[made.get(name, F.lit(None)).cast("string").alias(name) for name in FIELDS]
    )
    text = F.to_json(record, {"ignoreNullFields": "false"})
    copies = F.array_repeat(text, (F.col("user_id") % 3 + 1).cast("int"))
    return events.select(F.explode(F.array_append(copies, F.col("props"))).alias("value"))


#: Events whose messages one task of :func:`landed` makes and writes as one file.
FILE_EVENTS = 250_000


def landed(spark: SparkSession, sf_dir: str, chosen: Column, block: str, least: int = 4) -> DataFrame:
    """As :func:`arrivals`, over ``least`` partitions and more of a large table: the events are dealt
    out before their messages, many times as long, are made."""
    count = spark.read.parquet(f"{sf_dir}/events.parquet").where(chosen).count()
    return arrivals(spark, sf_dir, chosen, block, max(least, -(-count // FILE_EVENTS)))


def arrivals(
    spark: SparkSession, sf_dir: str, chosen: Column, block: str, parts: int | None = None
) -> DataFrame:
    """Messages of the chosen events, each once and with ``block`` in its record, and some that
    are no record: cut off, no JSON, JSON ``null``."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").where(chosen)
    if parts is not None:
        events = spread(events, parts)
    made = {**_fields(), "Block": F.lit(block)}
    record = F.struct(
        *[made.get(name, F.lit(None)).cast("string").alias(name) for name in FIELDS]
    )
    text = F.to_json(record, {"ignoreNullFields": "false"})
    dirt = (
        F.when(_hit(50), F.substring(text, 1, 40))
        .when(_hit(51), "no json")
        .when(_hit(53), "null")
    )
    return events.select(F.explode(F.filter(F.array(text, dirt), lambda x: x.isNotNull())).alias("value"))
