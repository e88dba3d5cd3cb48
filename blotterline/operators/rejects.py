"""What the layers and the features leave out, with the reason.

Every record has one reason, the first that applies in the order below, or none when it is taken.
Reading and judging are one pass; the parts are narrow filters of one frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotterline.functions import event_time, is_blank, to_number
from blotterline.schema import FIELDS, INCIDENT_SCHEMA, REQUIRED_FIELDS

#: Reasons of the intake besides ``no <field>`` for a required field.
NO_PAYLOAD, MALFORMED, NO_RECORD = "no payload", "malformed JSON", "no record"
_CORRUPT = "__corrupt"


def judge_messages(envelope: DataFrame) -> DataFrame:
    """The fields of each payload, the payload's text, and ``reason``: null when silver takes it.

    ``no payload`` for a null or blank one, ``no record`` for JSON that holds none (``null``, an empty
    array), ``malformed JSON`` for what else is no JSON object, then the first required field that is
    null.
    """
    schema = T.StructType([*INCIDENT_SCHEMA.fields, T.StructField(_CORRUPT, T.StringType())])
    text = F.col("value").cast("string")
    record = F.from_json(text, schema, {"columnNameOfCorruptRecord": _CORRUPT})
    # One generated struct: filters on the reason stay above the reading.
    read = F.struct(record.alias("record"), text.alias("payload"))
    parts = envelope.select(F.inline(F.array(read)))
    reason = (
        F.when(is_blank(F.col("payload")), F.lit(NO_PAYLOAD))
        .when(F.trim("payload").isin("null", "[]") | F.col("record").isNull(), F.lit(NO_RECORD))
        .when(F.col(f"record.{_CORRUPT}").isNotNull(), F.lit(MALFORMED))
    )
    for name in REQUIRED_FIELDS:
        reason = reason.when(F.col(f"record.{name}").isNull(), F.lit(f"no {name}"))
    return parts.select(*[F.col(f"record.{name}") for name in FIELDS], "payload", reason.alias("reason"))


def split_messages(envelope: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The records that silver takes (fields as text), and the others as ``payload, reason``."""
    judged = judge_messages(envelope)
    accepted = judged.filter(F.col("reason").isNull()).select(*FIELDS)
    return accepted, judged.filter(F.col("reason").isNotNull()).select("payload", "reason")


def _finite(name: str) -> Column:
    return F.coalesce(F.abs(to_number(F.col(name))) < float("inf"), F.lit(False))


def judge_features(gold: DataFrame) -> DataFrame:
    """``gold`` with ``reason``: null for what :func:`derive_features` keeps.

    Blank fields come first (date, latitude, longitude), then a date that does not match the format,
    then a coordinate that is no finite number, then a missing flag.
    """
    reason = F.when(is_blank(F.col("Date")), F.lit("blank Date"))
    for name in ("Latitude", "Longitude"):
        reason = reason.when(is_blank(F.col(name)), F.lit(f"blank {name}"))
    reason = reason.when(event_time(F.col("Date")).isNull(), F.lit("unreadable Date"))
    for name in ("Latitude", "Longitude"):
        reason = reason.when(~_finite(name), F.lit(f"no number in {name}"))
    reason = reason.when(F.col("Arrest").isNull(), F.lit("no Arrest"))
    return gold.select(*gold.columns, F.inline(F.array(F.struct(reason.alias("reason")))))


def reason_counts(judged: DataFrame, stage: str) -> DataFrame:
    """stage, reason, count; what was taken counts under ``accepted``."""
    counts = judged.groupBy("reason").agg(F.count(F.lit(1)).alias("count"))
    return counts.select(F.lit(stage).alias("stage"), F.coalesce("reason", F.lit("accepted")).alias("reason"), "count")
