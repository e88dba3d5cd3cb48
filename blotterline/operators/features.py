"""Calendar and location features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotterline.functions import (
    day_name_of,
    day_number,
    event_time,
    hour_of_day,
    is_blank,
    or_unknown,
    to_number,
    weekend_flag,
    weekend_text,
)


def _with_read(df: DataFrame, kept: list[str], **read: Column) -> DataFrame:
    """Columns ``kept`` and columns read from text, each text read once.

    The generated struct keeps later filters on the values above the reading. As plain
    columns, they would be pushed below it and read the text again.
    """
    values = F.struct(*[column.alias(name) for name, column in read.items()])
    return df.select(*kept, F.inline(F.array(values)))


def derive_features(gold: DataFrame) -> DataFrame:
    """Gold plus ``ts, Hour, DayOfWeek, IsWeekend, label``; coordinates as double.

    Rows without a readable date or without two finite coordinates are dropped. Blank
    categories become ``UNKNOWN``. No shuffle.
    """
    located = gold.filter(
        ~is_blank(F.col("Latitude")) & ~is_blank(F.col("Longitude")) & ~is_blank(F.col("Date"))
    )
    read = _with_read(
        located,
        [name for name in gold.columns if name not in ("Latitude", "Longitude")],
        ts=event_time(F.col("Date")),
        Latitude=to_number(F.col("Latitude")),
        Longitude=to_number(F.col("Longitude")),
    )
    usable = read.filter(
        F.col("ts").isNotNull()
        & F.col("Arrest").isNotNull()
        # Null, NaN and infinity are not below infinity.
        & (F.abs("Latitude") < float("inf"))
        & (F.abs("Longitude") < float("inf"))
    )
    return usable.select(
        *[
            or_unknown(F.col(name)).alias(name)
            if name in ("Primary_Type", "Location_Description")
            else F.col(name)
            for name in gold.columns
        ],
        "ts",
        hour_of_day(F.col("ts")).alias("Hour"),
        day_number(F.col("ts")).alias("DayOfWeek"),
        weekend_flag(day_number(F.col("ts"))).alias("IsWeekend"),
        F.col("Arrest").cast("int").alias("label"),
    )


def weekend_label(
    df: DataFrame,
    bad_date: str = "weekday",
    labels: tuple[str, str] = ("weekend", "weekday"),
) -> DataFrame:
    """Add ``period``, one of the two ``labels``.

    ``bad_date='weekday'`` counts rows without a readable date as weekday, ``'drop'``
    leaves them out.
    """
    if bad_date not in ("weekday", "drop"):
        raise ValueError("bad_date must be 'weekday' or 'drop'")
    if bad_date == "weekday":
        day = day_number(event_time(F.col("Date")))
        return df.withColumn("period", weekend_text(day, *labels))
    dated = _with_read(df, df.columns, __ts=event_time(F.col("Date")))
    period = weekend_text(day_number(F.col("__ts")), *labels)
    return dated.filter(F.col("__ts").isNotNull()).select(*df.columns, period.alias("period"))


def day_name(df: DataFrame) -> DataFrame:
    """Add ``day_name``, null for a date that cannot be read."""
    return df.withColumn("day_name", day_name_of(event_time(F.col("Date"))))
