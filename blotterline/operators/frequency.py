"""Counts, frequency tables and top-k.

All are partial + final aggregates: a value that holds a large part of the rows is counted
map-side and crosses the shuffle as one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotterline.functions import event_time, hour_of_day
from blotterline.operators.features import weekend_label


def row_count(df: DataFrame) -> DataFrame:
    """One row, ``rows``."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def frequencies(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, nulls skipped, in no order.

    Null is counted as 0 and goes after counting. A filter on the column itself would be
    pushed to the scan and, for a computed column, compute it a second time.
    """
    counts = df.groupBy(column).agg(F.count(column).alias("count"))
    return counts.filter(F.col("count") > 0)


def hourly_counts(df: DataFrame) -> DataFrame:
    """Rows per hour of the day, ascending. Unreadable dates and empty hours are absent."""
    hours = df.select(hour_of_day(event_time(F.col("Date"))).alias("Hour"))
    return frequencies(hours, "Hour").orderBy("Hour")


def value_counts(df: DataFrame, column: str, share: bool = False) -> DataFrame:
    """Rows per value, most frequent first, ties by value. Nulls are skipped.

    ``share`` adds each value's part of all counted rows. The total is a scalar subquery
    over the same partial counts, so that no task sees the whole table of values.
    """
    counts = frequencies(df, column)
    if share:
        total = counts.agg(F.sum("count")).scalar()
        counts = counts.withColumn("share", F.col("count") / total)
    return counts.orderBy(F.desc("count"), F.asc(column))


def top_k(df: DataFrame, column: str, k: int = 10, share: bool = False) -> DataFrame:
    """The ``k`` most frequent values, ties by value.

    ``share`` is each value's part of the rows shown, as in a chart of just these.
    """
    order = [F.desc("count"), F.asc(column)]
    top = frequencies(df, column).orderBy(*order).limit(k)
    if not share:
        return top
    # The window sees the k rows of the limit only.
    total = F.sum("count").over(Window.partitionBy())
    return top.withColumn("share", F.col("count") / total).orderBy(*order)


def weekend_counts(
    df: DataFrame,
    bad_date: str = "weekday",
    labels: tuple[str, str] = ("weekend", "weekday"),
) -> DataFrame:
    """Rows on weekends and on weekdays; see :func:`weekend_label` for ``bad_date``."""
    labelled = weekend_label(df.select("Date"), bad_date, labels)
    return value_counts(labelled, "period")


def arrest_share(
    df: DataFrame, labels: tuple[str, str] = ("arrested", "not arrested")
) -> DataFrame:
    """Rows and share per arrest outcome."""
    shares = value_counts(df, "Arrest", share=True)
    outcome = F.when(F.col("Arrest"), F.lit(labels[0])).otherwise(F.lit(labels[1]))
    return shares.select(outcome.alias("outcome"), "count", "share")
