"""Counts of the dashboard kept up to date without scanning gold again.

Each committed batch of gold has its own partial counts, stored as one partition beside it. All
counts of the report add up, so a report is the sum of the partials, cut to the top ones at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotterline.functions import day_number, event_time, hour_of_day, weekend_text
from blotterline.session import materialize
from blotterline.sinks.partitions import newest_batches, stored, up_to

COUNT_SCHEMA = T.StructType(
    [
        T.StructField("section", T.StringType()),
        T.StructField("item", T.StringType()),
        T.StructField("count", T.LongType()),
    ]
)
#: Sections of which the report shows the most frequent items only.
TOP_SECTIONS = ("type", "location")


def partial_counts(gold: DataFrame) -> DataFrame:
    """section, item, count of all items of every section of the report, in one pass over gold.

    Items are counted in each task before they are shuffled: a row per item and task.
    """
    ts = event_time(F.col("Date"))
    read = gold.select(
        F.inline(F.array(F.struct(ts.alias("ts")))), "Arrest", "Primary_Type", "Location_Description"
    )

    def entry(section: str, item: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), item.cast("string").alias("item"))

    entries = F.array(
        entry("rows", F.lit("all")),
        entry("hour", hour_of_day(F.col("ts"))),
        entry("arrest", F.col("Arrest")),
        entry("type", F.col("Primary_Type")),
        entry("period", weekend_text(day_number(F.col("ts")), "weekend", "weekday")),
        entry("location", F.col("Location_Description")),
    )
    items = read.select(F.inline(entries))
    counts = items.groupBy("section", "item").agg(F.count("item").alias("count"))
    return counts.filter(F.col("count") > 0)


def merge_counts(partials: DataFrame) -> DataFrame:
    return partials.groupBy("section", "item").agg(F.sum("count").alias("count"))


def report_of_counts(counts: DataFrame, k: int = 10) -> DataFrame:
    """The dashboard report from counts: as ``dashboard_report`` of the rows they count."""
    total = merge_counts(counts)
    whole = total.filter(~F.col("section").isin(*TOP_SECTIONS))
    parts = [
        total.filter(F.col("section") == name).orderBy(F.desc("count"), "item").limit(k) for name in TOP_SECTIONS
    ]
    report = whole
    for part in parts:
        report = report.unionByName(part)
    # A report without rows says so, as the full one does.
    empty = counts.sparkSession.range(1).select(
        F.lit("rows").alias("section"), F.lit("all").alias("item"), F.lit(0).cast("long").alias("count")
    )
    shown = report.unionByName(empty)
    return shown.groupBy("section", "item").agg(F.sum("count").alias("count"))


class CountsView:
    """The report of a counts layer, refreshed from new batches only.

    Batches that cannot be written again (all but the newest of each writer) are merged once into a
    stored sum; a refresh reads the partitions of batches that came since, and the newest ones, which a
    restarted stream may replace.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.merged = spark.createDataFrame([], COUNT_SCHEMA)
        #: Writer -> its newest batch in ``merged``.
        self.upto: dict[str, int] = {}

    def unread(self) -> DataFrame | None:
        """Partials of the batches that are not merged yet; None if there is no layer."""
        layer = stored(self.spark, self.path, COUNT_SCHEMA)
        return None if layer is None else layer.where(~up_to(self.upto, inclusive=True))

    def refresh(self, k: int = 10) -> DataFrame:
        """The report as of now."""
        unread = self.unread()
        if unread is None:
            return report_of_counts(self.merged, k)
        newest = newest_batches(unread)
        finished = unread.where(up_to(newest, inclusive=False))
        last = finished.groupBy("writer").agg(F.max("batch").alias("batch")).collect()
        if last:
            both = self.merged.unionByName(finished.select(*COUNT_SCHEMA.names))
            self.merged = materialize(merge_counts(both), "counts")
            self.upto |= {row["writer"]: row["batch"] for row in last}
        live = unread.where(~up_to(newest, inclusive=False)).select(*COUNT_SCHEMA.names)
        return report_of_counts(self.merged.unionByName(live), k)
