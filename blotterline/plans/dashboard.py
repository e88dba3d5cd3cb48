"""All exploratory counts of a dashboard refresh in one action."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotterline.functions import day_number, event_time, hour_of_day, weekend_text
from blotterline.operators.frequency import frequencies, top_k


def dashboard_report(gold: DataFrame, k: int = 10) -> DataFrame:
    """Long form ``section, item, count`` of all exploratory tables.

    Sections: ``rows``, ``hour``, ``arrest``, ``type``, ``period``, ``location``. Row
    count, hours and periods derive from one aggregate of at most 50 groups, whose
    shuffle Spark reuses: each date is parsed once.
    """
    ts = event_time(F.col("Date"))
    calendar = (
        gold.select(
            hour_of_day(ts).alias("Hour"),
            weekend_text(day_number(ts), "weekend", "weekday").alias("period"),
        )
        .groupBy("Hour", "period")
        .count()
    )

    def section(name: str, item: str, counts: DataFrame) -> DataFrame:
        return counts.select(
            F.lit(name).alias("section"),
            F.col(item).cast("string").alias("item"),
            "count",
        )

    total = F.coalesce(F.sum("count"), F.lit(0)).alias("count")
    all_rows = calendar.agg(total).withColumn("item", F.lit("all"))
    # A filter on the hour would be pushed below the shared aggregate and split it in two.
    dated = F.sum(F.when(F.col("Hour").isNotNull(), F.col("count"))).alias("count")
    hours = calendar.groupBy("Hour").agg(dated).filter(F.col("count").isNotNull())
    periods = calendar.groupBy("period").agg(total)
    parts = [
        section("rows", "item", all_rows),
        section("hour", "Hour", hours),
        section("arrest", "Arrest", frequencies(gold, "Arrest")),
        section("type", "Primary_Type", top_k(gold, "Primary_Type", k)),
        section("period", "period", periods),
        section("location", "Location_Description", top_k(gold, "Location_Description", k)),
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report
