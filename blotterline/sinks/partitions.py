"""Layers as Parquet partitioned by writer and batch, by Spark's own writers.

A writer is a streaming query or a backfill, its batches are numbered. Writing a batch overwrites
its partition and no other (dynamic partition overwrite): Spark writes the files aside and moves
them into place when the job commits, so a replayed batch replaces itself and attempts that fail
leave nothing that readers see.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotterline.schema import EVENT_DAY
from blotterline.session import materialize

WRITER, BATCH = "writer", "batch"
_PARTS = "__parts"
#: The writer name of batch backfills.
BACKFILL = "backfill"

#: About as many rows of a batch are sorted and written by one task when it is compacted.
TASK_ROWS = 1 << 19

#: Error conditions that mean "nothing stored there yet".
MISSING = {
    "PATH_NOT_FOUND",
    "UNABLE_TO_INFER_SCHEMA",
    "DELTA_MISSING_DELTA_TABLE",
    "DELTA_PATH_DOES_NOT_EXIST",
    "DELTA_TABLE_NOT_FOUND",
    "DELTA_SCHEMA_NOT_SET",
}


def write_batch(df: DataFrame, path: str, writer: str, number: int) -> DataFrame:
    """Write ``df`` as the one content of a writer's batch and give back what was written.

    A batch without rows has no partition, so it replaces nothing: a streaming batch that is written
    again has rows if it had some. A backfill may be run again with less and overwrites its folder.
    """
    spark, folder = df.sparkSession, f"{path}/{WRITER}={writer}/{BATCH}={number}"
    taken = {name.lower() for name in df.columns} & {WRITER, BATCH}
    if taken:
        raise ValueError(f"a layer has no columns of its own named {sorted(taken)}")
    if writer == BACKFILL:
        df.write.mode("overwrite").parquet(folder)
    else:
        _overwrite(df.withColumns({WRITER: F.lit(writer), BATCH: F.lit(number)}), path)
    try:
        return spark.read.schema(df.schema).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() not in MISSING:
            raise
        return spark.createDataFrame([], df.schema)


def _overwrite(tagged: DataFrame, path: str, file_rows: int | None = None) -> None:
    writer = tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if file_rows is not None:
        writer = writer.option("maxRecordsPerFile", file_rows)
    writer.partitionBy(WRITER, BATCH).parquet(path)


def stored(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """All rows of a layer with their writer and batch, as far as it has these; None if it is absent.

    ``schema`` names the layer's own columns; files that lack some of them give nulls there.
    """
    reader = spark.read
    if schema is not None:
        kinds = [T.StructField(WRITER, T.StringType()), T.StructField(BATCH, T.LongType())]
        reader = reader.schema(T.StructType([*schema.fields, *kinds]))
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in MISSING:
            raise
        return None


def is_partitioned(layer: DataFrame) -> bool:
    return {WRITER, BATCH} <= set(layer.columns)


def without_partitions(layer: DataFrame) -> DataFrame:
    """The layer's own columns, without those that only help writing and reading it."""
    return layer.drop(WRITER, BATCH, EVENT_DAY) if is_partitioned(layer) else layer


def strangers(spark: SparkSession, path: str, own: Column) -> str | None:
    """What a layer holds besides batches of writers that meet ``own``; None if there is nothing."""
    try:
        layer = stored(spark, path)
    except Exception as error:  # folders of different forms beside each other
        return f"files of another form ({type(error).__name__})"
    if layer is None:
        return None
    if not is_partitioned(layer):
        return "files"
    found = layer.where(~own).select(WRITER).head()
    return f"batches of {found[0]}" if found else None


def newest_batches(layer: DataFrame) -> dict[str, int]:
    """Writer -> number of its newest batch; a writer is a checkpoint, so there are few."""
    rows = layer.select(WRITER, BATCH).groupBy(WRITER).agg(F.max(BATCH).alias(BATCH)).collect()
    return {row[WRITER]: row[BATCH] for row in rows}


def up_to(batches: dict[str, int], inclusive: bool) -> Column:
    """Rows of each writer's batches below a number, as a filter on partitions."""
    number = F.col(BATCH)
    tests = [
        (F.col(WRITER) == writer) & (number <= last if inclusive else number < last)
        for writer, last in sorted(batches.items())
    ]
    return reduce(or_, tests, F.lit(False))


def compact_layer(
    spark: SparkSession, path: str, order: list[str] | None = None, file_rows: int | None = None
) -> int:
    """Rewrite finished batches into few files each; gives how many were rewritten.

    One Spark job reads all but the newest batch of each writer (only that one can be written
    again), a second one overwrites their partitions from that copy; should it be stopped, the next
    call finds the partitions as they were or rewritten. Files are cut by ``order`` within a batch
    (gold: by the day of the event), so that their minima and maxima tell readers of a range which
    to skip. A batch of more than ``TASK_ROWS`` rows is dealt over several tasks, which write a file
    each. ``file_rows`` bounds the rows of a file. A read under way may miss files that were replaced.
    """
    layer = stored(spark, path)
    if layer is None or not is_partitioned(layer):
        return 0
    finished = layer.where(up_to(newest_batches(layer), inclusive=False))
    count = finished.select(WRITER, BATCH).distinct().count()
    if not count:
        return 0
    if order is None:
        order = [EVENT_DAY] if EVENT_DAY in layer.columns else []
    keys = [WRITER, BATCH, *order]
    copy = materialize(finished, "compacted")
    # Batches of up to TASK_ROWS rows have one part, so nothing but their keys decides where they go. Others
    # have many more than tasks, for ranges of even size.
    count_parts = F.ceil(F.count(F.lit(1)) / TASK_ROWS)
    sizes = copy.groupBy(WRITER, BATCH).agg(F.when(count_parts == 1, 1).otherwise(16 * count_parts).alias(_PARTS))
    part = F.monotonically_increasing_id() % F.col(_PARTS)
    dealt = copy.join(F.broadcast(sizes), [WRITER, BATCH]).withColumn(_PARTS, part)
    tasks = -(-copy.count() // TASK_ROWS)
    if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):
        dealt = dealt.repartitionByRange(tasks, *keys, _PARTS)
    else:
        dealt = dealt.repartitionByRange(*keys, _PARTS)
    rows = dealt.sortWithinPartitions(*keys).select(*copy.columns)
    _overwrite(rows, path, file_rows)
    return count
