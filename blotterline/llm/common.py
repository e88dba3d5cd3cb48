"""What the operators of this folder share: tables, stored steps, row numbers."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from blotterline.session import materialize, work_folder

__all__ = [
    "blocks_for",
    "bound_batches",
    "by_global_order",
    "crc32_of",
    "map_frames",
    "materialize",
    "numbered_rows",
    "parallelism",
    "read_table",
    "small_frames",
    "stored_texts",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored_texts(df: DataFrame, label: str) -> DataFrame:
    """As ``materialize`` for frames that hold texts: compressed more, for less disk."""
    path = work_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """Let an Arrow batch hold 16 MB (or one row), unless the session has its own bound.

    Spark's default is 64 MB; a worker holds several copies of a batch while it works on it.
    """
    key, default = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
    if spark.conf.get(key) == default:
        spark.conf.set(key, "16m")


def parallelism(spark: SparkSession) -> int:
    """Number of tasks that a shuffle of this session has."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc32_of(value: Column) -> Column:
    """Unsigned CRC-32 of the value's text in UTF-8; null as the empty text."""
    return F.crc32(F.coalesce(value.cast("string"), F.lit("")).cast("binary"))


def by_global_order(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ranges of ``keys`` and sorted in each of them: partitions follow each other.

    Spark samples the keys to find ranges of even size. The last key only separates rows
    that are equal in all of ``keys``, so that a hot value is dealt over several ranges.
    """
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    columns = [F.col(key).asc_nulls_first() for key in [*keys, "_tie"]]
    return tied.repartitionByRange(*columns).sortWithinPartitions(*columns).drop("_tie")


def numbered_rows(df: DataFrame, *keys: str, column: str = "row_number") -> tuple[DataFrame, int]:
    """``df`` with global row numbers from 0 in the order of ``keys``, and the number of rows.

    One range shuffle. The sorted rows are stored before they are counted: the ranges are
    sampled, so a second evaluation could cut them elsewhere. Only one row per range goes
    through the window and the broadcast, whatever the input holds.
    """
    below = (1 << 33) - 1  # monotonically_increasing_id: partition above 33 bits, row below
    place = F.monotonically_increasing_id()
    stored = materialize(by_global_order(df, *keys).withColumn("_place", place), "numbered")
    ranges = stored.groupBy(F.shiftright("_place", 33).alias("_range")).agg(
        (F.max(F.col("_place").bitwiseAND(below)) + 1).alias("_rows")
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(
        ranges.select(
            "_range", "_rows", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
        ),
        "range-starts",
    )
    total = starts.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    at = F.col("_start") + F.col("_place").bitwiseAND(below)
    rows = (
        stored.withColumn("_range", F.shiftright("_place", 33))
        .join(F.broadcast(starts.drop("_rows")), "_range")
        .withColumn(column, at)
        .drop("_range", "_place", "_start")
    )
    return rows, total


def blocks_for(rows: int, largest: int, at_least: int) -> int:
    """How many blocks hold ``rows`` with no more than about ``largest`` in each."""
    return max(1, math.ceil(rows / largest), min(at_least, math.ceil(rows / 256)))


def small_frames(
    frames: Iterator[pd.DataFrame], text: str, most_chars: int = 4_000_000
) -> Iterator[pd.DataFrame]:
    """The frames, cut so that none holds more than about ``most_chars`` characters of ``text``.

    A single longer text is a frame of its own. Nothing is dropped.
    """
    for frame in frames:
        piece = frame[text].fillna("").str.len().cumsum() // most_chars
        for _, part in frame.groupby(piece, sort=True):
            yield part.reset_index(drop=True)


def _exact(kind: pa.DataType) -> pd.ArrowDtype | None:
    """Texts become plain pandas columns, all others stay Arrow arrays."""
    return None if pa.types.is_string(kind) or pa.types.is_large_string(kind) else pd.ArrowDtype(kind)


def map_frames(
    df: DataFrame,
    function: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
    schema: StructType | str,
) -> DataFrame:
    """As ``mapInPandas``, but whole numbers and nested values pass through as they are.

    Plain pandas turns a whole number beside a null into a double, which is exact up to 2^53
    only; here all columns but texts are Arrow arrays inside the frame.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    wanted = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = wanted

        def frames() -> Iterator[pd.DataFrame]:
            nonlocal target
            for batch in batches:
                own = {field.name: field.type for field in batch.schema}
                # Values that are only passed on keep the type they came with (time zones).
                target = pa.schema([
                    pa.field(f.name, own[f.name])
                    if f.name in own and pa.types.is_temporal(f.type) and pa.types.is_temporal(own[f.name])
                    else f
                    for f in wanted
                ])
                yield batch.to_pandas(types_mapper=_exact)

        for frame in function(frames()):
            table = pa.Table.from_pandas(frame, schema=target, preserve_index=False)
            yield from table.combine_chunks().to_batches()

    return df.mapInArrow(run, schema)
