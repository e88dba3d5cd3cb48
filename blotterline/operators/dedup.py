"""Removal of repeated records."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANK = "__copy_rank"
_FIRST = "__first_copy"


def dedup_first(df: DataFrame, keys: list[str], order_by: list[str | Column]) -> DataFrame:
    """One row per key: the first by ``order_by``.

    Batch only. The survivor is repeatable when ``order_by`` decides between any two
    different copies. Spark keeps one row per key and task before it shuffles
    (``WindowGroupLimit``), so a key with very many copies costs no more than any other.
    """
    first = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn(_RANK, F.row_number().over(first)).filter(F.col(_RANK) == 1).drop(_RANK)


def collapse_copies(df: DataFrame, key: str) -> DataFrame:
    """Drop repeats of a key inside each Arrow batch, keeping the earlier row.

    The map-side half of a streaming deduplication, which Spark does not have: without it
    all copies of a hot key travel to the one state partition that owns the key. Only the
    key column visits Python, and nothing is held beyond one batch
    (``spark.sql.execution.arrow.maxRecordsPerBatch`` rows).
    """

    # Defined here so that it travels by value: tasks need not import this package.
    @F.arrow_udf(T.BooleanType())
    def first_in_batch(keys: pa.Array) -> pa.Array:
        codes = keys.dictionary_encode(null_encoding="encode").indices.to_numpy()
        _, first = np.unique(codes, return_index=True)
        marks = np.zeros(len(codes), dtype=bool)
        marks[first] = True
        return pa.array(marks)

    # Its own projection, marked nondeterministic: filters of the input stay below it.
    first = first_in_batch.asNondeterministic()(F.col(key))
    return df.withColumn(_FIRST, first).filter(_FIRST).drop(_FIRST)
