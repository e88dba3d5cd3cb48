"""Train/test split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotterline.functions import percent_bucket


def split_by_hash(
    df: DataFrame, key: str = "ID", train_pct: int = 80
) -> tuple[DataFrame, DataFrame]:
    """Train and test part by a hash of ``key``.

    A row's part depends on its key alone: not on partitioning, row order, other rows or
    the engine. A recomputed partition therefore never moves rows between the parts.
    """
    bucket = percent_bucket(F.col(key))
    return df.filter(bucket < train_pct), df.filter(bucket >= train_pct)


def split_random(
    df: DataFrame, weights: list[float] | None = None, seed: int = 42
) -> list[DataFrame]:
    """Spark's random split. The parts change with the partitioning of ``df``."""
    return df.randomSplit(weights or [0.8, 0.2], seed=seed)
