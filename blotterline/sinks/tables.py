"""Writers of tables and models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from blotterline.sinks.partitions import write_batch


def delta_options(writer: str, number: int) -> dict[str, str]:
    """Options that make a Delta append of a numbered batch happen once."""
    return {"txnAppId": writer, "txnVersion": str(number)}


def replace_batch(df: DataFrame, path: str, fmt: str, writer: str, number: int) -> DataFrame:
    """Write ``df`` as the content of a writer's numbered batch and give back what was written.

    Writing a batch again leaves it there once, which makes an at-least-once caller exact: as
    Parquet, the batch's partition is overwritten; as Delta, the append is skipped. The
    Delta form needs the Delta package and is not tested where that is not available.
    """
    if fmt == "delta":
        df.write.format(fmt).mode("append").options(**delta_options(writer, number)).save(path)
        return df
    if fmt != "parquet":
        raise ValueError(f"layers are parquet or delta, not {fmt}")
    return write_batch(df, path, writer, number)


def append_runs(runs: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Add run rows to the run table."""
    runs.write.format(fmt).mode("append").save(path)


def save_model(model: PipelineModel, path: str) -> None:
    """Save a fitted pipeline, replacing an older copy."""
    model.write().overwrite().save(path)
