"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED_CONF = {
    # Hour and DayOfWeek are the written wall-clock values only in a zone
    # without daylight-saving gaps.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# The subfolder of the running ``own_work`` block.
_OWN_WORK = "blotterline.work.own"


def build_session(app_name: str, **conf: str) -> SparkSession:
    """A session with the recommended settings; ``conf`` adds to or overrides them.

    The master is left to ``spark-submit``.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="blotterline-"))
        root = context.getCheckpointDir()
    own = spark.conf.get(_OWN_WORK, None)
    folder = f"{root.rstrip('/')}/blotterline" + (f"/{own}" if own else "")
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder or file with the file system's own client, if it is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def own_work(spark: SparkSession) -> Iterator[None]:
    """Keep the intermediates of a block together and delete them when it ends.

    For jobs whose results are written elsewhere by then: a frame that still reads its
    intermediates cannot be used after the block.
    """
    spark.conf.set(_OWN_WORK, uuid.uuid4().hex)
    folder = work_folder(spark, "x").rpartition("/")[0]
    try:
        yield
    finally:
        spark.conf.unset(_OWN_WORK)
        delete(spark, folder)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back.

    Cuts the lineage: later passes read the (compact, columnar) copy, also after the loss
    of executors.
    """
    path = work_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def conf_defaults(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Set the given confs for the block, but only those the session has not set itself."""
    missing = [key for key in values if spark.conf.get(key, None) is None]
    for key in missing:
        spark.conf.set(key, values[key])
    try:
        yield
    finally:
        for key in missing:
            spark.conf.unset(key)
