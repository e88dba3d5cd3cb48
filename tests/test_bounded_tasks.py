"""What one task holds does not grow with the input."""

from __future__ import annotations

import pyarrow.parquet as pq
from pyspark.sql import functions as F

import blotterline as bl
from blotterline.operators.encoding import fit_prep
from blotterline.plans import training
from blotterline.schema import FEATURE_INPUTS
from blotterline.sinks import partitions
from verification import feed, queries


def test_a_large_batch_is_compacted_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(partitions, "TASK_ROWS", 100)
    path = f"{tmp_path}/layer"
    # Batch 0 has 1,200 rows, batch 1 has 60, batch 2 is the newest.
    batch = F.when(F.col("id") < 1_200, 0).when(F.col("id") < 1_260, 1).otherwise(2)
    rows = spark.range(0, 1_300, 1, 6).select("id", F.lit("same").alias("text"), F.lit("w").alias("writer"), batch.alias("batch"))
    rows.write.partitionBy("writer", "batch").parquet(path)
    newest = sorted(p.name for p in tmp_path.glob("layer/writer=w/batch=2/*.parquet"))
    assert bl.compact_layer(spark, path) == 2

    def sizes(number: int) -> list[int]:
        return [pq.read_metadata(p).num_rows for p in tmp_path.glob(f"layer/writer=w/batch={number}/*.parquet")]

    assert sum(sizes(0)) == 1_200 and max(sizes(0)) <= 400 and len(sizes(0)) <= 13
    assert sizes(1) == [60]
    assert sorted(p.name for p in tmp_path.glob("layer/writer=w/batch=2/*.parquet")) == newest
    layer = spark.read.parquet(path)
    assert layer.columns == ["id", "text", "writer", "batch"]
    assert sorted(r["id"] for r in layer.collect()) == list(range(1_300))


def test_fits_read_bounded_partitions(spark, monkeypatch):
    rows = spark.range(0, 2_000, 1, 1).select(
        F.concat(F.lit("t"), F.col("id") % 5).alias("Primary_Type"),
        F.concat(F.lit("l"), F.col("id") % 7).alias("Location_Description"),
        *[(F.col("id") % 24).cast("double").alias(n) for n in FEATURE_INPUTS if not n.endswith("_Vec")],
        (F.col("id") % 2).cast("int").alias("label"),
    )
    prep = fit_prep(rows)

    def sizes() -> tuple[list[int], list[str]]:
        vectors = training._prepared(prep, rows)
        counts = vectors.groupBy(F.spark_partition_id()).count().collect()
        content = sorted(str(r) for r in vectors.collect())
        vectors.unpersist()
        return [r["count"] for r in counts], content

    few, whole = sizes()
    assert few == [2_000]
    width = len(prep.transform(rows).head()["features"])
    monkeypatch.setattr(training, "TASK_CELLS", 100 * width)
    many, dealt = sizes()
    assert len(many) == 20 and max(many) <= 150 and dealt == whole
    empty = training._prepared(prep, rows.limit(0))
    assert empty.count() == 0
    empty.unpersist()


def test_a_large_table_lands_as_more_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(feed, "FILE_EVENTS", 100, raising=False)
    rows = spark.range(0, 1_000, 1, 1).select(
        F.col("id").alias("event_id"),
        F.lit("2024-01-08 10:00:00").cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 9).alias("user_id"),
        F.lit("click").alias("event_type"),
        F.col("id").cast("double").alias("value"),
        F.lit("{}").alias("props"),
    )
    rows.write.parquet(f"{tmp_path}/events.parquet")
    histories = queries._history_arrivals(spark, str(tmp_path))
    assert [h.rdd.getNumPartitions() for h in histories] == [7, 7, 10]
    own = feed.arrivals(spark, str(tmp_path), F.lit(True), "file 2")
    assert sorted(histories[2].collect()) == sorted(own.collect())
    monkeypatch.setattr(feed, "FILE_EVENTS", 10_000)
    assert [h.rdd.getNumPartitions() for h in queries._history_arrivals(spark, str(tmp_path))] == [4, 4, 4]
