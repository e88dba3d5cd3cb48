from __future__ import annotations

from pathlib import Path

import blotterline as bl
from blotterline.session import own_work, work_folder


def test_own_work_is_deleted_at_the_end_and_nothing_else(spark):
    other = work_folder(spark, "other")
    spark.range(3).write.parquet(other)
    with own_work(spark):
        inside = work_folder(spark, "inside")
        spark.range(3).write.parquet(inside)
        assert bl.materialize(spark.range(5), "more").count() == 5
        assert Path(inside).exists()
    assert not Path(inside).parent.exists()
    assert spark.read.parquet(other).count() == 3
    assert Path(work_folder(spark, "x")).parent == Path(other).parent
