from __future__ import annotations

import pytest

import blotterline as bl
from tests.conftest import incident
from tests.test_streaming import Job

EARLY, LATE = "01/05/2023 01:00:00 PM", "03/05/2023 01:00:00 PM"


def late_ids(job: Job) -> list[str]:
    return sorted(r["ID"] for r in bl.late_records(job.spark, job.base).collect())


def dropped(query) -> int:
    return sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)


def test_late_records_are_rows_over_restarts(spark, tmp_path):
    job = Job(spark, tmp_path)
    job.land(incident("1", Date=LATE))
    job.land(incident("2", Date=LATE))
    job.land(incident("3", Date=EARLY), incident("4", Date=EARLY), incident("4", Date=EARLY))
    job.land(incident("on time", Date=LATE), incident("undated", Date="bad"))
    _, refined = job.run(files_per_batch=1, delay="2 days")
    assert late_ids(job) == ["3", "4"] and dropped(refined) == 2
    job.land(incident("5", Date=EARLY, Arrest="true"))
    job.run(files_per_batch=1, delay="2 days")
    assert late_ids(job) == ["3", "4", "5"]
    assert bl.late_records(spark, job.base).schema == job.layer("silver").schema
    assert job.blocks().keys() == {"1", "2", "on time", "undated"} and job.agree()


def test_a_kill_between_batch_and_commit_loses_and_repeats_nothing(spark, tmp_path):
    job = Job(spark, tmp_path)
    job.land(incident("1", Date=LATE))
    job.run(delay="2 days")
    job.land(incident("2", Date=LATE), incident("3", Date=EARLY))
    job.run(delay="2 days")
    job.land(incident("4", Date=EARLY), incident("5", Date=LATE))
    job.run(delay="2 days")
    before = late_ids(job), job.blocks()
    assert before[0] == ["3", "4"]
    commits = job.checkpoint / "refined" / "commits"
    numbers = sorted(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    # Back to before the last batch with records, as if the driver had died after writing it.
    offsets = job.checkpoint / "refined" / "offsets"
    for number in numbers[-2:]:
        (commits / str(number)).unlink()
        (commits / f".{number}.crc").unlink(missing_ok=True)
    for number in numbers[-1:]:
        (offsets / str(number)).unlink()
        (offsets / f".{number}.crc").unlink(missing_ok=True)
    job.run(delay="2 days")
    assert (late_ids(job), job.blocks()) == before


@pytest.mark.parametrize("seconds", [0, 1])
def test_the_edge_of_the_watermark(spark, tmp_path, seconds):
    """A record exactly at the watermark is dropped, one a second later is not."""
    job = Job(spark, tmp_path)
    job.land(incident("old", Date="01/05/1960 01:00:00 PM"), incident("1", Date="03/05/2023 01:00:00 PM"))
    job.run(delay="1 hours")
    job.land(incident("2", Date="03/05/2023 01:00:00 PM"))
    job.run(delay="1 hours")
    job.land(incident("edge", Date=f"03/05/2023 12:00:0{seconds} PM"))
    _, refined = job.run(delay="1 hours")
    # The first batch has a watermark, too: the beginning of 1970.
    assert late_ids(job) == (["old"] if seconds else ["edge", "old"])
    assert dropped(refined) == 1 - seconds
    assert ("edge" in job.blocks()) == bool(seconds)
