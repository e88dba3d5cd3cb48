from __future__ import annotations

import datetime as dt

import blotterline as bl
from tests.conftest import incident
from tests.test_streaming import Job


def state(job: Job, batch: int | None = None) -> dict:
    rows = bl.dedup_state(job.spark, str(job.checkpoint), batch).collect()
    assert len({r["ID"] for r in rows}) == len(rows)
    return {r["ID"]: r["expires"] for r in rows}


def test_the_state_holds_the_ids_of_silver(spark, tmp_path):
    job = Job(spark, tmp_path)
    job.land(incident("1"), incident("1"), incident(""), incident("x", Date="bad"), "no json")
    job.run()
    job.land(incident("1"), incident("2"))
    job.run()
    assert state(job) == dict.fromkeys(["1", "", "x", "2"])
    assert set(state(job)) == set(job.blocks())
    assert set(state(job, 0)) == {"1", "", "x"}
    found = bl.state_operators(spark, str(job.checkpoint)).collect()
    assert [(r["operator"], r["partitions"], r["first_batch"]) for r in found] == [("dedupe", 4, 0)]


def test_bounded_state_shows_when_ids_are_forgotten(spark, tmp_path):
    job = Job(spark, tmp_path)
    early, late = "01/05/2023 01:00:00 PM", "03/05/2023 01:00:00 PM"
    job.land(incident("1", Date=early), incident("undated", Date="bad"))
    job.run(delay="2 days")
    # 1 expires two days after its date. An ID without a readable date has no time to wait
    # for: it is gone once the watermark has moved at all, here with the batch's own records.
    day = dt.datetime(2023, 1, 7, 13, tzinfo=dt.UTC)
    assert {i: t.astimezone(dt.UTC) for i, t in state(job).items()} == {"1": day}
    assert set(state(job, 0)) == {"1", "undated"}
    job.land(incident("2", Date=late), incident("undated", Date="bad"))
    job.run(delay="2 days")
    assert set(state(job)) == {"2"}
    # A copy of it in a later batch is therefore a new record.
    assert sorted(r["ID"] for r in job.layer("silver").collect()) == ["1", "2", "undated", "undated"]
