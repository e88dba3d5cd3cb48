from __future__ import annotations

import blotterline as bl
from tests.conftest import incident, plan_of
from tests.test_streaming import Job


def rows(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.select("section", "item", "count").collect())


def land(job: Job, start: int, count: int) -> None:
    kinds = ["THEFT", "FRAUD", "  ", "ARSON", "THEFT"]
    job.land(
        *[
            incident(
                str(i),
                Date="bad" if i % 7 == 0 else f"01/{i % 28 + 1:02}/2023 {i % 12 + 1:02}:00:00 PM",
                Primary_Type=kinds[i % 5],
                Location_Description=None if i % 11 == 0 else f"PLACE {i % 23}",
                Arrest="true" if i % 3 else "no",
            )
            for i in range(start, start + count)
        ]
    )


def test_partials_give_the_report_of_the_rows(records):
    places = [incident(str(i), Location_Description=f"P{i % 13}", Date="x" if i % 5 else "01/07/2023 01:00:00 AM") for i in range(60)]
    gold = bl.to_gold(bl.clean_records(records(*places)))
    assert rows(bl.report_of_counts(bl.partial_counts(gold))) == rows(bl.dashboard_report(gold))
    both = bl.partial_counts(gold).unionByName(bl.partial_counts(gold.limit(0)))
    assert rows(bl.report_of_counts(both, 3)) == rows(bl.dashboard_report(gold, 3))
    nothing = gold.limit(0)
    assert rows(bl.report_of_counts(bl.partial_counts(nothing))) == rows(bl.dashboard_report(nothing))
    assert plan_of(bl.partial_counts(gold)).count("try_to_timestamp") + plan_of(bl.partial_counts(gold)).count("gettimestamp") <= 2


def test_refreshes_read_new_batches_only(spark, tmp_path):
    job = Job(spark, tmp_path)
    view = bl.CountsView(spark, f"{job.base}/counts")
    assert rows(view.refresh()) == [("rows", "all", 0)]
    for turn in range(4):
        land(job, 40 * turn, 60)
        job.run(counts=True)
        assert rows(view.refresh()) == rows(bl.dashboard_report(job.layer("gold")))
    assert len(view.upto) == 1
    merged = next(iter(view.upto.values()))
    unread = view.unread()
    assert {r["batch"] for r in unread.select("batch").distinct().collect()} == {merged + 1}
    # Merged batches are pruned as partitions: their files are no part of the scan.
    plan = plan_of(unread)
    assert "PartitionFilters: [" in plan and "batch" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_replayed_batch_and_another_checkpoint(spark, tmp_path):
    job = Job(spark, tmp_path)
    view = bl.CountsView(spark, f"{job.base}/counts")
    for turn in range(3):
        land(job, 50 * turn, 60)
        job.run(counts=True)
    before = rows(view.refresh())
    commits = job.checkpoint / "refined" / "commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    (commits / str(last)).unlink()
    (commits / f".{last}.crc").unlink(missing_ok=True)
    job.run(counts=True)
    assert rows(view.refresh()) == before == rows(bl.dashboard_report(job.layer("gold")))
    job.run(checkpoint=tmp_path / "other", counts=True)
    again = rows(view.refresh())
    assert again == rows(bl.dashboard_report(job.layer("gold"))) and again != before
    assert rows(bl.CountsView(spark, f"{job.base}/counts").refresh()) == again
