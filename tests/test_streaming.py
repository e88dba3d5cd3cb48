from __future__ import annotations

import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import blotterline as bl
from blotterline.session import conf_defaults
from blotterline.sinks.tables import delta_options
from blotterline.streaming.medallion import STATE_CONF
from tests.conftest import incident


class Job:
    """A landing folder and bounded runs of the streaming job over it."""

    def __init__(self, spark, folder: Path):
        self.spark = spark
        self.landing = folder / "landing"
        self.landing.mkdir()
        self.base = str(folder / "layers")
        self.checkpoint = folder / "checkpoints"
        self.files = 0

    def land(self, *messages: dict | str) -> None:
        lines = [m if isinstance(m, str) else json.dumps(m) for m in messages]
        # Hidden until complete, as a file source takes what it sees.
        self.files += 1
        part = self.landing / f".{self.files}"
        part.write_text("\n".join(lines) + "\n")
        # The file source goes by modification time; keep the order of landing.
        os.utime(part, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        part.rename(self.landing / f"{self.files:03}.txt")

    def run(self, checkpoint: Path | None = None, files_per_batch: int | None = None, **options):
        queries = bl.start_medallion(
            bl.file_source(self.spark, str(self.landing), files_per_batch),
            self.base,
            str(checkpoint or self.checkpoint),
            trigger={"availableNow": True},
            **options,
        )
        bl.drain(queries)
        return queries

    def layer(self, name: str):
        return bl.read_layer(self.spark, f"{self.base}/{name}")

    def blocks(self) -> dict[str, str]:
        rows = self.layer("silver").select("ID", "Block").collect()
        assert len({r["ID"] for r in rows}) == len(rows), "an ID is there twice"
        return {r["ID"]: r["Block"] for r in rows}

    def agree(self) -> bool:
        silver = bl.to_gold(self.layer("silver")).collect()
        return sorted(silver) == sorted(self.layer("gold").collect())


@pytest.fixture
def job(spark, tmp_path):
    return Job(spark, tmp_path)


def test_layers_of_one_run(job):
    job.land(incident("1"), "not json", incident("1"), '{"ID":"2"}', incident("3", Arrest="true"))
    bronze, refined = job.run()
    assert job.layer("bronze").count() == 5
    assert job.blocks().keys() == {"1", "3"}
    assert job.agree()
    assert {r["ID"]: r["Arrest"] for r in job.layer("gold").collect()} == {"1": False, "3": True}
    intake = [p.observedMetrics["intake"] for p in refined.recentProgress if p.numInputRows]
    assert [(i.records, i.incomplete) for i in intake] == [(5, 2)]


def test_the_first_arrival_wins_across_batches(job):
    job.land(incident("1", Block="first"))
    job.land(incident("1", Block="second"), incident("2", Block="a"))
    job.land(incident("2", Block="b"), incident("3", Block="c"))
    job.run(files_per_batch=1)
    assert job.blocks() == {"1": "first", "2": "a", "3": "c"}
    assert job.agree()


def test_restart_goes_on_and_remembers_ids(job):
    job.land(incident("1", Block="first"))
    job.run()
    job.land(incident("1", Block="again"), incident("2", Block="new"))
    job.run()
    job.run()
    assert job.blocks() == {"1": "first", "2": "new"}
    assert job.layer("bronze").count() == 3
    assert job.agree()


def test_a_replayed_batch_replaces_itself(job):
    job.land(*[incident(str(i), Block="a") for i in range(50)])
    job.run()
    job.land(*[incident(str(i), Block="b") for i in range(40, 90)])
    job.run()
    before = job.blocks()
    # As after a crash between the writes of the last batch and its commit.
    commits = job.checkpoint / "refined" / "commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    (commits / str(last)).unlink()
    (commits / f".{last}.crc").unlink(missing_ok=True)
    job.run()
    assert job.blocks() == before
    assert len(before) == 90
    assert job.agree()


def test_a_new_checkpoint_adds_instead_of_overwriting(job, tmp_path):
    job.land(incident("1"))
    job.run()
    job.land(incident("2"))
    job.run(checkpoint=tmp_path / "other")
    assert sorted(r["ID"] for r in job.layer("silver").collect()) == ["1", "1", "2"]


def test_a_run_without_records_leaves_readable_layers(job):
    job.land("nothing useful")
    job.run()
    assert bl.read_layer(
        job.spark, f"{job.base}/gold", on_missing="empty", schema=bl.schema.GOLD_SCHEMA
    ).isEmpty()
    with pytest.raises(bl.LayerNotReady):
        job.layer("gold")


def test_stream_equals_batch_with_a_hot_id(job):
    rows = [incident("hot" if i % 3 else str(i), Block="same") for i in range(6000)]
    rows += [incident("", Block="same")] * 3000
    for start in range(0, len(rows), 3000):
        job.land(*rows[start : start + 3000])
    job.run(files_per_batch=2)
    batch = bl.to_silver(bl.parse_payload(bl.read_messages(job.spark, str(job.landing))))
    assert sorted(job.layer("silver").collect()) == sorted(batch.collect())
    assert job.agree()


def test_bounded_state_forgets_old_ids(job):
    early, late = "01/05/2023 01:00:00 PM", "03/05/2023 01:00:00 PM"
    job.land(incident("1", Date=early), incident("1", Date=early), incident("x", Date="bad"))
    job.land(incident("2", Date=late), incident("1", Date=early))
    job.land(incident("3", Date=late), incident("2", Date=late))
    job.land(incident("4", Date=early))
    _, refined = job.run(files_per_batch=1, delay="2 days")
    # Record 4 is behind the watermark; the state holds the recent IDs only.
    assert sorted(r["ID"] for r in job.layer("silver").collect()) == ["1", "2", "3", "x"]
    assert refined.recentProgress[-1].stateOperators[0].numRowsTotal == 2


def test_console_shows_gold(job, capfd):
    job.land(incident("1", Location_Description="A VERY LONG PLACE NAME " * 3))
    job.run(console=True)
    shown = capfd.readouterr().out
    assert "Batch: 0" in shown
    assert "A VERY LONG PLACE NAME " * 3 in shown


def test_a_failing_query_is_reported(job):
    job.land(incident("1"))
    with pytest.raises(Exception, match="nosuchformat"):
        job.run(fmt="nosuchformat")


def test_state_settings_are_defaults_only(spark):
    key = next(iter(STATE_CONF))
    with conf_defaults(spark, STATE_CONF):
        assert spark.conf.get(key) == STATE_CONF[key]
    assert spark.conf.get(key, "unset") == "unset"
    spark.conf.set(key, "own")
    try:
        with conf_defaults(spark, STATE_CONF):
            assert spark.conf.get(key) == "own"
        assert spark.conf.get(key) == "own"
    finally:
        spark.conf.unset(key)


def test_files_that_look_old_are_read(job):
    job.land(incident("1"))
    job.run()
    job.land(incident("2"))
    os.utime(job.landing / "002.txt", (1_600_000_000, 1_600_000_000))
    job.run()
    assert job.blocks().keys() == {"1", "2"}


def test_late_records_are_counted(job):
    early, late = "01/05/2023 01:00:00 PM", "03/05/2023 01:00:00 PM"
    job.land(incident("1", Date=late))
    job.land(incident("2", Date=late))
    job.land(incident("3", Date=early), incident("4", Date=early), incident("5", Date="bad"))
    bronze, refined = job.run(files_per_batch=1, delay="2 days")
    assert job.blocks().keys() == {"1", "2", "5"}
    assert sorted(r["ID"] for r in bl.late_records(job.spark, job.base).collect()) == ["3", "4"]
    assert job.layer("bronze").count() == 5


def test_backfill_and_stream_do_not_share_a_base(job, tmp_path):
    job.land(incident("1"))
    messages = bl.read_messages(job.spark, str(job.landing))
    bl.backfill(messages, job.base)
    bl.backfill(messages, job.base)
    assert job.blocks().keys() == {"1"}
    with pytest.raises(RuntimeError, match="no stream wrote"):
        job.run()
    streamed = Job(job.spark, _made(tmp_path / "other"))
    streamed.land(incident("2"))
    streamed.run()
    with pytest.raises(RuntimeError, match="no backfill wrote"):
        bl.backfill(messages, streamed.base)
    assert streamed.blocks().keys() == {"2"}
    foreign = Job(job.spark, _made(tmp_path / "foreign"))
    foreign.land(incident("3"))
    job.layer("gold").write.parquet(f"{foreign.base}/gold")
    with pytest.raises(RuntimeError, match="no stream wrote"):
        foreign.run()


def _made(folder: Path) -> Path:
    folder.mkdir()
    return folder


def test_compaction_keeps_rows_and_lowers_the_number_of_files(job):
    for number in range(6):
        job.land(*[incident(str(10 * number + i), Block="a") for i in range(10)])
    job.run(files_per_batch=1)
    path = Path(job.base) / "silver"

    def files() -> int:
        return len(list(path.glob("writer=*/batch=*/*.parquet")))

    before, rows = files(), sorted(job.layer("silver").collect())
    assert bl.compact_layer(job.spark, str(path)) == 5
    assert bl.compact_layer(job.spark, f"{job.base}/nothing") == 0
    assert files() < before and sorted(job.layer("silver").collect()) == rows
    # The last batch is replayed, and a new one comes.
    commits = job.checkpoint / "refined" / "commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    (commits / str(last)).unlink()
    (commits / f".{last}.crc").unlink(missing_ok=True)
    job.land(incident("new", Block="a"), incident("3", Block="b"))
    job.run()
    assert len(job.blocks()) == 61 and job.agree()
    assert bl.compact_layer(job.spark, str(path)) >= 2
    assert len(job.blocks()) == 61


def test_an_attempt_without_commit_is_not_seen(job):
    job.land(incident("1"))
    job.run()
    ghost = job.layer("silver").withColumn("ID", F.lit("ghost"))
    ghost.write.parquet(f"{job.base}/silver/.spark-staging-x/writer=x/batch=0")
    assert job.blocks().keys() == {"1"}


def test_delta_appends_are_numbered():
    assert delta_options("query", 7) == {"txnAppId": "query", "txnVersion": "7"}
