from __future__ import annotations

from datetime import date, timedelta

import blotterline as bl
from blotterline.session import conf_defaults
from tests.conftest import incident
from tests.test_streaming import Job


def scanned(df) -> int:
    """Rows that a collected frame's scan gave to the operators above it."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def land_days(job: Job, turn: int, days: int, a_day: int) -> None:
    first = date(2023, 1, 1)
    rows = []
    for day in range(days):
        written = (first + timedelta(day)).strftime("%m/%d/%Y")
        rows += [incident(f"{turn}-{day}-{i}", Date=f"{written} 01:30:00 PM") for i in range(a_day)]
    job.land(*rows, incident(f"{turn}-x", Date="bad"), incident(f"{turn}-y", Date=""))


def ids(df) -> list[str]:
    return sorted(r["ID"] for r in df.select("ID").collect())


def test_a_period_of_compacted_gold_skips_other_days(spark, tmp_path):
    job = Job(spark, tmp_path)
    for turn in range(4):
        land_days(job, turn, 40, 25)
        job.run()
    path, total = f"{job.base}/gold", 4 * (40 * 25 + 2)
    assert job.layer("gold").columns == bl.schema.GOLD_SCHEMA.names
    day = date(2023, 1, 17)
    one = bl.read_period(spark, path, day, day)
    before = ids(one)
    assert before == sorted(f"{turn}-16-{i}" for turn in range(4) for i in range(25))
    assert scanned(one) > total / 2
    assert bl.compact_layer(spark, path, file_rows=100) == 3
    one = bl.read_period(spark, path, day, day)
    assert ids(one) == before
    # The newest batch is not rewritten; the others give little more than the day.
    assert scanned(one) <= total / 4 + total / 3
    assert job.layer("gold").count() == total and job.agree()
    some = bl.read_period(spark, path, date(2023, 1, 30), date(2023, 2, 2))
    assert some.count() == 4 * 4 * 25
    assert bl.hourly_counts(some).collect()[0]["count"] == 400
    assert bl.read_period(spark, path, date(2022, 1, 1), date(2022, 12, 31)).isEmpty()


def test_backfilled_gold_is_cut_by_day(spark, tmp_path):
    job = Job(spark, tmp_path)
    land_days(job, 0, 60, 50)
    with conf_defaults(spark, {"spark.sql.files.maxRecordsPerFile": "200"}):
        bl.backfill(bl.read_messages(spark, str(job.landing)), job.base)
    day = date(2023, 2, 3)
    one = bl.read_period(spark, f"{job.base}/gold", day, day)
    assert one.count() == 50 and scanned(one) < 3002 / 2


def test_layers_without_days_and_absent_ones(spark, tmp_path, records):
    gold = bl.to_gold(bl.clean_records(records(incident("1"), incident("2", Date="bad"), incident("3", Date="01/06/2023 01:00:00 AM"))))
    gold.write.parquet(f"{tmp_path}/plain/writer=x/batch=0")
    day = date(2023, 1, 5)
    assert ids(bl.read_period(spark, f"{tmp_path}/plain", day, day)) == ["1"]
    assert bl.read_period(spark, f"{tmp_path}/nothing", day, day).isEmpty()
