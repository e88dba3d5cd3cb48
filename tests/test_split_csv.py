from __future__ import annotations

import csv
import random

import pytest

import blotterline as bl
from blotterline.schema import FIELD_TO_HEADER
from tests.conftest import plan_of

HEADERS = list(FIELD_TO_HEADER.values())


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0"}
    before = {key: spark.conf.get(key) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def value(draw: random.Random) -> str:
    kind = draw.randrange(8)
    if kind == 0:
        return "\n".join(draw.choice(["", "a,b", 'say "x"', "", "ü 中"]) for _ in range(draw.randrange(1, 6)))
    if kind == 1:
        return '"' * draw.randrange(4)
    return draw.choice(["", "plain", " spaced ", "a,b", "it's", "0", "é" * 30, "line\nline", "x\r\ny"])


def write(path, rows, ends="\n", headers=HEADERS) -> None:
    with open(path, "w", newline="", encoding="utf-8") as file:
        writer = csv.writer(file, lineterminator=ends)
        writer.writerow(headers)
        writer.writerows(rows)


def rows_of(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("ends", ["\n", "\r\n"])
def test_equals_the_multi_line_reader(spark, tmp_path, small_splits, ends):
    draw = random.Random(1)
    for number in range(3):
        rows = [[f"{number}-{i}", *(value(draw) for _ in HEADERS[1:])] for i in range(150)]
        write(tmp_path / f"{number}.csv", rows, ends)
    split = bl.read_incident_csv(spark, str(tmp_path))
    assert split.rdd.getNumPartitions() > 20
    whole = bl.read_incident_csv(spark, str(tmp_path), split=False)
    assert rows_of(split) == rows_of(whole)
    assert split.count() == 450


def test_a_record_over_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i}, of one value" for i in range(800))
    rows = [["1", "", long], ["2", "", "short"], ["3", "", f'"{long}"\n'], ["4", "", long]]
    write(tmp_path / "a.csv", rows, headers=["ID", "Case Number", "Description"])
    got = {r["ID"]: r["Description"] for r in bl.read_incident_csv(spark, str(tmp_path)).collect()}
    assert got == {row[0]: row[2] for row in rows}


def test_headers_over_lines_and_splits(spark, tmp_path, small_splits):
    odd = "Free\n" * 400 + "text"
    write(tmp_path / "a.csv", [["x", "1", "b"]], headers=[odd, "ID", "Block"])
    row = bl.read_incident_csv(spark, str(tmp_path)).head()
    assert (row["ID"], row["Block"]) == ("1", "b")


def test_empty_files_and_lines(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text('ID,Block\n\n1,"a\n\nb"\n\n\n2,c')
    (tmp_path / "b.csv").write_text("ID,Block\n")
    got = [(r["ID"], r["Block"]) for r in bl.read_incident_csv(spark, str(tmp_path)).collect()]
    assert sorted(got) == [("1", "a\n\nb"), ("2", "c")]


def test_files_with_other_headers_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text('ID,Block\n1,"x\ny"\n')
    (tmp_path / "b.csv").write_text("Block,ID\nx,1\n")
    with pytest.raises(Exception, match="header"):
        bl.read_incident_csv(spark, str(tmp_path)).collect()


def test_many_splits_are_joined_from_storage(spark, tmp_path, small_splits, monkeypatch):
    from blotterline.sources import split_csv

    rows = [[str(i), "", "two\nlines" * (i % 50)] for i in range(100)]
    write(tmp_path / "a.csv", rows, headers=["ID", "Case Number", "Description"])
    monkeypatch.setattr(split_csv, "MOST_BROADCAST", 3)
    got = {r["ID"]: r["Description"] for r in bl.read_incident_csv(spark, str(tmp_path)).collect()}
    assert got == {row[0]: row[2] for row in rows}


def test_lines_are_not_shuffled(spark, tmp_path):
    write(tmp_path / "a.csv", [["1", "a\nb"]], headers=["ID", "Block"])
    plan = plan_of(bl.read_incident_csv(spark, str(tmp_path)))
    # Exchanges are below the parities' aggregate, and for the pieces at the ends of splits.
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
