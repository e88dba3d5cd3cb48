from __future__ import annotations

import csv

import jobs
import pytest

import blotterline as bl
from blotterline.schema import FIELD_TO_HEADER
from tests.conftest import incident


@pytest.fixture(scope="module")
def base(tmp_path_factory, spark):
    """Layers and training results of the jobs run one after the other on a CSV."""
    folder = tmp_path_factory.mktemp("jobs")
    with open(folder / "in.csv", "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow(FIELD_TO_HEADER.values())
        for i in range(400):
            row = incident(
                str(i),
                Date=f"01/0{i % 9 + 1}/2023 {i % 12 + 1:02}:30:00 {'AM' if i % 2 else 'PM'}",
                Primary_Type=f'TYPE "{i % 3}"\nB',
                Arrest="true" if i % 12 > 6 and i % 3 == 1 else "false",
            )
            writer.writerow([row.get(name) or "" for name in FIELD_TO_HEADER])
    landing, target = str(folder / "landing"), str(folder / "base")
    for _ in range(2):
        jobs.main(["publish", str(folder / "in.csv"), "--multi-line", "--path", landing])
        jobs.main(["layers", target, "--path", landing, "--once"])
    jobs.main(["train", target, "--parallelism", "3"])
    return target


def test_the_layers_hold_each_record_once(spark, base):
    counts = [bl.read_layer(spark, f"{base}/{n}").count() for n in ("bronze", "silver", "gold")]
    assert counts == [800, 400, 400]


def test_training_results(spark, base):
    runs = bl.read_layer(spark, f"{base}/runs")
    assert runs.count() == 5
    best = bl.best_model(runs).head()["classifier"]
    for table in ("confusion", "roc"):
        names = bl.read_layer(spark, f"{base}/{table}").select("classifier").distinct()
        assert [row[0] for row in names.collect()] == [best]
    importances = bl.read_layer(spark, f"{base}/importances")
    assert importances.select("classifier").distinct().count() == 2


def test_report(base, capsys):
    jobs.main(["report", base])
    shown = capsys.readouterr().out
    assert ["rows", "all", "400"] in [line.split() for line in shown.splitlines()]


def test_report_before_there_is_gold(tmp_path, capsys):
    jobs.main(["report", str(tmp_path)])
    shown = capsys.readouterr().out
    assert ["rows", "all", "0"] in [line.split() for line in shown.splitlines()]


def test_training_needs_gold(tmp_path):
    with pytest.raises(bl.LayerNotReady):
        jobs.main(["train", str(tmp_path)])


def test_commands_are_checked():
    for arguments in ([], ["layers"], ["unknown", "x"]):
        with pytest.raises(SystemExit):
            jobs.parser().parse_args(arguments)
