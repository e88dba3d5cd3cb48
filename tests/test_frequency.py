from __future__ import annotations

import pytest

import blotterline as bl
from tests.conftest import incident, plan_of


@pytest.fixture(scope="module")
def gold(records):
    rows = (
        [incident(f"a{i}", Primary_Type="THEFT", Arrest="true") for i in range(3)]
        + [incident(f"b{i}", Primary_Type="ASSAULT", Location_Description="") for i in range(3)]
        + [incident("c", Primary_Type="  ", Location_Description=None)]
        + [incident("d", Date="01/07/2023 12:05:00 AM", Location_Description="PARK")]
        + [incident("e", Date="bad")]
    )
    return bl.to_gold(bl.clean_records(records(*rows))).cache()


def rows(df) -> list[tuple]:
    return [tuple(row) for row in df.collect()]


def test_row_count(gold):
    assert rows(bl.row_count(gold)) == [(9,)]
    assert rows(bl.row_count(gold.limit(0))) == [(0,)]


def test_hours_are_ascending_without_bad_dates_and_empty_hours(gold):
    assert rows(bl.hourly_counts(gold)) == [(0, 1), (13, 7)]


def test_value_counts_skip_nulls_keep_blanks_and_break_ties_by_value(gold):
    assert rows(bl.value_counts(gold, "Primary_Type")) == [
        ("THEFT", 5), ("ASSAULT", 3), ("  ", 1),
    ]
    assert rows(bl.value_counts(gold, "Location_Description")) == [
        ("STREET", 4), ("", 3), ("PARK", 1),
    ]


def test_shares(gold):
    shares = rows(bl.value_counts(gold, "Location_Description", share=True))
    assert shares == [("STREET", 4, 0.5), ("", 3, 0.375), ("PARK", 1, 0.125)]
    assert rows(bl.top_k(gold, "Location_Description", 2, share=True)) == [
        ("STREET", 4, 4 / 7), ("", 3, 3 / 7),
    ]


def test_top_k_cuts_after_the_tie_break(records):
    frame = records(*[incident(str(i), Primary_Type=t) for i, t in enumerate("CABBAC")])
    assert rows(bl.top_k(frame, "Primary_Type", 2)) == [("A", 2), ("B", 2)]


def test_arrest_share(gold):
    assert rows(bl.arrest_share(gold)) == [("not arrested", 6, 6 / 9), ("arrested", 3, 3 / 9)]
    assert rows(bl.arrest_share(gold, ("yes", "no")))[0][0] == "no"


def test_weekends(gold):
    assert rows(bl.weekend_counts(gold)) == [("weekday", 8), ("weekend", 1)]
    assert rows(bl.weekend_counts(gold, "drop")) == [("weekday", 7), ("weekend", 1)]
    assert rows(bl.weekend_counts(gold, labels=("sat-sun", "mon-fri")))[0] == ("mon-fri", 8)
    with pytest.raises(ValueError):
        bl.weekend_counts(gold, "ignore")


def test_day_names(gold):
    names = {row["ID"]: row["day_name"] for row in bl.day_name(gold).collect()}
    assert (names["a0"], names["d"], names["e"]) == ("Thursday", "Saturday", None)


def test_dashboard_report_agrees_with_the_single_tables(gold):
    report = {}
    for section, item, count in rows(bl.dashboard_report(gold)):
        report.setdefault(section, {})[item] = count
    assert report == {
        "rows": {"all": 9},
        "hour": {str(h): n for h, n in rows(bl.hourly_counts(gold))},
        "arrest": {"true": 3, "false": 6},
        "type": dict(rows(bl.top_k(gold, "Primary_Type"))),
        "period": dict(rows(bl.weekend_counts(gold))),
        "location": dict(rows(bl.top_k(gold, "Location_Description"))),
    }


def test_hours_add_up_to_the_rows_with_a_date(gold):
    total = sum(n for _, n in rows(bl.hourly_counts(gold)))
    assert total == sum(n for _, n in rows(bl.weekend_counts(gold, "drop")))


def test_plans_scan_needed_columns_and_take_ordered(spark, gold, tmp_path):
    path = str(tmp_path / "gold")
    gold.write.parquet(path)
    stored = bl.read_layer(spark, path)
    top = plan_of(bl.top_k(stored, "Primary_Type"))
    assert "TakeOrderedAndProject" in top
    assert "ReadSchema: struct<Primary_Type:string>" in top
    hours = plan_of(bl.hourly_counts(stored))
    assert "ReadSchema: struct<Date:string>" in hours
    assert hours.count("try_to_timestamp") == 1
    for bad_date in ("weekday", "drop"):
        weekends = plan_of(bl.weekend_counts(stored, bad_date))
        assert weekends.count("try_to_timestamp") == 1
    # The calendar aggregate is shuffled once and used three times.
    report = bl.dashboard_report(stored)
    report.collect()
    final = plan_of(report).split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") == 2
    assert final.count("ReadSchema: struct<Date:string>") == 1
    # Shares of a long table of values come without a global window.
    assert "Window" not in plan_of(bl.value_counts(stored, "Primary_Type", share=True))
