from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from blotterline import functions as bf


def evaluate(spark, expression, values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [row[0] for row in frame.select(expression(F.col("x")), "i").orderBy("i").collect()]


def test_flag_is_true_for_one_text_only_and_never_null(spark):
    texts = ["true", "TRUE", "True", " true", "1", "", None]
    assert evaluate(spark, bf.flag, texts) == [True] + [False] * 6


@pytest.mark.parametrize(
    "text, hour",
    [
        ("01/05/2023 12:00:00 AM", 0),
        ("01/05/2023 12:00:00 PM", 12),
        ("01/05/2023 11:59:00 pm", 23),
        ("1/5/2023 1:02:03 AM", None),
        ("13/05/2023 01:00:00 AM", None),
        (" 01/05/2023 01:00:00 AM", None),
        ("01/05/2023 13:00:00 PM", None),
        ("2023-01-05T01:00:00", None),
        ("garbage", None),
        ("", None),
        (None, None),
    ],
)
def test_event_time_is_strict_and_never_raises(spark, text, hour):
    assert evaluate(spark, lambda c: bf.hour_of_day(bf.event_time(c)), [text]) == [hour]


def test_day_numbers_start_on_sunday(spark):
    days = [f"01/0{d}/2023 01:00:00 AM" for d in range(1, 9)]
    assert evaluate(spark, lambda c: bf.day_number(bf.event_time(c)), days) == [
        1, 2, 3, 4, 5, 6, 7, 1,
    ]
    assert evaluate(spark, lambda c: bf.weekend_flag(bf.day_number(bf.event_time(c))), days) == [
        1, 0, 0, 0, 0, 0, 1, 1,
    ]
    assert evaluate(spark, lambda c: bf.day_name_of(bf.event_time(c)), days[:2]) == [
        "Sunday", "Monday",
    ]


def test_weekend_text_counts_a_missing_day_as_weekday(spark):
    texts = ["01/07/2023 01:00:00 AM", "01/05/2023 01:00:00 AM", "bad", None]
    found = evaluate(
        spark, lambda c: bf.weekend_text(bf.day_number(bf.event_time(c)), "end", "week"), texts
    )
    assert found == ["end", "week", "week", "week"]


def test_numbers_accept_surrounding_blanks_and_never_raise(spark):
    assert evaluate(spark, bf.to_number, [" 41.8 ", "-87", "x", "", None]) == [
        41.8, -87.0, None, None, None,
    ]


def test_blank_categories_become_unknown_and_others_stay(spark):
    assert evaluate(spark, bf.or_unknown, [None, "", "  ", " A "]) == [
        "UNKNOWN", "UNKNOWN", "UNKNOWN", " A ",
    ]
    assert evaluate(spark, bf.is_blank, [None, "", "  ", " A "]) == [True, True, True, False]


def test_percent_bucket_is_the_md5_prefix(spark):
    keys = ["1", "42", "", "ü", None]
    expected = [int(hashlib.md5((k or "").encode()).hexdigest()[:8], 16) % 100 for k in keys]
    assert evaluate(spark, bf.percent_bucket, keys) == expected
