from __future__ import annotations

import json
from collections import Counter

import pytest

import blotterline as bl
from blotterline.schema import FIELDS
from blotterline.sources import as_envelope
from tests.conftest import incident, plan_of
from tests.test_streaming import Job

GOOD = json.dumps(incident("1", Block='a "b"\n'))
MESSAGES = {
    GOOD: None,
    json.dumps({**incident("x"), "ID": 5, "New": {"a": [1]}}): None,
    json.dumps(incident("", Date="")): None,
    GOOD[:-9]: "malformed JSON",
    GOOD + "xyz": None,
    '{"ID":"1"': "malformed JSON",
    "not json": "malformed JSON",
    "": "no payload",
    "5": "malformed JSON",
    "null": "no record",
    "[]": "no record",
    "{}": "no ID",
    json.dumps({**incident("1"), "ID": None}): "no ID",
    json.dumps({**incident("1"), "Date": None, "Primary_Type": None}): "no Date",
    json.dumps({**incident("1"), "Primary_Type": None}): "no Primary_Type",
}


@pytest.fixture(scope="module")
def envelope(spark):
    texts = [(text,) for text in [*MESSAGES, None]]
    return as_envelope(spark.createDataFrame(texts, "value string"))


def test_accepted_is_what_silver_takes(envelope):
    accepted, rejected = bl.split_messages(envelope)
    taken = bl.clean_records(bl.parse_payload(envelope))
    assert accepted.columns == FIELDS
    assert sorted(map(str, bl.clean_records(accepted).collect())) == sorted(map(str, taken.collect()))
    assert accepted.count() + rejected.count() == envelope.count()


def test_each_rejected_message_has_its_reason(envelope):
    accepted, rejected = bl.split_messages(envelope)
    got = {r["payload"]: r["reason"] for r in rejected.collect()}
    assert got.pop(None) == "no payload"
    assert not {m: (got.get(m), r) for m, r in MESSAGES.items() if got.get(m) != r}


def test_payloads_are_read_once(envelope):
    _, rejected = bl.split_messages(envelope)
    assert plan_of(rejected).count("from_json") <= 1


def test_features_are_rejected_for_the_first_reason(records):
    rows = {
        "1": (incident("1"), None),
        "2": (incident("2", Date=" "), "blank Date"),
        "3": (incident("3", Latitude=None, Longitude=""), "blank Latitude"),
        "4": (incident("4", Longitude=" "), "blank Longitude"),
        "5": (incident("5", Date="13/05/2023 01:30:00 PM", Latitude="x"), "unreadable Date"),
        "6": (incident("6", Latitude="NaN"), "no number in Latitude"),
        "7": (incident("7", Longitude="41.8f"), "no number in Longitude"),
        "8": (incident("8", Longitude="1e400"), "no number in Longitude"),
        "9": (incident("9", Date=""), "blank Date"),
    }
    gold = bl.to_gold(bl.clean_records(records(*[row for row, _ in rows.values()])))
    judged = bl.judge_features(gold)
    assert {r["ID"]: r["reason"] for r in judged.collect()} == {i: reason for i, (_, reason) in rows.items()}
    kept = {r["ID"] for r in bl.derive_features(gold).collect()}
    assert kept == {r["ID"] for r in judged.where("reason IS NULL").collect()}


def test_rejects_of_a_stream_add_up(spark, tmp_path, envelope):
    job = Job(spark, tmp_path)
    texts = [m for m in MESSAGES if m and "\n" not in m]
    job.land(*texts)
    job.run(rejects=True)
    job.land(*texts, "more dirt")
    job.run(rejects=True)
    rejected = job.layer("rejects")
    total = 2 * len(texts) + 1
    accepted = bl.clean_records(bl.parse_payload(job.layer("bronze"))).count()
    assert job.layer("bronze").count() == total == accepted + rejected.count()
    counts = Counter(r["reason"] for r in rejected.collect())
    batch = Counter(r["reason"] for r in bl.split_messages(bl.read_messages(spark, str(job.landing)))[1].collect())
    assert counts == batch and counts["malformed JSON"] == 9
