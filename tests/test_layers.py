from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

import blotterline as bl
from blotterline.operators import collapse_copies
from blotterline.schema import BRONZE_SCHEMA, FIELDS, GOLD_SCHEMA, SILVER_SCHEMA
from blotterline.sources import as_envelope
from tests.conftest import incident, plan_of


@pytest.fixture(scope="module")
def messages(spark):
    def make(*texts: str | None):
        return as_envelope(spark.createDataFrame([(t,) for t in texts], "value string"))

    return make


def ids(df) -> list[str]:
    return sorted(row["ID"] for row in df.select("ID").collect())


def test_bronze_keeps_the_message_and_adds_its_arrival(messages):
    bronze = bl.to_bronze(messages("anything", None))
    assert [f.name for f in bronze.schema] == BRONZE_SCHEMA.names
    assert [f.dataType for f in bronze.schema] == [f.dataType for f in BRONZE_SCHEMA]
    rows = bronze.collect()
    assert len({row["ingested_at"] for row in rows}) == 1
    assert {row["value"] and bytes(row["value"]) for row in rows} == {b"anything", None}


def test_unreadable_messages_become_nulls_and_leave_silver(messages):
    good = json.dumps(incident("1"))
    parsed = bl.parse_payload(messages(good, "not json", '{"ID":"1"', good[:-9], "", None, "[]"))
    assert parsed.columns == FIELDS
    assert parsed.count() == 7
    assert ids(bl.to_silver(parsed)) == ["1"]


def test_json_numbers_become_their_text(messages):
    text = json.dumps({**incident("x"), "ID": 5, "Year": 2023, "New": {"a": 1}})
    row = bl.parse_payload(messages(text)).head()
    assert (row["ID"], row["Year"]) == ("5", "2023")


def test_required_fields_may_be_empty_but_not_null(records):
    silver = bl.to_silver(
        records(
            incident(""),
            incident("a", Date=""),
            incident("b", Primary_Type=""),
            incident(None),
            incident("c", Date=None),
            incident("d", Primary_Type=None),
        )
    )
    assert ids(silver) == ["", "a", "b"]
    assert silver.schema.simpleString() == SILVER_SCHEMA.simpleString()


def test_silver_keeps_one_record_per_id_repeatably(records):
    copies = [incident("1", Block=b) for b in ("c", "a", "b")] + [incident("2")]
    for order in (copies, copies[::-1]):
        frame = records(*order).repartition(3)
        silver = {row["ID"]: row["Block"] for row in bl.to_silver(frame).collect()}
        assert silver == {"1": "a", "2": None}
    again = bl.to_silver(records(*copies))
    assert sorted(bl.dedup_first(again, ["ID"], ["Date"]).collect()) == sorted(again.collect())


def test_dedup_first_follows_the_given_order(records):
    copies = records(incident("1", Year="2020"), incident("1", Year="2022"))
    newest = bl.dedup_first(copies, ["ID"], [F.desc("Year")]).collect()
    assert [row["Year"] for row in newest] == ["2022"]


def test_a_hot_id_is_cut_down_before_the_shuffle(spark, records):
    plan = plan_of(bl.to_silver(records(incident("1"))))
    # "Partial" below the exchange keeps one row per key and task.
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_collapse_copies_loses_no_key(spark):
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 5000).cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    fewer = collapse_copies(rows, "k")
    assert fewer.columns == ["k", "v"]
    assert {r["k"] for r in fewer.collect()} == {r["k"] for r in rows.collect()}
    assert fewer.filter("k = 'hot'").count() < 100
    nulls = spark.createDataFrame([(None,), (None,), ("a",)], "k string").coalesce(1)
    assert sorted(r["k"] or "" for r in collapse_copies(nulls, "k").collect()) == ["", "a"]


def test_collapse_copies_does_not_see_rows_filtered_before(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int").coalesce(1)
    kept = collapse_copies(rows.filter("v = 2"), "k").collect()
    assert [tuple(row) for row in kept] == [("a", 2)]


def test_gold_is_a_projection(records):
    gold = bl.to_gold(bl.to_silver(records(incident("1", Arrest="true"))))
    assert gold.schema.simpleString() == GOLD_SCHEMA.simpleString()
    assert gold.head()["Arrest"] is True


def test_the_payload_is_parsed_once(messages):
    plan = plan_of(bl.clean_records(bl.parse_payload(messages("{}"))))
    assert plan.count("from_json") == 1


def test_features(records):
    rows = [
        incident("ok", Arrest="true", Primary_Type=" ", Location_Description=None),
        incident("blanks", Latitude=" 41.8 ", Location_Description=" A "),
        incident("weekend", Date="01/07/2023 12:10:00 AM"),
        incident("lat", Latitude="x"),
        incident("lat2", Latitude=" "),
        incident("lat3", Latitude=None),
        incident("lon", Longitude=""),
        incident("nan", Longitude="NaN"),
        incident("date", Date="1/5/2023 1:02:03 AM"),
        incident("date2", Date=" "),
    ]
    derived = bl.derive_features(bl.to_gold(bl.to_silver(records(*rows))))
    found = {row["ID"]: row for row in derived.collect()}
    assert set(found) == {"ok", "blanks", "weekend"}
    ok, weekend = found["ok"], found["weekend"]
    assert (ok["Hour"], ok["DayOfWeek"], ok["IsWeekend"], ok["label"]) == (13, 5, 0, 1)
    assert (ok["Primary_Type"], ok["Location_Description"]) == ("UNKNOWN", "UNKNOWN")
    assert (ok["Latitude"], ok["Longitude"]) == (41.8, -87.6)
    assert (weekend["Hour"], weekend["DayOfWeek"], weekend["IsWeekend"]) == (0, 7, 1)
    assert found["blanks"]["Location_Description"] == " A "
    assert [f"{n}:{t}" for n, t in derived.dtypes if n not in ("ID", "Date")] == [
        "Primary_Type:string", "Location_Description:string", "Arrest:boolean",
        "Domestic:boolean", "District:string", "Year:string", "Latitude:double",
        "Longitude:double", "ts:timestamp", "Hour:int", "DayOfWeek:int", "IsWeekend:int",
        "label:int",
    ]


def test_features_need_no_shuffle_and_read_each_text_once(records):
    plan = plan_of(bl.derive_features(bl.to_gold(bl.clean_records(records(incident("1"))))))
    assert "Exchange" not in plan
    assert plan.count("try_to_timestamp") == 1


def test_split_by_hash_is_disjoint_whole_and_stable(spark):
    frame = spark.range(5000).select(F.col("id").cast("string").alias("ID"))
    train, test = bl.split_by_hash(frame)
    assert train.count() + test.count() == 5000
    assert train.join(test, "ID").isEmpty()
    assert 0.77 < train.count() / 5000 < 0.83
    moved, _ = bl.split_by_hash(frame.repartition(7))
    assert sorted(moved.collect()) == sorted(train.collect())


def test_split_random_is_whole(spark):
    train, test = bl.split_random(spark.range(1000))
    assert train.count() + test.count() == 1000


def test_backfill_writes_layers_that_agree(spark, tmp_path, messages):
    feed = messages(*[json.dumps(incident(str(i % 7), Block=str(i))) for i in range(20)], "bad")
    base = str(tmp_path)
    for _ in range(2):
        bl.backfill(feed, base)
    assert bl.read_layer(spark, f"{base}/bronze").count() == 21
    silver = bl.read_layer(spark, f"{base}/silver")
    assert sorted(bl.to_gold(silver).collect()) == sorted(
        bl.read_layer(spark, f"{base}/gold").collect()
    )
    assert ids(silver) == [str(i) for i in range(7)]
