from __future__ import annotations

import pytest

import blotterline as bl
from blotterline.schema import (
    ENVELOPE_SCHEMA,
    FIELD_TO_HEADER,
    FIELDS,
    GOLD_SCHEMA,
)
from tests.conftest import incident


def write(path, *lines: str) -> str:
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_csv_fields_are_found_by_header(spark, tmp_path):
    headers = list(reversed(FIELD_TO_HEADER.values()))
    path = write(tmp_path / "a.csv", ",".join(headers), ",".join(f"v{h}" for h in headers))
    row = bl.read_incident_csv(spark, path).head()
    assert row.asDict() == {name: f"v{header}" for name, header in FIELD_TO_HEADER.items()}


def test_csv_blanks_quotes_and_missing_values(spark, tmp_path):
    path = write(
        tmp_path / "a.csv",
        "ID,Case Number,Description,Extra",
        '1,,"a ""q"" b",x',
        '2,"","two',
        'lines, one value",x',
        "3",
        "4,c,d,x,too,many",
        '5,"  ", x ,x',
    )
    frame = bl.read_incident_csv(spark, path)
    assert frame.columns == FIELDS
    found = {
        row["ID"]: (row["Case_Number"], row["Description"], row["Block"])
        for row in frame.collect()
    }
    assert found == {
        "1": ("", 'a "q" b', None),
        "2": ("", "two\nlines, one value", None),
        "3": ("", "", None),
        "4": ("c", "d", None),
        "5": ("  ", " x ", None),
    }


def test_csv_single_line_mode_splits_records_at_line_ends(spark, tmp_path):
    path = write(tmp_path / "a.csv", "ID,Block", '1,"a ""b"""', "2,ü")
    rows = bl.read_incident_csv(spark, path, multi_line=False).select("ID", "Block").collect()
    assert [tuple(row) for row in rows] == [("1", 'a "b"'), ("2", "ü")]


def test_csv_files_with_other_headers_fail_instead_of_mixing_columns(spark, tmp_path):
    write(tmp_path / "a.csv", "ID,Block", "1,x")
    write(tmp_path / "b.csv", "Block,ID", "x,1")
    with pytest.raises(Exception, match="header"):
        bl.read_incident_csv(spark, str(tmp_path)).collect()


def test_file_messages_have_the_envelope_of_the_broker(spark, tmp_path):
    write(tmp_path / "a.txt", '{"ID":"1"}')
    stream = bl.file_source(spark, str(tmp_path), max_files_per_trigger=1)
    batch = bl.read_messages(spark, str(tmp_path))
    assert stream.isStreaming
    assert stream.schema == batch.schema == ENVELOPE_SCHEMA
    assert bytes(batch.head()["value"]) == b'{"ID":"1"}'


def test_publish_writes_nulls_and_keeps_line_breaks_inside_a_message(spark, tmp_path, records):
    path = str(tmp_path / "topic")
    sent = records(incident("1", Block="a\nb"), incident("2", Block=None))
    bl.publish(sent, path=path)
    bl.publish(sent.limit(0), path=path)
    texts = [bytes(r["value"]).decode() for r in bl.read_messages(spark, path).collect()]
    assert len(texts) == 2
    assert all('"Case_Number":null' in text for text in texts)
    back = bl.parse_payload(bl.read_messages(spark, path))
    assert sorted(back.collect()) == sorted(sent.collect())


def test_publish_needs_one_target(records):
    for target in ({}, {"path": "p", "topic": "t"}, {"servers": "s"}):
        with pytest.raises(ValueError):
            bl.publish(records(incident("1")), **target)


def test_absent_layer(spark, tmp_path):
    path = str(tmp_path / "gold")
    with pytest.raises(bl.LayerNotReady):
        bl.read_layer(spark, path)
    empty = bl.read_layer(spark, path, on_missing="empty", schema=GOLD_SCHEMA)
    assert empty.schema == GOLD_SCHEMA
    assert empty.isEmpty()
    with pytest.raises(ValueError):
        bl.read_layer(spark, path, on_missing="empty")
    with pytest.raises(ValueError):
        bl.read_layer(spark, path, on_missing="ignore")


def test_empty_folder_and_empty_table_are_not_ready(spark, tmp_path):
    (tmp_path / "none").mkdir()
    with pytest.raises(bl.LayerNotReady):
        bl.read_layer(spark, str(tmp_path / "none"))
    spark.createDataFrame([], GOLD_SCHEMA).write.parquet(str(tmp_path / "gold"))
    with pytest.raises(bl.LayerNotReady):
        bl.read_layer(spark, str(tmp_path / "gold"))


def test_other_read_errors_surface(spark, tmp_path):
    with pytest.raises(Exception, match="nosuchformat"):
        bl.read_layer(spark, str(tmp_path), fmt="nosuchformat")


def test_reading_again_is_the_refresh(spark, tmp_path, records):
    path = str(tmp_path / "layer")
    records(incident("1")).write.parquet(path)
    assert bl.read_layer(spark, path).count() == 1
    records(incident("2")).write.mode("append").parquet(path)
    assert bl.read_layer(spark, path).count() == 2


class Recorder:
    """Stands in for a session without the Kafka package; keeps the source's options."""

    def __init__(self):
        self.options = {}
        self.readStream = self

    def format(self, name):
        self.options["format"] = name
        return self

    def option(self, key, value):
        self.options[key] = value
        return self

    def load(self):
        return self.options


def test_kafka_options():
    assert bl.kafka_source(Recorder(), "host:9092", "incidents") == {
        "format": "kafka",
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "incidents",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    backfill = bl.kafka_source(
        Recorder(), "h", "t", "earliest", True, max_offsets_per_trigger=9, min_partitions=7
    )
    assert backfill["startingOffsets"] == "earliest"
    assert backfill["failOnDataLoss"] == "true"
    assert (backfill["maxOffsetsPerTrigger"], backfill["minPartitions"]) == (9, 7)
