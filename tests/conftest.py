from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from blotterline.schema import INCIDENT_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("work")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def records(spark):
    """Frames of incident records from dicts; fields not given are null."""

    def make(*rows: dict) -> DataFrame:
        return spark.createDataFrame(
            [tuple(row.get(name) for name in INCIDENT_SCHEMA.names) for row in rows],
            INCIDENT_SCHEMA,
        )

    return make


def incident(identifier: str | None, **fields: str | None) -> dict:
    """A complete record with the given changes."""
    base = {
        "ID": identifier,
        "Date": "01/05/2023 01:30:00 PM",
        "Primary_Type": "THEFT",
        "Location_Description": "STREET",
        "Arrest": "false",
        "Domestic": "false",
        "District": "7",
        "Year": "2023",
        "Latitude": "41.8",
        "Longitude": "-87.6",
    }
    return {**base, **fields}


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
