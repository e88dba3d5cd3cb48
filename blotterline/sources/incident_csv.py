"""Scan of the incident CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotterline.schema import FIELD_TO_HEADER
from blotterline.sources.split_csv import read_split_csv


def read_incident_csv(
    spark: SparkSession, path: str, multi_line: bool = True, split: bool = True
) -> DataFrame:
    """The 21 message fields, all strings, picked from the CSV by header name.

    Other columns are ignored and an absent header gives nulls. A blank or missing value in
    a present column is the empty string. Quotes inside a quoted value are doubled.

    ``multi_line`` allows line breaks inside quoted values. Files are split over tasks all the same
    (:mod:`split_csv`), at the price of scanning them twice; quotes have to stand around whole
    values. ``split=False`` leaves the reading to Spark, one task per file. Without line breaks in
    values, ``multi_line=False`` reads in one scan.
    """
    raw = (
        spark.read.option("header", True)
        .option("encoding", "UTF-8")
        .option("inferSchema", False)
        .option("escape", '"')
        .option("multiLine", multi_line)
        # Files of one folder whose headers differ fail instead of being read by position.
        .option("enforceSchema", False)
        .csv(path)
    )
    if multi_line and split:
        raw = read_split_csv(spark, path, raw.columns, {"escape": '"'})
    present = set(raw.columns)

    def field(header: str) -> Column:
        if header not in present:
            return F.lit(None).cast("string")
        return F.coalesce(raw[f"`{header}`"], F.lit(""))

    return raw.select(*[field(header).alias(name) for name, header in FIELD_TO_HEADER.items()])
