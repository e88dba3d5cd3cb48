"""Field lists, formats and settings of the incident data model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Names, order and texts decide the results, so they are stated
# here once, as they are.
# ---------------------------------------------------------------------------

# Field -> header of the source CSV, in message order.
FIELD_TO_HEADER = {
    "ID": "ID",
    "Case_Number": "Case Number",
    "Date": "Date",
    "Block": "Block",
    "IUCR": "IUCR",
    "Primary_Type": "Primary Type",
    "Description": "Description",
    "Location_Description": "Location Description",
    "Arrest": "Arrest",
    "Domestic": "Domestic",
    "Beat": "Beat",
    "District": "District",
    "Ward": "Ward",
    "Community_Area": "Community Area",
    "FBI_Code": "FBI Code",
    "X_Coordinate": "X Coordinate",
    "Y_Coordinate": "Y Coordinate",
    "Year": "Year",
    "Updated_On": "Updated On",
    "Latitude": "Latitude",
    "Longitude": "Longitude",
}

# A record without one of these is no incident.
REQUIRED_FIELDS = ["ID", "Date", "Primary_Type"]

# Text fields that silver turns into booleans, and the one text that is true.
FLAG_FIELDS = ["Arrest", "Domestic"]
TRUE_TEXT = "true"

GOLD_FIELDS = [
    "ID",
    "Date",
    "Primary_Type",
    "Location_Description",
    "Arrest",
    "Domestic",
    "District",
    "Year",
    "Latitude",
    "Longitude",
]

DATE_FORMAT = "MM/dd/yyyy hh:mm:ss a"

# Beside gold's own columns in its files: the day of the event, null if the date is unreadable.
EVENT_DAY = "event_day"

# Spark day numbers of the weekend: Sunday and Saturday.
WEEKEND_DAYS = [1, 7]

UNKNOWN_CATEGORY = "UNKNOWN"

# Inputs of the feature vector, in vector order.
FEATURE_INPUTS = [
    "Hour",
    "DayOfWeek",
    "IsWeekend",
    "Latitude",
    "Longitude",
    "Type_Vec",
    "Loc_Vec",
]

# One-hot column -> (index column, source column).
ENCODED = {
    "Type_Vec": ("Type_Indexed", "Primary_Type"),
    "Loc_Vec": ("Loc_Indexed", "Location_Description"),
}

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

FIELDS = list(FIELD_TO_HEADER)

INCIDENT_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in FIELDS])

SILVER_SCHEMA = T.StructType(
    [
        T.StructField(name, T.BooleanType() if name in FLAG_FIELDS else T.StringType())
        for name in FIELDS
    ]
)

GOLD_SCHEMA = T.StructType([SILVER_SCHEMA[name] for name in GOLD_FIELDS])

# What Spark's Kafka source delivers.
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

BRONZE_SCHEMA = T.StructType(
    [*ENVELOPE_SCHEMA.fields, T.StructField("ingested_at", T.TimestampType())]
)

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("run_ts", T.TimestampType()),
        T.StructField("classifier", T.StringType()),
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("f1", T.DoubleType()),
        T.StructField("auc", T.DoubleType()),
    ]
)
