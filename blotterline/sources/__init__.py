"""Scans: incident CSV files, message streams, layer tables."""

from blotterline.sources.incident_csv import read_incident_csv
from blotterline.sources.layers import LayerNotReady, read_layer, read_period
from blotterline.sources.messages import as_envelope, file_source, kafka_source, read_messages

__all__ = [
    "LayerNotReady",
    "as_envelope",
    "file_source",
    "kafka_source",
    "read_incident_csv",
    "read_layer",
    "read_messages",
    "read_period",
]
