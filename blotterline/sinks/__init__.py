"""Writers: messages, layer batches, run table, models."""

from blotterline.sinks.messages import publish
from blotterline.sinks.partitions import compact_layer
from blotterline.sinks.tables import append_runs, replace_batch, save_model

__all__ = ["append_runs", "compact_layer", "publish", "replace_batch", "save_model"]
