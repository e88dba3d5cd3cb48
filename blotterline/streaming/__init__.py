"""The streaming layer job."""

from blotterline.streaming.medallion import await_any, drain, late_records, start_medallion
from blotterline.streaming.state import dedup_state, state_operators

__all__ = ["await_any", "dedup_state", "drain", "late_records", "start_medallion", "state_operators"]
