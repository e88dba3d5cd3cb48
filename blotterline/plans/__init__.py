"""Whole jobs composed of operators, sources and sinks."""

from blotterline.plans.backfill import backfill
from blotterline.plans.counts import CountsView, partial_counts, report_of_counts
from blotterline.plans.dashboard import dashboard_report
from blotterline.plans.training import best_model, train_all, train_and_record

__all__ = [
    "CountsView",
    "backfill",
    "best_model",
    "dashboard_report",
    "partial_counts",
    "report_of_counts",
    "train_all",
    "train_and_record",
]
