"""Incident analytics on Spark: feed, layers, exploration, classifiers.

Sources and sinks know whether data is a batch or a stream; everything between them is a
function from DataFrame to DataFrame.
"""

from blotterline.operators import (
    accuracy,
    arrest_share,
    auc,
    boosted_stats,
    classifiers,
    clean_records,
    confusion,
    day_name,
    dedup_first,
    derive_features,
    fit_prep,
    hourly_counts,
    importances,
    importances_from_nodes,
    judge_features,
    judge_messages,
    kind_of,
    logistic_gradient,
    metrics_long,
    node_table,
    parse_payload,
    predict_from_nodes,
    prep_pipeline,
    reason_counts,
    roc_points,
    row_count,
    score_tally,
    split_by_hash,
    split_messages,
    split_random,
    to_bronze,
    to_gold,
    to_silver,
    top_k,
    value_counts,
    weekend_counts,
    weekend_label,
    weighted_f1,
)
from blotterline.plans import (
    CountsView,
    backfill,
    best_model,
    dashboard_report,
    partial_counts,
    report_of_counts,
    train_all,
    train_and_record,
)
from blotterline.session import build_session, materialize
from blotterline.sinks import append_runs, compact_layer, publish, save_model
from blotterline.sources import (
    LayerNotReady,
    file_source,
    kafka_source,
    read_incident_csv,
    read_layer,
    read_messages,
    read_period,
)
from blotterline.streaming import (
    await_any,
    dedup_state,
    drain,
    late_records,
    start_medallion,
    state_operators,
)

__all__ = [
    "CountsView",
    "LayerNotReady",
    "accuracy",
    "append_runs",
    "arrest_share",
    "auc",
    "await_any",
    "backfill",
    "best_model",
    "boosted_stats",
    "build_session",
    "classifiers",
    "clean_records",
    "compact_layer",
    "confusion",
    "dashboard_report",
    "day_name",
    "dedup_first",
    "dedup_state",
    "derive_features",
    "drain",
    "file_source",
    "fit_prep",
    "hourly_counts",
    "importances",
    "importances_from_nodes",
    "judge_features",
    "judge_messages",
    "kafka_source",
    "kind_of",
    "late_records",
    "logistic_gradient",
    "materialize",
    "metrics_long",
    "node_table",
    "parse_payload",
    "partial_counts",
    "predict_from_nodes",
    "prep_pipeline",
    "publish",
    "read_incident_csv",
    "read_layer",
    "read_messages",
    "read_period",
    "reason_counts",
    "report_of_counts",
    "roc_points",
    "row_count",
    "save_model",
    "score_tally",
    "split_by_hash",
    "split_messages",
    "split_random",
    "start_medallion",
    "state_operators",
    "to_bronze",
    "to_gold",
    "to_silver",
    "top_k",
    "train_all",
    "train_and_record",
    "value_counts",
    "weekend_counts",
    "weekend_label",
    "weighted_f1",
]
