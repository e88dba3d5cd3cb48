"""DataFrame -> DataFrame operators."""

from blotterline.operators.dedup import collapse_copies, dedup_first
from blotterline.operators.encoding import classifiers, fit_prep, prep_pipeline
from blotterline.operators.evaluation import (
    accuracy,
    confusion,
    metrics_long,
    score_tally,
    weighted_f1,
)
from blotterline.operators.features import day_name, derive_features, weekend_label
from blotterline.operators.frequency import (
    arrest_share,
    hourly_counts,
    row_count,
    top_k,
    value_counts,
    weekend_counts,
)
from blotterline.operators.importance import importances
from blotterline.operators.layers import (
    clean_records,
    parse_payload,
    to_bronze,
    to_gold,
    to_silver,
)
from blotterline.operators.model_tables import (
    boosted_stats,
    importances_from_nodes,
    kind_of,
    logistic_gradient,
    node_table,
    predict_from_nodes,
)
from blotterline.operators.ranking import auc, roc_points
from blotterline.operators.rejects import (
    judge_features,
    judge_messages,
    reason_counts,
    split_messages,
)
from blotterline.operators.split import split_by_hash, split_random

__all__ = [
    "accuracy",
    "arrest_share",
    "auc",
    "boosted_stats",
    "classifiers",
    "clean_records",
    "collapse_copies",
    "confusion",
    "day_name",
    "dedup_first",
    "derive_features",
    "fit_prep",
    "hourly_counts",
    "importances",
    "importances_from_nodes",
    "judge_features",
    "judge_messages",
    "kind_of",
    "logistic_gradient",
    "metrics_long",
    "node_table",
    "parse_payload",
    "predict_from_nodes",
    "prep_pipeline",
    "reason_counts",
    "roc_points",
    "row_count",
    "score_tally",
    "split_by_hash",
    "split_messages",
    "split_random",
    "to_bronze",
    "to_gold",
    "to_silver",
    "top_k",
    "value_counts",
    "weekend_counts",
    "weekend_label",
    "weighted_f1",
]
