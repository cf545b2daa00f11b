from patronlens.sources.readers import (
    LABEL_SCHEMA,
    USER_INFO_SCHEMA,
    USER_LOG_SCHEMA,
    count_bad_days,
    features_schema,
    observed_days,
    read_features,
    read_labels,
    read_user_info,
    read_user_log,
    rejected_days,
)
from patronlens.sources.sinks import write_features, write_predictions, write_report

__all__ = [
    "LABEL_SCHEMA",
    "USER_INFO_SCHEMA",
    "USER_LOG_SCHEMA",
    "count_bad_days",
    "features_schema",
    "observed_days",
    "read_features",
    "read_labels",
    "read_user_info",
    "read_user_log",
    "rejected_days",
    "write_features",
    "write_predictions",
    "write_report",
]
