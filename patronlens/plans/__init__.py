from patronlens.plans.features import basic_features, full_features, labelled_log, typed
from patronlens.plans.tables import staged, temporary_tables

__all__ = ["basic_features", "full_features", "labelled_log", "staged", "temporary_tables", "typed"]
