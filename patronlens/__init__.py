"""Repeat-customer feature, training and scoring jobs on Spark DataFrames."""

from patronlens.config import FeatureConfig

__all__ = ["FeatureConfig"]
