"""Null handling of the user profile."""

from __future__ import annotations

from pyspark.sql import DataFrame

from patronlens.config import UNKNOWN_AGE, UNKNOWN_GENDER


def fill_profile(info: DataFrame) -> DataFrame:
    """Known users with an unknown age or gender get the code for "unknown"."""
    return info.na.fill(UNKNOWN_AGE, ["age_range"]).na.fill(UNKNOWN_GENDER, ["gender"])
