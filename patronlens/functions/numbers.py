"""Small numeric expressions shared by the feature blocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, 0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def average_span(last: Column, first: Column, count: Column) -> Column:
    """Days between ``first`` and ``last`` divided by the number of actions."""
    return ratio(F.date_diff(last, first), count)
