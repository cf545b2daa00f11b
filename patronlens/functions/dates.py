"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_month_day(text: Column) -> Column:
    """True when ``text`` starts with the four digits of an ``MMdd`` day."""
    return F.coalesce(text.rlike(r"^[0-9]{4}"), F.lit(False))


def month_day_to_date(text: Column, year: int, on_bad: str = "null") -> Column:
    """``MMdd`` text to a date in ``year``, rolling overflow forward.

    ``0229`` in a common year is 1 March and ``1301`` is 1 January of the next year. Only the
    first four characters count. Text that does not start with four digits gives null, or
    fails the query with ``on_bad="fail"``.
    """
    if on_bad not in ("null", "fail"):
        raise ValueError("on_bad must be 'null' or 'fail'")
    month = F.substring(text, 1, 2).try_cast("int")
    day = F.substring(text, 3, 2).try_cast("int")
    first = F.add_months(F.make_date(F.lit(year), F.lit(1), F.lit(1)), month - 1)
    rolled = F.when(is_month_day(text), F.date_add(first, day - 1))
    if on_bad == "fail":
        message = F.concat(F.lit("not an MMdd day: "), F.coalesce(text, F.lit("null")))
        return rolled.otherwise(F.raise_error(message).cast("date"))
    return rolled
