"""Join shapes that are offered on their own as well as inside the feature plan."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.functions.numbers import ratio


def full_outer_chain(frames: Sequence[DataFrame], keys: list[str]) -> DataFrame:
    """Full outer USING join of grouped frames on one key.

    The frames share the key, so Spark shuffles each once and joins them in place.
    """
    return reduce(lambda left, right: left.join(right, keys, "full"), frames)


def attach_left(
    pairs: DataFrame,
    users: DataFrame,
    sellers: DataFrame,
    profile: DataFrame | None = None,
    between: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Attach the seller, user and profile columns to pair rows; no pair is lost.

    The narrow seller side goes first, so the second shuffle of the pairs is still narrow. The
    profile is attached to the users, not to the far more numerous pairs. ``between`` gets the
    pairs with their sellers, before the users; it may stage them.
    """
    people = users if profile is None else users.join(profile, "user_id", "left")
    return between(pairs.join(sellers, "seller_id", "left")).join(people, "user_id", "left")


def share_of_total(totals: DataFrame, parts: DataFrame, part: str, whole: str, name: str) -> DataFrame:
    """``part / whole`` per pair, for pairs in both frames, as SQL with the join in WHERE."""
    joined = parts.sparkSession.sql(
        """
        SELECT t.*, p.* EXCEPT (user_id, seller_id)
        FROM {totals} t, {parts} p
        WHERE t.user_id = p.user_id AND t.seller_id = p.seller_id
        """,
        totals=totals,
        parts=parts,
    )
    return joined.withColumn(name, ratio(F.col(part), F.col(whole)))


def register_views(frames: dict[str, DataFrame]) -> None:
    """Make frames visible to ``spark.sql`` under the given names."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
