"""The labelled log: every later block is an aggregate over it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.config import PAIR_KEY, FeatureConfig
from patronlens.functions.dates import month_day_to_date


def with_day(log: DataFrame, config: FeatureConfig = FeatureConfig(), on_bad: str = "null") -> DataFrame:
    """Replace the ``MMdd`` text by a ``day`` date."""
    day = month_day_to_date(F.col("time_stamp"), config.year, on_bad)
    return log.withColumn("day", day).drop("time_stamp")


def checked_days(dated: DataFrame, config: FeatureConfig) -> DataFrame:
    """Fail on a missing day if the configuration asks for it."""
    if config.on_bad_day == "null":
        return dated
    message = F.concat_ws(" ", F.lit("not an MMdd day: user"), "user_id", F.lit("seller"), "seller_id")
    return dated.withColumn("day", F.coalesce("day", F.raise_error(message).cast("date")))


def label_pairs(labels: DataFrame) -> DataFrame:
    """One row per distinct (user, seller, label), with the number of label rows behind it.

    A pair listed twice counts its actions twice and comes out twice. Carrying that as a
    number keeps a much-repeated pair from multiplying the log.
    """
    return labels.groupBy(*PAIR_KEY, "label").agg(F.count(F.lit(1)).alias("label_rows"))


def join_log_labels(log: DataFrame, pairs: DataFrame) -> DataFrame:
    """Keep the actions of labelled pairs, each weighted by ``label_rows``.

    One shuffle of the log, on the pair; or none, when Spark finds ``pairs`` small enough to
    broadcast. With ``pairs`` read from a table both join inputs are plain shuffles, so
    adaptive execution can split a pair (or a run of pairs) that outgrows one task.
    """
    return log.join(pairs.select(*PAIR_KEY, "label_rows"), PAIR_KEY, "inner")
