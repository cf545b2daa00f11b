"""Assembly of the two feature tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.config import PAIR_KEY, UNKNOWN_AGE, UNKNOWN_GENDER, FeatureConfig
from patronlens.functions.profile import fill_profile
from patronlens.operators.blocks import basic_pair_block, pair_block, seller_block, user_block
from patronlens.operators.fanout import chunked, fan_out
from patronlens.operators.labelled import checked_days, join_log_labels, label_pairs, with_day
from patronlens.operators.relational import attach_left
from patronlens.plans.tables import dropped, freed_shuffles, settled, staged, staged_together

# Log rows of a user or a seller that a task can hold; or a share of the log that is a task's anyway.
HOT_ROWS, HOT_SHARE = 1_000_000, 4096
# Repeats of a row that are made where it lies; rows repeated more often are spread first.
FEW = 32


def labelled_log(log: DataFrame, labels: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """The log of labelled pairs with its dates, as one lazy plan (for a single consumer)."""
    return join_log_labels(with_day(log, config), label_pairs(labels))


def by_user(labelled: DataFrame) -> DataFrame:
    """Even partitions, each holding whole users where they fit."""
    return labelled.hint("rebalance", "user_id")


def hot_keys(log: DataFrame, key: str) -> list:
    """Users or sellers with too many log rows for one task: ``HOT_SHARE`` of them at most."""
    with freed_shuffles(log.sparkSession):
        most = max(HOT_ROWS, log.count() // HOT_SHARE)
        rows = log.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
        return [r[key] for r in rows.where(F.col(key).isNotNull()).collect()]


def by_key(block: Callable[..., DataFrame], log: DataFrame, key: str, hot: Sequence, config: FeatureConfig) -> DataFrame:
    """A block for which the log is shuffled once by key, but for the hot keys, whose rows are
    spread over (key, value)."""
    if not hot:
        return block(log, config, whole=True)
    is_hot = F.coalesce(F.col(key).isin(list(hot)), F.lit(False))
    return block(log.where(~is_hot), config, whole=True).unionByName(block(log.where(is_hot), config))


def repeated(
    table: DataFrame, copies: str, by: Sequence[str], make: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    """``make`` of a staged table, each row ``copies`` times, and without that column.

    Like ``fan_out`` with ``by``, but only rows with many copies are shuffled, before ``make``, which
    must keep rows and ``copies``. The others are repeated where they lie.
    """
    n = F.col(copies)
    spread = chunked(table.where(n > FEW), copies, by)
    return fan_out(make(table.where(n <= FEW)), copies).unionByName(fan_out(make(spread), copies))


def _doubles(config: FeatureConfig) -> list[Column]:
    return [F.expr(f"CAST({c} AS DOUBLE) AS {c}") for c in config.full_columns()]


def _assemble(
    log: DataFrame, labels: DataFrame, info: DataFrame, config: FeatureConfig, pair_features
) -> DataFrame:
    """All blocks joined: one row per (pair, label), ``label_rows`` and ``copies`` as numbers.

    Stages: the label pairs; the labelled log, which the three blocks then read column by
    column; the user and seller blocks, small next to the pairs; the rows of pairs, without and
    with their sellers. With these staged, each join of the pairs has a plain shuffle on both
    sides, which adaptive execution can turn into a broadcast (small side) or split (a seller or
    user owning many pairs). The disk holds the shuffles of one stage at a time, and tables that
    are used up are deleted; so a log that itself comes out of joins is staged as well.

    The labelled log is rebalanced before it is written: a broadcast label join would leave a
    sliver of a file per task of the whole log. By user, because most facts are then complete
    before their shuffle; a user too large for one file is cut by adaptive execution.
    """
    pairs = staged(label_pairs(labels), "label_pairs")
    read = with_day(log, config)
    dated = settled(read, "dated_log")
    labelled = staged(checked_days(by_user(join_log_labels(dated, pairs)), config), "labelled_log")
    if config.restrict_to_labels and dated is not read:
        dropped(dated)
    seen = labelled if config.restrict_to_labels else checked_days(dated, config)
    hot = {key: hot_keys(seen, key) for key in PAIR_KEY}
    users, sellers = staged_together({
        "users": by_key(user_block, seen, "user_id", hot["user_id"], config).join(fill_profile(info), "user_id", "left"),
        "sellers": by_key(seller_block, seen, "seller_id", hot["seller_id"], config),
    })
    # A pair has no more rows than its user has.
    hot_users = hot["user_id"] if config.restrict_to_labels else hot_keys(labelled, "user_id")
    rows = staged(by_key(pair_features, labelled, "user_id", hot_users, config).join(pairs, PAIR_KEY, "inner"), "pair_rows")
    dropped(labelled, pairs)

    def with_sellers(df: DataFrame) -> DataFrame:
        kept = staged(df, "seller_rows")
        dropped(rows)
        return kept

    return attach_left(rows, users, sellers, between=with_sellers)


def full_features(
    log: DataFrame,
    labels: DataFrame,
    info: DataFrame,
    config: FeatureConfig = FeatureConfig(),
    repeats: str = "rows",
) -> DataFrame:
    """The wide feature table, all doubles, columns in ``config.full_columns()`` order.

    ``repeats="weight"`` keeps one row per (pair, label) and adds how often it stands in the
    table as a ``weight`` column: the same table in far fewer rows, and what MLlib's
    ``weightCol`` takes.
    """
    if repeats not in ("rows", "weight"):
        raise ValueError("repeats must be 'rows' or 'weight'")
    wide = _assemble(log, labels, info, config, pair_block)
    missing_gender = UNKNOWN_GENDER if config.corrected else UNKNOWN_AGE
    filled = wide.na.fill(0).na.fill({"age_range": UNKNOWN_AGE, "gender": missing_gender})
    weight = (F.col("label_rows") * F.col("copies")).alias("weight")
    table = filled.select(*_doubles(config), weight)
    return table if repeats == "weight" else repeated(staged(table, "weighted_rows"), "weight", PAIR_KEY)


def basic_features(
    log: DataFrame, labels: DataFrame, info: DataFrame, config: FeatureConfig = FeatureConfig()
) -> DataFrame:
    """The narrower table with its mixed types: no repeats per purchased seller.

    Users without a profile keep a null age and gender, and a missing label stays missing.
    """
    wide = _assemble(log, labels, info, config, basic_pair_block)
    return fan_out(wide.select(*config.basic_columns(), "label_rows"), "label_rows", by=PAIR_KEY)


def typed(features: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Any wide table as doubles in the fixed order."""
    return features.select(*_doubles(config))
