"""Train/test split and folds decided by the pair, not by the row's place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.config import PAIR_KEY
from patronlens.operators.fanout import fan_out

# Share of training rows in percent and the split seed.
TRAIN_PERCENT = 80
SPLIT_SEED = 504

RANKS = 4096  # ranks hashed at a time


def pair_hash(seed: int, keys: list[str] = PAIR_KEY) -> Column:
    """The first 32 bits of an MD5 over the pair and the seed, as a long."""
    text = F.concat_ws("|", *[F.col(k).cast("long").cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def keyed_split(
    df: DataFrame, percent: int = TRAIN_PERCENT, seed: int = SPLIT_SEED
) -> DataFrame:
    """Add ``split`` = 'train' or 'test'.

    The same pair always falls on the same side, whatever the partitioning, so repeated rows
    of a pair never leak from one side to the other.
    """
    side = F.when(pair_hash(seed) % 100 < percent, "train").otherwise("test")
    return df.withColumn("split", side)


def with_fold(df: DataFrame, folds: int, seed: int = SPLIT_SEED, name: str = "fold") -> DataFrame:
    """Add a fold number 0..folds-1 that keeps all rows of a pair in one fold."""
    return df.withColumn(name, (pair_hash(seed + 1) % folds).cast("int"))


def row_hash(columns: list[str], rank: Column, seed: int) -> Column:
    """The first 32 bits of an MD5 over a row's values, its rank among equal rows and the seed."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    text = F.concat_ws("|", *values, rank.cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def row_split(
    df: DataFrame, percent: int = TRAIN_PERCENT, seed: int = SPLIT_SEED, weight: str | None = None
) -> DataFrame:
    """Row-wise split: every distinct row with ``train_rows`` and ``test_rows``, how many of its
    copies fall on each side.

    Equal rows are counted and told apart by their rank, 0, 1, 2, ...; the side of a copy is a hash of
    the row, its rank and the seed, so it depends on nothing else, least of all on places. With
    ``weight`` a row stands for so many. Ranks come in chunks that are spread over the tasks, so a
    row repeated without end is nobody's burden, and no copy is carried further than its hash.
    """
    columns = [c for c in df.columns if c != weight]
    counted = df.groupBy(*columns).agg(F.sum(F.lit(1) if weight is None else F.col(weight)).cast("long").alias("_rows"))
    first = F.explode(F.expr(f"sequence(0L, _rows - 1, {RANKS}L)")).alias("_first")
    chunks = counted.where("_rows > 0").select("*", first).repartition(*columns, "_first")
    ranks = F.sequence(F.col("_first"), F.least(F.col("_first") + RANKS, F.col("_rows")) - 1)
    hits = F.size(F.filter(ranks, lambda i: row_hash(columns, i, seed) % 100 < percent)).cast("long")
    sides = chunks.select(*columns, hits.alias("train_rows"), (F.size(ranks).cast("long") - hits).alias("test_rows"))
    return sides.groupBy(*columns).agg(F.sum("train_rows").alias("train_rows"), F.sum("test_rows").alias("test_rows"))


def random_split(
    df: DataFrame, percent: int = TRAIN_PERCENT, seed: int = SPLIT_SEED
) -> tuple[DataFrame, DataFrame]:
    """The row-wise random split into (train, test): the same rows whatever the partitioning.

    Repeated rows of a pair may fall on both sides; ``keyed_split`` keeps them together.
    """
    sides = row_split(df, percent, seed)
    train, test = (fan_out(sides.drop(other), own, by=df.columns) for own, other in (("train_rows", "test_rows"), ("test_rows", "train_rows")))
    return train, test
