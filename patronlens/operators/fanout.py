"""Repeat rows by a count held in a column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Copies made per array: bounds the memory of one row, whatever its count, and the share of one
# row that stays in a task when chunks are spread.
_CHUNK = 256


def chunked(df: DataFrame, copies: str, by: Sequence[str]) -> DataFrame:
    """Each row as rows of at most ``_CHUNK`` copies, the count column saying how many, spread by the
    columns ``by`` and the number of the chunk. Rows with 0 or null vanish."""
    chunks = F.expr(f"sequence(0L, ({copies} - 1) div {_CHUNK})")
    within = F.expr(f"CAST(least({_CHUNK}L, {copies} - _chunk * {_CHUNK}) AS INT)")
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = df.filter(F.col(copies) > 0).withColumn("_chunk", F.explode(chunks)).repartition(tasks, *by, "_chunk")
    return spread.withColumn(copies, within).drop("_chunk")


def fan_out(df: DataFrame, copies: str, by: Sequence[str] = ()) -> DataFrame:
    """Each row ``copies`` times; the count column is dropped. Rows with 0 or null vanish.

    The repeats are produced in chunks, so even a count in the billions never builds one long
    array. With ``by``, chunks are spread by these columns and the chunk number before they are
    repeated: a key whose rows repeat most then leaves every task an even share. That is one
    shuffle of a row per chunk; its partitions are not merged, since their size before the
    repeats says nothing about what they make. Without ``by`` there is no shuffle.
    """
    if by:
        few = chunked(df, copies, by)
        return few.withColumn("_copy", F.explode(F.expr(f"sequence(1, {copies})"))).drop(copies, "_copy")
    chunks = F.expr(f"sequence(0L, ({copies} - 1) div {_CHUNK})")
    within = F.expr(f"sequence(1, CAST(least({_CHUNK}L, {copies} - _chunk * {_CHUNK}) AS INT))")
    return (
        df.filter(F.col(copies) > 0).withColumn("_chunk", F.explode(chunks))
        .withColumn("_copy", F.explode(within))
        .drop(copies, "_chunk", "_copy")
    )
