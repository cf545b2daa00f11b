"""Mixing sources to target weights by capped water-filling.

Every source asks for a share of the words wanted in proportion to its weight. Sources that would
be read more than ``max_epochs`` times are clamped there and their excess goes to the others by
weight, again and again until no source is above. Each round is one aggregate over one row per
source; only the water level, one number, is on the driver.

A source is then taken in whole repetitions, and of the fraction left whole documents are taken in
a seeded hash order up to the one whose middle passes the fraction: the words taken are within one
document of the target. That choice is kept as one limit per source (the last hash taken), so it
is applied to the documents without a join on them.

A source whose whole repetitions meet its target gets no fraction, so no row, not even one without
words, is taken more than ``max_epochs`` times.

Null text: size 0. Null source: one source, last in order. No words at all: targets 0. Rows that
agree in doc_id and text are taken alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.llm.common import numbered
from patronlens.plans.tables import staged

WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Orders as the source by code point, null last."""
    return F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source))


def draw_key(seed: int) -> Column:
    text = F.coalesce(F.md5(F.col("text").cast("binary")), F.lit(""))
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text).cast("binary"))


def water_level(sources: DataFrame, wanted: Column) -> float:
    """The words per unit of weight at which the clamped targets add up to what is wanted."""
    level = 0.0
    budget = sources.agg(wanted).first()[0]
    while budget:
        clamped = F.col("cap") <= F.col("weight") * level
        held, free = sources.agg(
            F.coalesce(F.sum(F.when(clamped, F.col("cap"))), F.lit(0.0)), F.sum(F.when(~clamped, F.col("weight")))
        ).first()
        if not free:
            break
        higher = (budget - held) / free
        if higher <= level:
            break
        level = higher
    return level


def plan_mix(rows: DataFrame, weights: list[float], share: float, max_epochs: float) -> DataFrame:
    """Per source of rows (_source, _size, _draw): source_size, target, whole repetitions, last draw."""
    sizes = staged(rows.groupBy("_source").agg(F.sum("_size").alias("source_size")), "mix-sizes")
    ranked = numbered(sizes, None, ["_source"], [], "mix-sources")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("row") % len(weights) + 1).cast("int"))
    sources = ranked.select("_source", "source_size", weight.alias("weight"), (F.col("source_size") * float(max_epochs)).alias("cap"))
    level = water_level(sources, F.sum("source_size") * float(share))
    target = F.least("cap", F.col("weight") * level)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = staged(
        sources.withColumn("target", target).withColumn("_whole", epochs)
        .withColumn("_rest", F.col("target") - F.col("_whole") * F.col("source_size"))
        .select("_source", "source_size", "target", "_whole", "_rest"),
        "mix-plan",
    )
    drawn = numbered(rows, "_source", ["_draw", "_size"], ["_size"], "mix-drawn")
    last = (
        drawn.join(plan.where("_rest > 0"), "_source").where(F.col("before__size") + F.col("_size") / 2 <= F.col("_rest"))
        .groupBy("_source").agg(F.max("_draw").alias("_last"))
    )
    return staged(plan.drop("_rest").join(last, "_source", "left"), "mix-limits")


def mix_sources(
    docs: DataFrame,
    weights: list[float],
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = 17,
    carry: list[str] | None = None,
) -> DataFrame:
    """The rows of docs (doc_id, text, source) with _words, _source_words, _target and _repetitions.

    ``weights`` repeat over the sources in code point order; ``share`` is the words wanted, in
    parts of all words. ``carry`` names the columns to keep (doc_id by default).
    """
    carry = carry or ["doc_id"]
    keyed = docs.select(
        *carry, source_key(F.col("source")).alias("_source"), words(F.col("text")).alias("_size"), draw_key(seed).alias("_draw")
    )
    narrow = staged(keyed.select(*(c for c in carry if c != "text"), "_source", "_size", "_draw"), "mix-rows")
    plan = plan_mix(narrow.select("_source", "_size", "_draw"), weights, share, max_epochs)
    rows = keyed if "text" in carry else narrow
    taken = F.col("_whole") + (F.col("_draw") <= F.coalesce("_last", F.lit(""))).cast("long")
    plan = plan.select("_source", "_whole", "_last", F.col("source_size").alias("_source_words"), F.col("target").alias("_target"))
    return rows.join(plan, "_source").select(
        *carry, F.col("_size").alias("_words"), "_source_words", "_target", taken.alias("_repetitions")
    )
