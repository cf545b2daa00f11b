"""From raw documents to token ids: language ID, toxicity, near-duplicates, mixing, BPE.

Each stage works on all rows the one before it kept and returns the columns of documents (the last
one token ids), written as Parquet and read again. Rows go for these reasons only: no language can
be told or explains the text, the text is toxic, another text of its class stays, or the mix does not take it. Rows that
the mix takes twice come twice.

Nulls: a null text has no language and goes; null languages are not learned from; null sources are
one source. Rows without an id stay once per class. An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.llm import bpe, langid, mixing, neardup, toxicity
from patronlens.llm.queries import tokenizer_path
from patronlens.plans.tables import staged

BPE_BLOCK = 8_000_000  # characters; half of op8_bpe's: the last stage runs in executors that four others have filled
CERTAIN = 0.5  # a language below this share of the odds is not certain
# Code length per byte, over that of the language's learned texts, above which no language explains a
# text: documents stay below 3.4 (short ones around a long key), letters drawn at random are above 6.
EXPLAINED = 5.0


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    trees = langid.fit(docs.select("doc_id", "text", "lang"))
    told = langid.predict(docs, trees, docs.columns, names=("_lang_pred", "_lang_score", "_excess"))
    sure = (F.col("_lang_pred") != langid.UNDETERMINED) & (F.col("_lang_score") >= CERTAIN) & (F.col("_excess") <= EXPLAINED)
    return told.where(sure).select(*docs.columns)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs.select("text"), docs.select("doc_id", "text").join(labels, "doc_id"))
    scored = toxicity.predict(docs, model, docs.columns, names=("_toxic_score", "_toxic"))
    return scored.where(F.col("_toxic") == 0).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    classed = neardup.near_duplicates(docs.select("doc_id", "text"))
    # The row with the smallest id of each class; of several texts under that id, one.
    stays = classed.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("class_key", "doc_id").agg(F.min("key").alias("_stays"))
    stays = stays.select(F.col("doc_id").alias("_id"), "_stays")
    keyed = docs.withColumn("_key", neardup.text_key())
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("_key").eqNullSafe(F.col("_stays"))
    return keyed.join(stays, same).dropDuplicates(["doc_id", "_key"]).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(docs, weights=[3, 1, 2], share=1.5, max_epochs=2.0, carry=docs.columns)
    taken = mixed.where(F.col("_repetitions") > 0)
    return taken.withColumn("_time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_repetitions")))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = bpe.encode_decode(docs.select("doc_id", "text"), tokenizer_path("word_bpe_49k.json"), block_chars=BPE_BLOCK)
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [("language", language), ("toxicity", toxic), ("near_duplicates", near_duplicates), ("mix", mix), ("bpe", encode)]

#: Models and signatures are beyond SQL; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
