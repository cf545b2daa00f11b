"""One query per operator, over whole tables: (spark, folder of tables) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.llm import annscan, bpe, convtrie, filteraudit, langid, lzprint, mincut, mixing, neardup, sharding, toxicity, warc, wavelet
from patronlens.llm.common import remainder, table
from patronlens.llm.oracles import ORACLES
from patronlens.plans.tables import table_path


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_lzprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lzprint.compare_with_next(table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annscan.search(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 20 == 0, k=20)


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    mixed = mixing.mix_sources(docs, weights=[3, 1, 2], share=1.5, max_epochs=2.0)
    return mixed.select(
        "doc_id", F.col("_words").alias("size"), F.col("_source_words").alias("source_size"), F.col("_target").alias("target"),
        (F.col("_words") * F.col("_repetitions")).alias("taken"),
    )


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    trees = langid.fit(docs.where(~held_out))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return langid.predict(rows, trees, ["doc_id", "held_out"])


def op5_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = table_path(spark, "wavelet")
    wavelet.write_shards(table(spark, sf_dir, "documents", "doc_id", "text"), path, tokenizer_path("byte_bpe_50k.json"), end=2)
    return wavelet.read_shards(spark, path)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = table_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages", "page_id", "url", "html"), path, min_bytes=0)
    return warc.parsed(warc.read_archive(spark, path)).select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
        warc.base32(F.sha1("payload")).alias("payload_digest"), "record_type", "refers_to",
    )


def op7_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"), shards=24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.encode_decode(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path("word_bpe_49k.json"))
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic").where(~held_out)
    model = toxicity.fit(docs, docs.join(labels, "doc_id"))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return toxicity.predict(rows, model, ["doc_id", "held_out"])


def op10_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classed = neardup.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return classed.select("doc_id", "class_id")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convtrie.trie(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mincut.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"), ["page_id", "url"])


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    return filteraudit.audit(filteraudit.mask_counts(docs, labels))


QUERIES = {
    "op1_lzprint": op1_lzprint,
    "op2_ann": op2_ann,
    "op3_mix": op3_mix,
    "op4_language": op4_language,
    "op5_wavelet": op5_wavelet,
    "op6_warc": op6_warc,
    "op7_shard": op7_shard,
    "op8_bpe": op8_bpe,
    "op9_toxicity": op9_toxicity,
    "op10_neardup": op10_neardup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_main_text": op12_main_text,
    "op13_filter_audit": op13_filter_audit,
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
