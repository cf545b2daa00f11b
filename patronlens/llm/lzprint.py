"""Lempel-Ziv phrase fingerprints.

A text is parsed into the phrases of an incremental dictionary (each the longest known phrase plus
one character). The set of phrases is hashed and reduced to minimum hashes: one permutation in
``BINS`` bins, empty bins filled from the next full one. The share of equal bins estimates the
likeness of two phrase sets, as shared phrases do in compression distances.

Equal texts have equal fingerprints. Null is the empty text; empty texts are alike.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

from patronlens.llm.common import U64, mix, small_batches, span_hashes

BINS = 128
_EDGES = np.arange(BINS, dtype=U64) << U64(64 - 7)


def parse(text: str, seen: set[str], lengths: list[int], open_phrase: str = "") -> str:
    """Add the phrases of the text to ``seen`` and ``lengths``; the phrase left open at its end."""
    w, add, done = open_phrase, seen.add, lengths.append
    for c in text:
        w += c
        if w not in seen:
            add(w)
            done(len(w))
            w = ""
    return w


def signature(text: str, lengths: list[int]) -> np.ndarray:
    """Minimum hashes of the phrases of a text, which follow one another; an open one counts."""
    ends = np.cumsum(lengths, dtype=np.int64)
    if len(text) > (ends[-1] if len(ends) else 0):
        ends = np.append(ends, len(text))
    if not len(ends):
        return np.zeros(BINS, np.uint16)
    starts = np.concatenate([[0], ends[:-1]])
    h = np.sort(span_hashes(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), starts, ends))
    at = np.searchsorted(h, _EDGES)
    value = h[np.minimum(at, len(h) - 1)]
    full = (at < len(h)) & (value >> U64(64 - 7) == np.arange(BINS, dtype=U64))
    where = np.flatnonzero(full)
    source = where[np.searchsorted(where, np.arange(BINS)) % len(where)]
    distance = ((source - np.arange(BINS)) % BINS).astype(U64)
    return (mix(value[source] + distance * U64(0x9E3779B97F4A7C15)) & U64(0xFFFF)).astype(np.uint16)


def fingerprint(text: str) -> np.ndarray:
    lengths: list[int] = []
    parse(text, set(), lengths)
    return signature(text, lengths)


def as_text(sig: np.ndarray) -> str:
    return sig.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """docs with the fingerprint of every whole text; an existing column ``out`` is replaced."""
    kept = docs.drop(out) if out != text else docs
    schema = StructType([*kept.schema.fields, StructField(out, StringType())])
    at = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [as_text(fingerprint(t or "")) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints, pa.string())], names=schema.names)

    return kept.mapInArrow(run, schema)


def both_signatures(text: str, following: str) -> tuple[np.ndarray, np.ndarray, str]:
    """Signatures of a text and of its edit, and the edit: the last half of the text (rounded down)
    replaced by as many characters from the start of ``following``. What they share is parsed once."""
    half = len(text) // 2
    shared = len(text) - half
    edited = text[:shared] + following[:half]
    seen: set[str] = set()
    lengths: list[int] = []
    left = parse(text[:shared], seen, lengths)
    seen2, lengths2 = set(seen), list(lengths)
    parse(text[shared:], seen, lengths, left)
    parse(following[:half], seen2, lengths2, left)
    return signature(text, lengths), signature(edited, lengths2), edited


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_with_next(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """Every text of docs (doc_id, text) against its edited text and the next document, by
    descending doc_id (the first follows the last; null ids come last; rows of one id in the order
    of their texts).

    One shuffle of the texts, into runs of consecutive ids; each run also gets the first document
    of the run after it. The driver holds one id per run.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    runs = partitions or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / runs for i in range(1, runs)] or [0.5]
    found = rows.agg(F.percentile_approx("doc_id", shares, max(10_000, 10 * runs)).alias("cuts")).first()["cuts"]
    cuts = sorted(set(found or [])) if runs > 1 else []
    above = F.size(F.filter(F.array(*(F.lit(int(c)) for c in cuts)), lambda c: c > F.col("doc_id"))) if cuts else F.lit(0)
    part = F.when(F.col("doc_id").isNull(), len(cuts)).otherwise(above).cast("int")
    placed = rows.withColumn("part", part)

    heads = sorted(placed.groupBy("part").agg(F.max("doc_id").alias("doc_id")).collect())  # one row per run
    if not heads:
        return spark.createDataFrame([], SCHEMA)
    before = [(r["part"], r["doc_id"], heads[i - 1]["part"]) for i, r in enumerate(heads)]
    ahead = F.broadcast(spark.createDataFrame(before, "p int, head long, before int"))
    tails = (
        placed.join(ahead, (F.col("part") == F.col("p")) & F.col("doc_id").eqNullSafe(F.col("head")))
        .groupBy("p", "before").agg(F.first("doc_id").alias("doc_id"), F.min("text").alias("text"))
        .select("doc_id", "text", F.col("before").alias("part"), F.lit(1).alias("tail"))
    )
    ordered = (
        placed.withColumn("tail", F.lit(0)).unionByName(tails).repartitionById(len(cuts) + 1, F.col("part"))
        .sortWithinPartitions("part", "tail", F.col("doc_id").desc_nulls_last(), "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
        pending = held = None  # the document read last, and the one whose next is being compared
        for batch in batches:
            out: list[tuple] = []
            for key, text, tail in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                mine = None
                if pending is not None:
                    mine = both_signatures(pending[1], text)
                    if held is not None:
                        out.append((*held[:-1], likeness(held[-1], mine[0])))
                    sig, edit, edited = mine
                    held = (pending[0], len(pending[1]), hashlib.sha256(edited.encode()).hexdigest(), as_text(sig), as_text(edit), likeness(sig, edit), sig)
                pending = (key, text)
                if tail:
                    out.append((*held[:-1], likeness(held[-1], fingerprint(text))))
                    pending = held = None
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)] if out else [pa.array([], k) for k in kinds], names=names)

    return ordered.mapInArrow(run, SCHEMA)
