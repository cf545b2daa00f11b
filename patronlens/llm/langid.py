"""Language ID by prediction by partial matching.

Per language, a tree of byte contexts up to three bytes long with the counts of the bytes that
followed. A byte's code length is that of the longest context seen in the language; a byte that is
new there costs the context's escape (PPM-C: distinct successors over successors plus distinct)
and is coded in the next shorter context, down to a uniform byte. Counts are frozen, nothing is
updated while scoring, and there is no exclusion. The language with the shortest code wins.

Because counts are frozen, the code length of every (context, byte) that any language has seen is
computed once; scoring looks up each byte of the whole text in that table. Bytes new in all
languages take the escape path.

The trees are fitted on a bounded sample: about ``fit_rows`` labelled rows a language (whole
texts), drawn by a hash of the id. A text's excess is its code length per byte over that of the
sample of its language: near 1 for its like, several times as much for what no language explains.
Null text or text without a letter: ``und``, score 0. Ties: the
first language by code point. No labelled rows, or an empty table of them: ``und`` for all. Repeated
rows are scored alike, and each is counted if the sample holds it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.llm.common import small_batches

FIT_ROWS = 2000
UNDETERMINED = "und"
PAD = 3  # empty bytes ahead of each text, so that every byte has a context
WINDOW = 1 << 19
SLOT_BITS = 20


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts as one array of bytes, each after PAD zeros, with starts and ends; null is empty."""
    texts = [b"" if t is None else t.encode() for t in column.to_pylist()]
    ends = np.cumsum([len(t) + PAD for t in texts], dtype=np.int64)
    starts = ends - np.array([len(t) for t in texts], dtype=np.int64)
    return np.frombuffer((b"\0" * PAD).join([b"", *texts]), np.uint8), starts, ends


def grams(data: np.ndarray) -> np.ndarray:
    """The byte at each place from PAD on with the three ahead of it, as one number."""
    d = data.astype(np.uint32)
    return d[:-3] << np.uint32(24) | d[1:-2] << np.uint32(16) | d[2:-1] << np.uint32(8) | d[3:]


def count_grams(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(lang, gram, n) over a bounded sample of rows (doc_id, text, lang)."""
    small_batches(labelled.sparkSession)
    labelled = labelled.where("text is not null and lang is not null")
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("_rows"))
    draw = F.crc32(F.concat(F.lit("fit:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    # One row per language: a label set.
    sample = labelled.join(F.broadcast(sizes), "lang").where(draw * F.col("_rows") < F.lit(fit_rows) * F.lit(float(1 << 32)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            for lang in sorted(set(langs)):
                texts = batch.column(1).filter(pa.array(langs == lang))
                for at in range(0, len(texts), 64):
                    data, starts, ends = text_bytes(texts.slice(at, 64))
                    if len(data) <= PAD:
                        continue
                    inside = np.zeros(len(data) + 1, np.int8)
                    np.add.at(inside, starts, 1)
                    np.add.at(inside, ends, -1)
                    keys, n = np.unique(grams(data)[np.cumsum(inside)[PAD:-1] > 0], return_counts=True)
                    yield pa.RecordBatch.from_pydict({"lang": [lang] * len(keys), "gram": keys.astype(np.int64), "n": n.astype(np.int64)})

    counted = sample.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Trees:
    """Code lengths, in bits, of every byte in every context, for each language."""

    def __init__(self, langs: list[str], counts: list[tuple[np.ndarray, np.ndarray]]):
        self.langs = langs
        k = len(langs)
        self.grams = np.unique(np.concatenate([g for g, _ in counts])) if k else np.zeros(0, np.uint32)
        by_order = {}
        for order in (0, 1, 2, 3):
            mask = np.uint32((1 << 8 * (order + 1)) - 1)
            seen = np.unique(self.grams & mask)
            contexts = np.unique(seen >> np.uint32(8))
            escape = np.zeros((len(contexts), k))
            bits = np.full((len(seen), k), np.nan)
            for j, (gram, n) in enumerate(counts):
                keys, inverse = np.unique(gram & mask, return_inverse=True)
                total = np.bincount(inverse, weights=n)
                at = np.searchsorted(contexts, keys >> np.uint32(8))
                successors = np.bincount(at, minlength=len(contexts)).astype(float)
                sums = np.bincount(at, weights=total, minlength=len(contexts)) + successors
                known = sums > 0
                escape[known, j] = -np.log2(successors[known] / sums[known])
                bits[np.searchsorted(seen, keys), j] = -np.log2(total / sums[at])
            shorter = self._shorter(seen, by_order, order, k)
            new = escape[np.searchsorted(contexts, seen >> np.uint32(8))] + shorter
            by_order[order] = (seen, np.where(np.isnan(bits), new, bits), contexts, escape)
        self.by_order = by_order
        self.bits = by_order[3][1].astype(np.float32)
        weight = np.zeros(len(self.grams))
        self.usual = np.ones(k)  # bits per byte of the texts learned from
        for j, (gram, n) in enumerate(counts):
            at = np.searchsorted(self.grams, gram)
            weight[at] += n
            self.usual[j] = max((n * by_order[3][1][at, j]).sum() / n.sum(), 1e-3)
        self.slot = np.full(1 << SLOT_BITS, -1, np.int32)
        common_last = np.argsort(weight, kind="stable")
        self.slot[self._hash(self.grams[common_last])] = common_last

    @staticmethod
    def _hash(grams: np.ndarray) -> np.ndarray:
        return (grams * np.uint32(0x9E3779B1)) >> np.uint32(32 - SLOT_BITS)

    @staticmethod
    def _shorter(grams: np.ndarray, by_order: dict, order: int, k: int) -> np.ndarray:
        """Code lengths of the grams' last bytes in contexts one byte shorter than ``order``."""
        if order == 0:
            return np.full((len(grams), k), 8.0)
        mask = np.uint32((1 << 8 * order) - 1)
        short = grams & mask
        seen, bits, contexts, escape = by_order[order - 1]
        out = np.zeros((len(grams), k))
        at = np.minimum(np.searchsorted(seen, short), max(len(seen) - 1, 0))
        hit = seen[at] == short if len(seen) else np.zeros(len(short), bool)
        out[hit] = bits[at[hit]]
        if not hit.all():
            rest = short[~hit]
            where = np.minimum(np.searchsorted(contexts, rest >> np.uint32(8)), max(len(contexts) - 1, 0))
            known = contexts[where] == rest >> np.uint32(8) if len(contexts) else np.zeros(len(rest), bool)
            cost = np.where(known[:, None], escape[where] if len(contexts) else 0.0, 0.0)
            out[~hit] = cost + Trees._shorter(rest, by_order, order - 1, k)
        return out

    def lengths(self, grams: np.ndarray) -> np.ndarray:
        """(bytes, languages) code lengths; the last byte of each gram in the context of the rest."""
        at = self.slot[self._hash(grams)]
        hit = self.grams[at] == grams
        out = np.take(self.bits, at, axis=0)
        if not hit.all():  # displaced in the hash table, or new
            out[~hit] = self._shorter(grams[~hit], self.by_order, 4, len(self.langs))
        return out

    def score(self, column: pa.Array) -> np.ndarray:
        """(texts, languages) code lengths of whole texts."""
        data, starts, ends = text_bytes(column)
        out = np.zeros((len(starts), len(self.langs)))
        for at in range(0, max(len(data) - PAD, 0), WINDOW):
            keys = grams(data[at : at + WINDOW + PAD])
            lo, hi = at + PAD, at + PAD + len(keys)
            first, last = np.searchsorted(ends, lo, side="right"), np.searchsorted(starts, hi)
            if first == last:
                continue
            bits = self.lengths(keys)
            for i in range(first, last):
                a, b = max(starts[i], lo) - lo, min(ends[i], hi) - lo
                if a < b:
                    out[i] += bits[a:b].sum(axis=0, dtype=np.float64)
        return out


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> Trees:
    """Trees from rows (doc_id, text, lang); the counts are bounded by the sample."""
    counts = count_grams(labelled, fit_rows).toArrow().to_pandas()
    langs = sorted(counts["lang"].unique(), key=lambda x: x.encode())
    by_lang = []
    for lang in langs:
        mine = counts[counts["lang"] == lang].sort_values("gram")
        by_lang.append((mine["gram"].to_numpy().astype(np.uint32), mine["n"].to_numpy().astype(float)))
    return Trees(langs, by_lang)


def predict(docs: DataFrame, trees: Trees, keep: list[str], names: tuple[str, ...] = ("lang_pred", "score")) -> DataFrame:
    """Columns ``keep`` of docs with the language and its score: the share of the winner if each
    language had the odds of its code length. ``names`` are those of the new columns; with a third
    there is also the text's excess (null if undetermined)."""
    langs = trees.langs
    if not langs:
        added = [F.lit(UNDETERMINED), F.lit(0.0), F.lit(None).cast("double")]
        return docs.select(*keep, *(c.alias(n) for c, n in zip(added, names, strict=False)))
    types = zip(names, (T.StringType(), T.DoubleType(), T.DoubleType()), strict=False)
    schema = T.StructType([*docs.select(*keep).schema.fields, *(T.StructField(*x) for x in types)])
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    read = keep if "text" in keep else [*keep, "text"]
    at = read.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        languages = np.array(model.langs, dtype=object)
        for whole in batches:
            for first in range(0, whole.num_rows, 256):
                batch = whole.slice(first, 256)
                bits = model.score(batch.column(at))
                odds = np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000.0))
                some = batch.column(len(read)).to_numpy(zero_copy_only=False)
                lang = np.where(some, languages[bits.argmin(axis=1)], UNDETERMINED)
                score = np.where(some, 1.0 / odds.sum(axis=1), 0.0)
                size = np.maximum(batch.column(len(read) + 1).to_numpy(zero_copy_only=False), 1)
                excess = bits.min(axis=1) / size / model.usual[bits.argmin(axis=1)]
                added = [pa.array(lang, pa.string()), pa.array(score), pa.array(excess, mask=~some)]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *added[: len(names)]], names=schema.names)

    size = F.coalesce(F.octet_length("text"), F.lit(0))
    return docs.select(*read, letters.alias("_letters"), size.alias("_bytes")).mapInArrow(run, schema)
