"""Near-duplicate documents by improved consistent weighted sampling.

A text is the bag of its shingles, ``words`` lower-case words each (one shingle of all words if it
has fewer), weighted by how often it has them and by how rare they are over all documents. A
signature holds ``bands * rows`` consistent weighted samples: two texts agree in one of them with
the probability of their weighted Jaccard similarity. Texts that agree in a whole band share a
bucket; candidates are verified by the exact weighted Jaccard similarity of their whole texts.

Rarity is 1 + ln((N + 1) / (df + 1)) / ln(N + 1), from 1 for a shingle of every document to 2:
the scale keeps large groups of copies, which make their own shingles frequent, above the
threshold. Document frequencies are counted over all documents, per shingle hash cut to as many bits as
tell apart 4,096 times as many shingles as the input has characters. Texts are packed in blocks, squeezed;
a block sends the distinct hashes it holds, once each, to slices of the hash range, and gets its
frequencies back in the same order, so a common shingle costs a hash a block. The
frequencies of a text's shingles are kept beside it for the exact check.

Within a bucket all texts are compared with one of them, drawn anew in each bucket and round, unless
the links found so far connect the two already: a group of n near copies costs n comparisons a
bucket and round, not n * n, and falls into few pieces. What is then left in several pieces is
compared piece against piece, in blocks that carry their texts: pairs whose signatures do not rule
out the threshold are verified in the same task, unless links found there have made their pieces
one, and each pair in the first bucket it shares only. No bucket is capped.

Equal texts are one text from the start (they share a class without comparison). Null text:
a class of its own per row. Text without words: equal to equal texts only. A class is a connected
set of verified links; its id is the smallest doc_id in it.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.llm.common import U64, drop, mix, small_batches, span_hashes, with_room
from patronlens.plans.tables import staged

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 14, 4
DF_BITS = 20
SLICES = 256  # at least; so many of the hash range that one holds the shingles of about SLICE_CHARS
SLICE_CHARS = 1 << 23
TABLE_BITS = 14  # variates per sample; a shingle picks its own by hash
CHUNK = 1 << 20
PACK = 1 << 22  # characters of a block of texts
BLOCK = 4096  # texts of a block of a bucket, and
BLOCK_CHARS = 1 << 22  # characters
LEAD_ROUNDS = 2
SLACK = 0.2  # a signature rules a pair out when it agrees this far below the threshold (almost 4 sigma)


def shingles(texts: list[str | None], words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text number, shingle hash) in order, with counts, of all texts at once."""
    starts, ends, owner = [], [], []
    parts, at = [], 0
    for i, t in enumerate(texts):
        w = t.lower().split() if t else []
        if not w:
            continue
        raw = " ".join(w).encode()
        data = np.frombuffer(raw, np.uint8)
        gaps = np.flatnonzero(data == 32)
        first = np.concatenate([[0], gaps + 1])
        last = np.concatenate([gaps, [len(data)]])
        n = max(len(first) - words + 1, 1)
        starts.append(first[:n] + at)
        ends.append(last[min(words, len(last)) - 1 :][:n] + at)
        owner.append(np.full(n, i, np.int64))
        parts.append(data)
        at += len(data)
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, np.int64)
    owner = np.concatenate(owner)
    h = span_hashes(np.concatenate(parts), np.concatenate(starts), np.concatenate(ends))
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(fresh)
    return owner[at], h[at], np.diff(np.append(at, len(h)))


def runs(texts: list[str | None], most: int = CHUNK) -> Iterator[tuple[int, int, list]]:
    """Runs of texts that are about ``most`` characters together."""
    first = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= most:
            yield first, i + 1, texts[first : i + 1]
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts), texts[first:]


def document_frequencies(docs: DataFrame, words: int, df_bits: int) -> np.ndarray:
    """Documents per cell of the shingle hash: each task counts its own, cells are summed by slice.

    Shingles of one cell are one here, so this is for inputs with far fewer shingles than cells;
    ``near_duplicates`` counts them apart (``counted``)."""
    cells = 1 << df_bits
    width = max(cells // SLICES, 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64)
        for batch in batches:
            for _, _, texts in runs(batch.column(0).to_pylist()):
                owner, h, _ = shingles(texts, words)
                cell = (h >> U64(64 - df_bits)).astype(np.int64)
                total += np.bincount(np.unique(owner << df_bits | cell) & (cells - 1), minlength=cells)
        if total.any():
            yield pa.RecordBatch.from_pydict({"slice": np.arange(cells // width, dtype=np.int32), "body": [x.tobytes() for x in total.astype("<u4").reshape(-1, width)]}, schema=pa.schema([("slice", pa.int32()), ("body", pa.binary())]))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                one = np.frombuffer(body, "<u4" if len(body) == 4 * width else "<i8").astype(np.int64)
                total[s] = total[s] + one if s in total else one
        if total:
            yield pa.RecordBatch.from_pydict({"slice": list(total), "body": [x.astype("<i8").tobytes() for x in total.values()]}, schema=pa.schema([("slice", pa.int32()), ("body", pa.binary())]))

    rows = docs.select("text").mapInArrow(with_room(count), "slice int, body binary").repartition("slice").mapInArrow(with_room(add), "slice int, body binary")
    out = np.zeros(cells, np.int64)
    for r in rows.collect():  # one row per slice: 2**df_bits numbers
        out[r["slice"] * width : (r["slice"] + 1) * width] = np.frombuffer(r["body"], "<i8")
    return out


def squeezed(texts: pa.Array) -> bytes:
    """A run of texts, compressed together."""
    batch = pa.RecordBatch.from_arrays([texts], names=["t"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return zstandard.ZstdCompressor(level=1).compress(sink.getvalue())


def unsqueezed(body: bytes) -> list[str]:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(body)).read_all().column(0).to_pylist()


def packed_texts(docs: DataFrame) -> DataFrame:
    """Rows with a text in blocks of about PACK characters: (block, n, chars, doc_ids, keys, texts),
    the texts squeezed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in runs(batch.column(2).to_pylist(), PACK):
                lists = [pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), batch.column(c).slice(lo, hi - lo)) for c in range(2)]
                head = [pa.array([uuid.uuid4().hex]), pa.array([hi - lo]), pa.array([sum(map(len, texts))])]
                body = pa.array([squeezed(batch.column(2).slice(lo, hi - lo))], pa.binary())
                yield pa.RecordBatch.from_arrays([*head, *lists, body], names=["block", "n", "chars", "doc_ids", "keys", "texts"])

    rows = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), "text")
    return rows.mapInArrow(with_room(run), "block string, n long, chars long, doc_ids array<long>, keys array<string>, texts binary")


def block_shingles(texts: list[str], words: int) -> tuple[list, np.ndarray, np.ndarray]:
    """Bags of a block's runs (first row, end, owner, hash, count), its distinct hashes in order,
    and how many of its texts have each."""
    bags = [(lo, hi, *shingles(some, words)) for lo, hi, some in runs(texts)]
    h, n = np.unique(np.concatenate([b[3] for b in bags] or [np.zeros(0, U64)]), return_counts=True)
    return bags, h, n


def squeezed_cells(cells: np.ndarray) -> bytes:
    """Distinct cells in order: their steps byte by byte, of which the high ones are zeros."""
    steps = np.diff(cells, prepend=cells.dtype.type(0))
    return zstandard.ZstdCompressor(level=1).compress(steps.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes())


def unsqueezed_cells(body: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8)
    return np.cumsum(raw.reshape(8, -1).T.copy().view(U64)[:, 0], dtype=U64)


def cell_bits(chars: int) -> int:
    """Bits of a shingle's hash that tell it apart when documents are counted: 4,096 cells a character
    of the input, so that at any size not one shingle in ten thousand meets another's cell."""
    return min(64, max(32, int(chars).bit_length() + 12))


def counted(packed: DataFrame, words: int, slices: int, bits: int = 64) -> DataFrame:
    """(block, slice, df): for each block the document frequencies, over all blocks, of the distinct
    shingle hashes it holds, in order, a slice of the hash range at a time. Hashes travel as the
    first ``bits`` bits."""
    cut = U64(64 - bits)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                _, h, n = block_shingles(unsqueezed(batch.column(1)[i].as_py()), words)
                at = ((h >> U64(40)) * U64(slices) >> U64(24)).astype(np.int64)
                cuts = np.searchsorted(at, np.arange(slices + 1))
                held = np.flatnonzero(np.diff(cuts))
                columns = [squeezed_cells(h[cuts[s] : cuts[s + 1]] >> cut) for s in held]
                counts = [zlib.compress(n[cuts[s] : cuts[s + 1]].astype("<u4").tobytes(), 1) for s in held]
                block = pa.array([batch.column(0)[i].as_py()] * len(held), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), block, pa.array(columns, pa.binary()), pa.array(counts, pa.binary())], names=["slice", "block", "h", "n"])

    def total(slice_: int, blocks: list[str], h: list[bytes], n: list[bytes]) -> pa.RecordBatch:
        each = [unsqueezed_cells(x) for x in h]
        counts = np.frombuffer(b"".join(map(zlib.decompress, n)), "<u4")
        _, at = np.unique(np.concatenate(each), return_inverse=True)
        df = np.bincount(at, weights=counts).astype("<u4")[at]
        ends = np.cumsum([len(x) for x in each])
        bodies = [zlib.compress(x.tobytes(), 1) for x in np.split(df, ends[:-1])]
        return pa.RecordBatch.from_arrays([pa.array(blocks), pa.array([slice_] * len(each), pa.int32()), pa.array(bodies, pa.binary())], names=["block", "slice", "df"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, ([], [], [])
        for batch in batches:
            for s, *row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if s != now and held[0]:
                    yield total(now, *held)
                    held = ([], [], [])
                now = s
                for column, value in zip(held, row, strict=True):
                    column.append(value)
        if held[0]:
            yield total(now, *held)

    sent = packed.select("block", "texts").mapInArrow(with_room(send), "slice int, block string, h binary, n binary")
    return sent.repartition(max(1, slices // 4), "slice").sortWithinPartitions("slice").mapInArrow(with_room(add), "block string, slice int, df binary")


def frequencies(body: bytes | None) -> np.ndarray:
    return np.frombuffer(zlib.decompress(body), "<u4") if body else np.zeros(0, "<u4")


class Sampler:
    """Weights, signatures and bands of texts."""

    def __init__(self, df: np.ndarray | None, documents: int, words: int, bands: int, rows: int, seed: int = 7):
        """``df``: documents per cell of the shingle hash, for texts that come without frequencies."""
        self.words, self.bands, self.rows = words, bands, rows
        self.df, self.documents = df, documents
        rng = np.random.default_rng(seed)
        m, k = bands * rows, 1 << TABLE_BITS
        gamma = lambda: -np.log(rng.random((m, k))) - np.log(rng.random((m, k)))
        self.r, self.log_c, self.beta = gamma(), np.log(gamma()), rng.random((m, k))
        self.odd = rng.integers(0, 1 << 63, m, dtype=U64) * U64(2) + U64(1)

    def rarity(self, df: np.ndarray) -> np.ndarray:
        if not self.documents:
            return np.ones(len(df))
        return 1.0 + np.log((self.documents + 1) / (np.minimum(df, self.documents) + 1.0)) / np.log(self.documents + 1.0)

    def of_cells(self, h: np.ndarray) -> np.ndarray:
        bits = int(len(self.df)).bit_length() - 1
        return self.df[(h >> U64(64 - bits)).astype(np.int64)]

    def weighted(self, texts: list[str | None], df: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text numbers, hashes and weights; ``df`` has the document frequencies in that order."""
        owner, h, n = shingles(texts, self.words)
        return owner, h, n * self.rarity(self.of_cells(h) if df is None else df)

    def sign(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(texts, samples) signatures and the number of distinct shingles; zeros without words."""
        owner, h, n = shingles(texts, self.words)
        return self.sign_bags(len(texts), owner, h, n, self.of_cells(h))

    def sign_bags(self, texts: int, owner: np.ndarray, h: np.ndarray, n: np.ndarray, df: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m = self.bands * self.rows
        out = np.zeros((texts, m), U64)
        count = np.bincount(owner, minlength=texts)
        if not len(h):
            return out, count
        log_s = np.log(n) + np.log(self.rarity(df))
        # One weight, that of a shingle of its own, is by far the most frequent. What a sample makes of
        # it depends on the hash's place in the table alone and is worked out once.
        common = float(np.log(self.rarity(np.ones(1, np.int64)))[0])
        rest = np.flatnonzero(log_s != common)
        log_rest = log_s[rest]
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        size = np.diff(np.append(first, len(h)))
        rows = owner[first]
        for j in range(m):
            at = ((h * self.odd[j]) >> U64(64 - TABLE_BITS)).astype(np.int64)
            t_common, a_common = self.variates(j, slice(None), common)
            t, a = t_common[at], a_common[at]
            t[rest], a[rest] = self.variates(j, at[rest], log_rest)
            least = np.repeat(np.minimum.reduceat(a, first), size)
            hits = np.flatnonzero(a == least)  # ties: the smallest hash, which comes first
            who = owner[hits]
            pick = hits[np.concatenate([[True], who[1:] != who[:-1]])]
            out[rows, j] = mix(h[pick] + t[pick].astype(np.int64).astype(U64) * U64(0x9E3779B97F4A7C15))
        return out, count

    def variates(self, j: int, at, log_s) -> tuple[np.ndarray, np.ndarray]:
        """The level and the value of sample ``j`` at places ``at`` of its table, for log weights."""
        r, beta = self.r[j][at], self.beta[j][at]
        t = np.floor(log_s / r + beta)
        return t, self.log_c[j][at] - r * (t - beta + 1.0)

    def band_keys(self, signatures: np.ndarray) -> np.ndarray:
        keys = np.zeros((len(signatures), self.bands), U64)
        for b in range(self.bands):
            k = np.full(len(signatures), b + 1, U64)
            for j in range(b * self.rows, (b + 1) * self.rows):
                k = mix(k * U64(0xD6E8FEB86659FD93) + signatures[:, j])
            keys[:, b] = k
        return keys.view(np.int64)

    def similarity(self, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
        """Exact weighted Jaccard similarity of two bags (hashes in order, weights)."""
        _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
        both = np.minimum(a[1][i], b[1][j]).sum()
        either = a[1].sum() + b[1].sum() - both
        return float(both / either) if either else 0.0


def text_key():
    """128 bits of the text's SHA-256: equal texts are one."""
    return F.substring(F.sha2(F.col("text").cast("binary"), 256), 1, 32)


def signed_texts(packed: DataFrame, dfs: DataFrame, sampler) -> DataFrame:
    """(doc_id, key, signature, bands, df) of every row with a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = sampler.value
        for batch in batches:
            for i in range(batch.num_rows):
                ids, keys = (batch.column(c)[i].values for c in range(2))
                bags, every, _ = block_shingles(unsqueezed(batch.column(2)[i].as_py()), s.words)
                parts = sorted(batch.column(3)[i].as_py() or [], key=lambda x: x["slice"])
                of_every = np.concatenate([frequencies(x["df"]) for x in parts] or [frequencies(None)])
                if len(of_every) != len(every):
                    raise ValueError("document frequencies do not fit their block")
                for lo, hi, owner, h, n in bags:
                    df = of_every[np.searchsorted(every, h)]
                    signature, count = s.sign_bags(hi - lo, owner, h, n, df)
                    band_keys = s.band_keys(signature)
                    short = signature.astype("<u4")
                    own = np.split(df, np.cumsum(count)[:-1])
                    yield pa.RecordBatch.from_arrays([
                        ids.slice(lo, hi - lo), keys.slice(lo, hi - lo),
                        pa.array([x.tobytes() if c else None for x, c in zip(short, count, strict=True)], pa.binary()),
                        pa.array([k if c else [] for k, c in zip(band_keys.tolist(), count.tolist(), strict=True)], pa.list_(pa.int64())),
                        pa.array([zlib.compress(x.tobytes(), 1) for x in own], pa.binary()),
                    ], names=["doc_id", "key", "signature", "bands", "df"])

    by_block = dfs.groupBy("block").agg(F.collect_list(F.struct("slice", "df")).alias("dfs"))
    rows = packed.join(by_block, "block", "left").select("doc_ids", "keys", "texts", "dfs")
    return rows.mapInArrow(with_room(run), "doc_id long, key string, signature binary, bands array<long>, df binary")


def agreeing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x == y).sum(axis=-1)


def signature_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(len(column), -1)


def likely(pairs: DataFrame, signatures: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) whose signatures agree in ``least`` samples."""
    both = pairs.join(signatures.select(F.col("key").alias("a"), F.col("signature").alias("x")), "a").join(
        signatures.select(F.col("key").alias("b"), F.col("signature").alias("y")), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (signature_matrix(batch.column(i)) for i in (2, 3))
            keep = pa.array(agreeing(x, y) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return both.select("a", "b", "x", "y").mapInArrow(with_room(run), "a string, b string")


def verified(pairs: DataFrame, texts: DataFrame, sampler, threshold: float) -> DataFrame:
    """The pairs (a, b) of keys whose exact similarity reaches the threshold.

    Both joins are plain shuffles, so the many pairs of one hot text can be split over tasks.
    """
    both = (
        pairs.join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"), F.col("df").alias("df_b")), "b")
        .join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"), F.col("df").alias("df_a")), "a")
        .select("a", "b", "text_a", "text_b", "df_a", "df_b")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = sampler.value
        last, bag_a = None, None
        for batch in batches:
            yes = []
            for a, ta, tb, da, db in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5)), strict=True):
                if a != last:
                    last, bag_a = a, s.weighted([ta], frequencies(da))[1:]
                yes.append(s.similarity(bag_a, s.weighted([tb], frequencies(db))[1:]) >= threshold)
            keep = pa.array(yes, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return both.mapInArrow(with_room(run), "a string, b string")


def segments(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of start, start + 1, ... of each segment, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class Block:
    """Texts of one bucket with what comparing them needs."""

    def __init__(self, rows: pa.Array, sampler: Sampler):
        self.keys = rows.field("key").to_pylist()
        self.roots = rows.field("root").to_pylist()
        self.signatures = signature_matrix(rows.field("signature"))
        self.bands = rows.field("bands").flatten().to_numpy().reshape(len(rows), -1)
        df = np.concatenate([frequencies(x) for x in rows.field("df").to_pylist()])
        owner, self.h, self.weights = sampler.weighted(rows.field("text").to_pylist(), df)
        self.sizes = np.bincount(owner, minlength=len(rows))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.totals = np.bincount(owner, self.weights, minlength=len(rows))


def links_between(x: Block, y: Block, band: int, least: int, threshold: float) -> list[tuple[str, str]]:
    """Links that join the roots of two blocks of a bucket (or of one with itself) as all their pairs would.

    Left out are pairs whose roots are one by then, that share an earlier bucket (compared there),
    or whose signatures agree in fewer than ``least`` samples.
    """
    _, root = np.unique(np.array(x.roots + (y.roots if y is not x else []), dtype=object), return_inverse=True)
    shift = 0 if y is x else len(x.keys)
    shingle, place = np.unique(y.h, return_inverse=True)
    dense = np.zeros(len(shingle) + 1)
    found = []
    for i in range(len(x.keys)):
        j = np.flatnonzero(root[shift:] != root[i])
        if y is x:
            j = j[j > i]
        j = j[agreeing(y.signatures[j], x.signatures[i]) >= least]
        first = (x.bands[i] == band).argmax()
        j = j[(y.bands[j] == x.bands[i]).argmax(axis=1) == first]
        small, large = np.minimum(y.totals[j], x.totals[i]), np.maximum(y.totals[j], x.totals[i])
        j = j[small >= threshold * large * (1 - 1e-9)]
        if not len(j):
            continue
        mine = slice(x.starts[i], x.starts[i] + x.sizes[i])
        at = np.minimum(np.searchsorted(shingle, x.h[mine]), len(shingle) - 1)
        at = np.where(shingle[at] == x.h[mine], at, len(shingle))
        dense[at] = x.weights[mine]
        dense[-1] = 0.0
        take = 16  # more and more: the first often make the others needless
        while len(j):
            some, j = j[:take], j[take:]
            take *= 2
            held = segments(y.starts[some], y.sizes[some])
            ends = np.cumsum(y.sizes[some])
            both = np.add.reduceat(np.minimum(dense[place[held]], y.weights[held]), ends - y.sizes[some])
            linked = some[both / (x.totals[i] + y.totals[some] - both) >= threshold]
            for k in linked:
                if root[shift + k] != root[i]:
                    found.append((min(x.keys[i], y.keys[k]), max(x.keys[i], y.keys[k])))
                    root[root == root[shift + k]] = root[i]
            if len(linked):
                j = j[root[shift + j] != root[i]]
        dense[at] = 0.0
    return found


def block_links(members: DataFrame, texts: DataFrame, sampler, least: int, threshold: float) -> DataFrame:
    """Verified links (a, b) that connect the roots of each bucket of members (band, key, root) as all
    its pairs would.

    A bucket is cut into blocks of about BLOCK members or BLOCK_CHARS characters, which carry texts
    (key, signature, bands, text, df); a task compares two blocks at a time.
    """
    lengths = members.join(texts.select("key", F.length("text").alias("chars")), "key")
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("chars") / BLOCK_CHARS))
    part = F.pmod(F.xxhash64("key"), F.col("parts"))
    rows = F.collect_list(F.struct("key", "root", "signature", "bands", "text", "df"))
    cut = members.join(lengths.groupBy("band").agg(parts.alias("parts")), "band").join(texts, "key")
    blocks = staged(cut.groupBy("band", "parts", part.alias("part")).agg(rows.alias("rows")), "near-blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):  # not the whole batch: blocks are large
                x = Block(batch.column(1)[row].values, sampler.value)
                y = Block(batch.column(2)[row].values, sampler.value) if batch.column(2)[row].is_valid else x
                found = links_between(x, y, batch.column(0)[row].as_py(), least, threshold)
                yield pa.RecordBatch.from_pydict({"a": [p[0] for p in found], "b": [p[1] for p in found]}, schema=pa.schema([("a", pa.string()), ("b", pa.string())]))

    ahead = blocks.select("band", F.col("part").alias("i"), F.explode(F.sequence("part", F.col("parts") - 1)).alias("j"), F.col("rows").alias("x"))
    behind = blocks.where("part > 0").select("band", F.explode(F.sequence(F.lit(0).cast("long"), F.col("part") - 1)).alias("i"), F.col("part").alias("j"), F.col("rows").alias("y"))
    return ahead.join(behind, ["band", "i", "j"], "left").select("band", "x", "y").mapInArrow(with_room(run), "a string, b string").distinct()


def components(links: DataFrame) -> DataFrame:
    """(key, root) for every key of links (a, b): the smallest key connected to it.

    Smallest neighbouring label, then a jump to that label's own label, until nothing changes;
    each round is a written table. Links here are mostly stars, which take two or three rounds.
    """
    both = staged(links.select("a", "b").union(links.select("b", "a")).distinct(), "near-links")
    labels = staged(both.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("m")).select("key", F.least("key", "m").alias("root")), "near-roots")
    while True:
        best = (
            both.join(labels.select(F.col("key").alias("b"), "root"), "b").groupBy(F.col("a").alias("key")).agg(F.min("root").alias("m"))
            .join(labels, "key").select("key", F.col("root").alias("was"), F.least("root", "m").alias("via"))
        )
        jumped = best.join(labels.select(F.col("key").alias("via"), F.col("root").alias("beyond")), "via").select(
            "key", "was", F.least("via", "beyond").alias("root")
        )
        labels = staged(jumped, "near-roots")
        if labels.where("root <> was").isEmpty():
            return labels.select("key", "root")
        labels = labels.select("key", "root")


def grown(roots: DataFrame, fresh: DataFrame) -> DataFrame:
    """roots (key, root) with the links ``fresh`` (a, b) added: only the roots they join are worked out anew."""
    of_a, of_b = (roots.select(F.col("key").alias(c), F.col("root").alias(f"root_{c}")) for c in "ab")
    between = fresh.join(of_a, "a", "left").join(of_b, "b", "left").select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    over = components(between.where("a <> b")).select(F.col("key").alias("root"), F.col("root").alias("over"))
    ends = fresh.select(F.col("a").alias("key")).union(fresh.select("b")).distinct().join(roots, "key", "left_anti")
    every = roots.select("key", "root").union(ends.select("key", F.col("key").alias("root")))
    return staged(every.join(over, "root", "left").select("key", F.coalesce("over", "root").alias("root")), "near-grown")


def near_duplicates(
    docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """doc_id, text key and class (its smallest key and its smallest doc_id) of every row of docs
    (doc_id, text)."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", "text")
    packed = staged(packed_texts(docs), "near-packed")
    documents, chars = packed.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("chars"), F.lit(0))).first()
    sampler = spark.sparkContext.broadcast(Sampler(None, documents, words, bands, rows))
    dfs = staged(counted(packed, words, max(SLICES, -(-chars // SLICE_CHARS)), cell_bits(chars)), "near-frequencies")

    signed = staged(signed_texts(packed, dfs, sampler), "near-signed")
    drop(packed, dfs)
    # First of equal texts: signatures are equal too.
    distinct = staged(
        signed.groupBy("key").agg(F.min("doc_id").alias("first_id"), F.min("signature").alias("signature"), F.min("bands").alias("bands"), F.min("df").alias("df")), "near-texts"
    )
    ids = staged(signed.select("doc_id", "key"), "near-ids")
    drop(signed)
    banded = distinct.select("key", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band")
    members = staged(banded.join(shared, "band").select("band", "key"), "near-members")

    wanted = members.select("key").distinct()
    candidates = staged(distinct.join(wanted, "key").select("key", "first_id", "signature", "bands", "df"), "near-candidates")
    heads = staged(distinct.select("key", "first_id"), "near-heads")
    drop(distinct)
    firsts = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("first_id"), text_key().alias("key"), "text")
    one = candidates.select(F.col("key").alias("k"), F.col("first_id").alias("f"), "signature", "bands", "df")
    # On both columns: the copies of a common text differ in their ids and spread out.
    first = firsts.join(one, (F.col("key") == F.col("k")) & F.col("first_id").eqNullSafe(F.col("f")))
    texts = staged(first.select("key", "text", "signature", "bands", "df").dropDuplicates(["key"]), "near-read")
    drop(candidates)

    least = int(np.ceil((threshold - SLACK) * bands * rows))
    tried = spark.createDataFrame([], "a string, b string")
    roots = spark.createDataFrame([], "key string, root string")
    rooted = members.withColumn("root", F.col("key"))
    for number in range(LEAD_ROUNDS + 1):
        if number < LEAD_ROUNDS:
            draw = F.struct(F.xxhash64("key", "band", F.lit(number)).alias("o"), F.col("key"), F.col("root"))
            leads = rooted.groupBy("band").agg(F.min(draw).alias("lead"))
            pairs = rooted.join(leads, "band").where(F.col("root") != F.col("lead.root"))
            pairs = pairs.select(F.least("key", "lead.key").alias("a"), F.greatest("key", "lead.key").alias("b")).distinct()
            pairs = staged(pairs.join(tried, ["a", "b"], "left_anti"), "near-pairs")
            tried = tried.union(pairs)
            fresh = verified(likely(pairs, texts, least), texts, sampler, threshold)
        else:
            several = rooted.groupBy("band").agg(F.min("root").alias("r"), F.max("root").alias("s"), F.count(F.lit(1)).alias("n"))
            several = several.where("r <> s and n > 2").select("band")  # the first round has seen the pairs of two
            fresh = block_links(staged(rooted.join(several, "band"), "near-several"), texts, sampler, least, threshold)
        fresh = staged(fresh, "near-fresh")
        if fresh.isEmpty():
            continue
        roots = grown(roots, fresh)
        if number < LEAD_ROUNDS:
            rooted = staged(members.join(roots, "key", "left").select("band", "key", F.coalesce("root", "key").alias("root")), "near-rooted")

    nodes = staged(heads.join(roots, "key", "left").select("key", "first_id", F.coalesce("root", "key").alias("root")), "near-nodes")
    classes = nodes.groupBy("root").agg(F.min("first_id").alias("class_id"))
    classed = staged(nodes.join(classes, "root").select("key", F.col("root").alias("class_key"), "class_id"), "near-classes")
    found = ids.join(classed, "key").select("doc_id", "key", "class_key", "class_id")
    empty = docs.where("text is null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("string").alias("key"),
        F.lit(None).cast("string").alias("class_key"), F.col("doc_id").cast("long").alias("class_id")
    )
    return found.union(empty)
