"""Token ids in wavelet matrices, one per shard.

A shard file holds the ids of consecutive documents as bit planes, highest bit first; each plane
is ordered by the bits above it (zeros before ones, stable), with the ones counted every
BLOCK bits. Any token is read, counted (rank) or found (select) from the planes alone, without
decoding the rest. The file is compressed as a whole: magic, sizes, document ids and lengths,
zeros per plane, counts, planes.

Shards are cut at documents once they hold ``shard_tokens`` ids, in ascending doc_id order (null
first; rows of one id in the order of their texts); a longer document is a shard of its own.
Null and empty texts: the end id only.
"""

from __future__ import annotations

import json
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.llm.common import numbered, small_batches, with_room

MAGIC = b"WVMX1\0"
BLOCK = 512
SHARD_TOKENS = 1 << 19
NO_ID = -(1 << 63)  # a null doc_id


class WaveletMatrix:
    def __init__(self, n: int, bits: list[np.ndarray], zeros: list[int], counts: list[np.ndarray]):
        self.n, self.bits, self.zeros, self.counts = n, bits, zeros, counts

    @classmethod
    def build(cls, ids: np.ndarray, levels: int) -> WaveletMatrix:
        bits, zeros, counts = [], [], []
        now = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        for level in range(levels - 1, -1, -1):
            one = now & now.dtype.type(1 << level) != 0
            packed = np.packbits(one, bitorder="little")
            per_block = np.add.reduceat(one, np.arange(0, max(len(one), 1), BLOCK), dtype=np.uint32) if len(one) else np.zeros(0, np.uint32)
            bits.append(packed)
            counts.append(np.concatenate([[0], np.cumsum(per_block)]).astype(np.uint32))
            low, high = now.compress(~one), now.compress(one)
            zeros.append(len(low))
            now = np.concatenate([low, high])
        return cls(len(ids), bits, zeros, counts)

    def _bit(self, plane: int, i: int) -> int:
        return int(self.bits[plane][i >> 3] >> (i & 7)) & 1

    def _ones(self, plane: int, i: int) -> int:
        """Ones ahead of place i."""
        block = i // BLOCK
        part = np.unpackbits(self.bits[plane][block * BLOCK // 8 : (i + 7) // 8], bitorder="little")
        return int(self.counts[plane][block]) + int(part[: i - block * BLOCK].sum())

    def access(self, i: int) -> int:
        value = 0
        for plane in range(len(self.bits)):
            bit = self._bit(plane, i)
            ones = self._ones(plane, i)
            i = self.zeros[plane] + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, value: int, i: int) -> tuple[int, int]:
        lo, hi = 0, i
        for plane in range(len(self.bits)):
            a, b = self._ones(plane, lo), self._ones(plane, hi)
            if value >> (len(self.bits) - 1 - plane) & 1:
                lo, hi = self.zeros[plane] + a, self.zeros[plane] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def rank(self, value: int, i: int) -> int:
        """Occurrences of the value ahead of place i."""
        lo, hi = self._range(value, i)
        return hi - lo

    def select(self, value: int, k: int) -> int:
        """The place of occurrence k (from 0), or -1."""
        lo, hi = self._range(value, self.n)
        if not 0 <= k < hi - lo:
            return -1
        at = lo + k
        for plane in range(len(self.bits) - 1, -1, -1):
            one = value >> (len(self.bits) - 1 - plane) & 1
            at = self._place(plane, at - self.zeros[plane] if one else at, one)
        return at

    def _place(self, plane: int, k: int, one: int) -> int:
        counts = self.counts[plane].astype(np.int64)
        ahead = counts if one else np.arange(len(counts)) * BLOCK - counts
        block = int(np.searchsorted(ahead[:-1], k, side="right")) - 1
        part = np.unpackbits(self.bits[plane][block * BLOCK // 8 : (block + 1) * BLOCK // 8], bitorder="little")[: self.n - block * BLOCK]
        return block * BLOCK + int(np.flatnonzero(part == one)[k - int(ahead[block])])

    def decode(self) -> np.ndarray:
        """All ids, plane by plane from the lowest: the order of a plane undoes the one below."""
        now = np.zeros(self.n, np.uint16 if len(self.bits) <= 16 else np.uint32)
        for plane in range(len(self.bits) - 1, -1, -1):
            one = np.unpackbits(self.bits[plane], count=self.n, bitorder="little").view(bool)
            above = np.empty_like(now)
            above[np.flatnonzero(~one)] = now[: self.zeros[plane]]
            above[np.flatnonzero(one)] = now[self.zeros[plane] :] | now.dtype.type(1 << (len(self.bits) - 1 - plane))
            now = above
        return now.astype(np.uint32)


def to_file(ids: np.ndarray, keys: list[int], lengths: list[int], levels: int) -> bytes:
    w = WaveletMatrix.build(ids, levels)
    body = b"".join([
        struct.pack("<QIH", w.n, len(keys), levels), np.array(keys, "<i8").tobytes(), np.array(lengths, "<u4").tobytes(),
        np.array(w.zeros, "<u8").tobytes(), *(c.astype("<u4").tobytes() for c in w.counts), *(b.tobytes() for b in w.bits),
    ])
    return MAGIC + zstandard.ZstdCompressor(level=1).compress(body)


def from_file(data: bytes) -> tuple[WaveletMatrix, np.ndarray, np.ndarray]:
    """The matrix, document ids and lengths of a shard file."""
    if not data.startswith(MAGIC):
        raise ValueError("not a wavelet shard")
    body = zstandard.ZstdDecompressor().decompress(data[len(MAGIC) :])
    n, docs, levels = struct.unpack_from("<QIH", body)
    at = struct.calcsize("<QIH")

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(body, kind, count, at)
        at += out.nbytes
        return out

    keys, lengths, zeros = take("<i8", docs), take("<u4", docs), take("<u8", levels)
    counts = [take("<u4", -(-n // BLOCK) + 1) for _ in range(levels)]
    bits = [take("u1", -(-n // 8)) for _ in range(levels)]
    return WaveletMatrix(n, bits, [int(z) for z in zeros], counts), keys, lengths


# --- Tokens --------------------------------------------------------------------------------------

CHUNK = 1 << 21  # bytes of texts cut at a time
TOGETHER = 256  # new parts given to the library at once
LONG = 200  # longer parts are not remembered
SPACE, LETTER, DIGIT, MARK, UNSURE = range(5)


@cache
def kinds() -> np.ndarray:
    """What a code point is to the byte-level pattern; UNSURE where editions of Unicode differ, and
    from U+FFFF on."""
    first = {"L": LETTER, "N": DIGIT, "P": MARK, "S": MARK, "M": MARK}
    out = np.full(1 << 16, UNSURE, np.uint8)
    for i, c in enumerate(map(chr, range(0xFFFF))):
        now, then = unicodedata.category(c)[0], unicodedata.ucd_3_2_0.category(c)[0]
        if now == then and now in first:
            out[i] = first[now]
    out[:128] = np.where(out[:128] == UNSURE, MARK, out[:128])  # control characters
    out[[*range(9, 14), 32, 0x85, 0xA0, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = SPACE
    return out


def cut(code: np.ndarray, kind: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Where the parts of texts begin, as the byte-level pattern cuts them: 's|'t|'re|'ve|'m|'ll|'d,
    runs of letters, digits or marks with one space ahead, and white space. ``firsts``: where texts
    begin; none is empty."""
    fresh = np.ones(len(code) + 1, bool)
    fresh[1:-1] = kind[1:] != kind[:-1]
    fresh[firsts] = True
    begins = fresh[:-1].copy()
    new_text = np.zeros(len(code) + 1, bool)
    new_text[firsts] = new_text[-1] = True
    white = kind == SPACE
    begins[1:] &= ~((code[:-1] == 32) & ~white[1:]) | new_text[1:-1]  # the space ahead belongs to the run
    begins |= white & fresh[1:] & ~new_text[1:]  # the last of a run of white space, but for the text's end
    for q in np.flatnonzero((code == 39) & begins):  # a mark's run begins here, without a space ahead
        tail = code[q + 1 : q + 3]
        if not len(tail) or new_text[q + 1]:
            continue
        size = 2 if chr(tail[0]) in "stmd" else 3 if len(tail) == 2 and not new_text[q + 2] and chr(tail[0]) + chr(tail[1]) in ("re", "ve", "ll") else 0
        if size:
            begins[q + 1 : q + size] = False
            if q + size < len(code) and not (kind[q + size] == SPACE):
                begins[q + size] = True
    return np.flatnonzero(begins)


def byte_characters() -> np.ndarray:
    """The character that a byte-level vocabulary writes for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = np.zeros(256, "<u2")
    out[shown] = shown
    out[out == 0] = 256 + np.arange(256 - len(shown))
    return out


def values(array: pa.Array) -> list[bytes]:
    """What a binary array without nulls holds."""
    offsets, body = array.buffers()[1:]
    ends = np.frombuffer(offsets, np.int32)[array.offset : array.offset + len(array) + 1].tolist()
    body = body.to_pybytes()
    return [body[a:b] for a, b in pairwise(ends)]


class Encoder:
    """Ids of whole texts as the tokenizer gives them.

    A byte-level tokenizer cuts texts by a fixed pattern and encodes each part by itself. Here many
    texts are cut at once, their distinct parts told by Arrow, and the library's model encodes those
    it has not met, within a bounded memory. Texts with added tokens or with characters whose kind is
    unsure are encoded whole, and so is every text if the tokenizer is not a plain byte-level one.
    """

    def __init__(self, path: str, parts: int = 300_000):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.levels = max(1, (self.tokenizer.get_vocab_size() - 1).bit_length())
        made = json.loads(self.tokenizer.to_str())
        by = made["pre_tokenizer"] or {}
        self.plain = (
            made["normalizer"] is None and by.get("type") == "ByteLevel" and by.get("use_regex") is True
            and not by.get("add_prefix_space") and made["model"]["type"] == "BPE" and not made["model"].get("dropout")
        )
        # The same model for parts that are cut already and written in its characters.
        self.apart = Tokenizer(self.tokenizer.model)
        self.apart.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\0")
        self.characters = byte_characters()
        self.most, self.known, self.older = parts, {}, {}
        # A piece of a byte-level vocabulary is written with one character a byte.
        self.piece_bytes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for piece, i in self.tokenizer.get_vocab().items():
            self.piece_bytes[i] = len(piece)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def together(self, parts: list[bytes]) -> list[bytes]:
        """Ids of parts, given to the library as one and cut where the bytes of the pieces add up to
        the bytes of the parts; one by one if they do not (a byte without a piece)."""
        wanted = np.cumsum([len(p) for p in parts])
        written = np.insert(self.characters[np.frombuffer(b"".join(parts), np.uint8)], wanted[:-1], 0).tobytes().decode("utf-16-le")
        ids = np.array(self.apart.encode_batch_fast([written], add_special_tokens=False)[0].ids, "<u4")
        ends = np.cumsum(self.piece_bytes[ids])
        cuts = np.searchsorted(ends, wanted)
        if not len(ends) or ends[-1] != wanted[-1] or (ends[cuts] != wanted).any():
            return [np.array([t.id for t in self.tokenizer.model.tokenize(w)], "<u4").tobytes() for w in written.split("\0")]
        body, stops = ids.tobytes(), ((cuts + 1) * 4).tolist()
        return [body[a:b] for a, b in pairwise([0, *stops])]

    def ids_of(self, parts: list[bytes]) -> list[bytes]:
        """Ids of distinct parts; those not met again while ``most`` others came are forgotten."""
        if len(self.known) > self.most:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        found = [known.get(p) for p in parts]
        new = []
        for i, ids in enumerate(found):
            if ids is None:
                p = parts[i]
                if (ids := older.get(p)) is None:
                    new.append(i)
                else:
                    found[i] = known[p] = ids
        for at in range(0, len(new), TOGETHER):
            some = new[at : at + TOGETHER]
            for i, ids in zip(some, self.together([parts[i] for i in some]), strict=True):
                found[i] = ids
                if len(parts[i]) <= LONG:
                    known[parts[i]] = ids
        return found

    def cut_texts(self, texts: list[bytes]) -> list[np.ndarray | None]:
        """Ids of texts that are not empty; None for those to encode whole."""
        joined = b"".join(texts)
        code = np.frombuffer(joined.decode().encode("utf-32-le"), "<u4")
        kind = kinds()[np.minimum(code, 0xFFFF)]
        at = np.flatnonzero((np.frombuffer(joined, np.uint8) & 0xC0) != 0x80)  # bytes ahead of a character
        ends = np.cumsum([len(t) for t in texts])
        firsts = np.searchsorted(at, np.concatenate([[0], ends[:-1]]))
        unsure = np.searchsorted(firsts, np.flatnonzero(kind == UNSURE), side="right") - 1
        if len(unsure):
            sure = np.setdiff1d(np.arange(len(texts)), unsure).tolist()
            found: list[np.ndarray | None] = [None] * len(texts)
            for i, ids in zip(sure, self.cut_texts([texts[i] for i in sure]) if sure else [], strict=True):
                found[i] = ids
            return found
        begins = cut(code, kind, firsts)
        offsets = np.append(at[begins], len(joined)).astype(np.int32)
        parts = pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(joined)]).dictionary_encode()
        bodies = self.ids_of(values(parts.dictionary))
        sizes = np.fromiter(map(len, bodies), np.int64, len(bodies)) // 4
        starts, which = np.cumsum(sizes) - sizes, parts.indices.to_numpy()
        size = sizes[which]
        total = np.cumsum(size)
        ids = np.frombuffer(b"".join(bodies), "<u4")[np.arange(total[-1]) + np.repeat(starts[which] - (total - size), size)]
        return np.split(ids, total[np.searchsorted(begins, firsts[1:]) - 1])

    def encode(self, texts: list[str], end: int) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        held: list[tuple[int, bytes]] = []
        size = 0
        for i, t in enumerate(texts):
            if t and self.plain and not any(s in t for s in self.special):
                held.append((i, t.encode()))
                size += len(held[-1][1])
            if held and (size >= CHUNK or i == len(texts) - 1):
                for (k, _), ids in zip(held, self.cut_texts([b for _, b in held]), strict=True):
                    out[k] = ids
                held, size = [], 0
        return [np.append(self.whole(t) if ids is None else ids, np.array([end], "<u4")) for t, ids in zip(texts, out, strict=True)]


@cache
def encoder(path: str) -> Encoder:
    """One encoder per Python worker: what it remembers serves the worker's later tasks too."""
    return Encoder(path)


SHARDS = "part int, seq int, docs int, tokens long, body binary"


def write_shards(docs: DataFrame, path: str, tokenizer_path: str, end: int = 2, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode docs (doc_id, text) and write their shard files, a row each, as a table at ``path``.

    One range shuffle of the texts by doc_id; tasks encode and pack their own runs of documents.
    """
    small_batches(docs.sparkSession)
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = ordered.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, seq = encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        keys, parts, held = [], [], 0

        def flush() -> pa.RecordBatch:
            body = to_file(np.concatenate(parts), keys, [len(p) for p in parts], tokens.levels)
            return pa.RecordBatch.from_pydict(
                {"part": [part], "seq": [seq], "docs": [len(keys)], "tokens": [held], "body": [body]},
                schema=pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("docs", pa.int32()), ("tokens", pa.int64()), ("body", pa.binary())]),
            )

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                ids = tokens.encode(some.column(1).to_pylist(), end)
                for key, one in zip(some.column(0).to_pylist(), ids, strict=True):
                    keys.append(NO_ID if key is None else key)
                    parts.append(one)
                    held += len(one)
                    if held >= shard_tokens:
                        yield flush()
                        keys, parts, held, seq = [], [], 0, seq + 1
        if keys:
            yield flush()

    ordered.mapInArrow(with_room(run), SHARDS).write.option("compression", "none").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read from the shard files."""
    small_batches(spark)
    files = spark.read.schema(SHARDS).parquet(path)
    starts = numbered(files.select("part", "seq", "tokens"), None, ["part", "seq"], ["tokens"], "wavelet-starts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for before, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                matrix, keys, lengths = from_file(body.as_py())
                ids = matrix.decode().astype("<u4")
                ends = np.cumsum(lengths, dtype=np.int64)
                first = ends - lengths
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(first, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64(), mask=keys == NO_ID), pa.array(first + before), pa.array(lengths.astype(np.int64)), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    joined = files.join(starts.select("part", "seq", "before_tokens"), ["part", "seq"])
    return joined.select("before_tokens", "body").mapInArrow(with_room(run), "doc_id long, start long, n_tokens long, ids_crc32 long")
