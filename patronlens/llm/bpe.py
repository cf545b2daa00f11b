"""BPE encoding and decoding through a table of distinct words.

Documents are read in blocks of bounded size. Each block numbers its distinct words (runs without
white space, which no token of this vocabulary crosses) and keeps its texts as word numbers. The
blocks' words are shuffled by a hash of the word, so each distinct word is encoded once by the
tokenizer, whatever number of documents hold it; the ids go back to the blocks by word number and
are joined to the places of the words there. Decoding joins ids to pieces: the table of pieces is
bounded by the vocabulary and goes to every task.

A word is one row per block, not per occurrence: frequent words are no hot keys, and what is
shuffled is a small part of the text. Buckets, and the tasks that put blocks together, grow with
the stored bytes of the input (``bucket_bytes`` each), so a task's share does not. Memory is bounded
by the block (``block_chars``, or one longer text) and by the distinct words of one bucket; a worker
reads the tokenizer's file, which takes three times the tokenizer's memory for a moment, once and not
for each task, and tasks that only join pieces do not read it.

Only tokenizers that this division suits are taken: tokens end at white space, and decoding puts a
space between tokens. Others are refused.

Null and empty texts: no ids, empty decoded text. Rows with equal or null ids are kept apart.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.llm.common import give_back, small_batches

BLOCK_CHARS = 16_000_000
BUCKET_BYTES = 16 << 20  # stored bytes of the input per bucket of words
UNKNOWN_BYTES = 1 << 60  # statistics from here on stand for a size that is not known
MOST_BUCKETS = 1 << 15  # bucket numbers take two bytes
# What the tokenizer's pattern takes as white space; str.split() knows four more.
MORE = re.compile(r"[\x1c-\x1f]")
ONLY = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")

BLOCKS = "block long, bucket int, body binary, counts array<int>, ids array<long>"


def split_words(text: str) -> list[str]:
    if MORE.search(text):
        return [w for w in ONLY.split(text) if w]
    return text.split()


class Numbers(dict):
    """Numbers words in order of appearance."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


def pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def planes(values: np.ndarray, width: int) -> bytes:
    """Numbers as byte planes, lowest first: the higher ones compress well."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].T.tobytes()


def from_planes(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 4), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return out.view("<u4").ravel()


ONE, TWO = 192, 48  # numbers below 192 take a byte, the next 48 * 256 two, the others five


def pack_numbers(values: np.ndarray) -> bytes:
    """Numbers by size, their first bytes apart from the rest: frequent words have small ones."""
    v = values.astype(np.int64)
    two, five = (v >= ONE) & (v < ONE + (TWO << 8)), v >= ONE + (TWO << 8)
    first = np.where(five, ONE + TWO, np.where(two, ONE + (v - ONE >> 8), v)).astype(np.uint8)
    bodies = [pack(first.tobytes()), pack((v[two] - ONE & 255).astype(np.uint8).tobytes()), pack(planes(v[five], 4))]
    return struct.pack("<III", *map(len, bodies)) + b"".join(bodies)


def unpack_numbers(data: bytes) -> tuple[np.ndarray, int]:
    """The numbers and the bytes they took."""
    at, parts = 12, []
    for n in struct.unpack_from("<III", data):
        parts.append(unpack(data[at : at + n]))
        at += n
    first = np.frombuffer(parts[0], np.uint8)
    out = first.astype(np.int32)
    two, five = (first >= ONE) & (first < ONE + TWO), first == ONE + TWO
    out[two] = (out[two] - ONE << 8) + np.frombuffer(parts[1], np.uint8) + ONE
    out[five] = from_planes(parts[2], 4)
    return out, at


def to_blocks(docs: DataFrame, buckets: int, block_chars: int) -> DataFrame:
    """Rows of two kinds: the words of a block that fall in a bucket, and (bucket -1) the block
    itself: word numbers of its texts, words per text, ids of its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        numbers, texts, ids, chars = Numbers(), [], [], 0

        def flush() -> pa.RecordBatch:
            seq = np.concatenate(texts) if texts else np.zeros(0, np.int32)
            counts = [len(numbers), *map(len, texts)]
            words = list(numbers)
            texts.clear()  # not held beside what is made of them
            numbers.clear()
            frequent = np.argsort(-np.bincount(seq, minlength=len(words)), kind="stable")  # short numbers for them
            rank = np.empty(len(words), np.int32)
            rank[frequent] = np.arange(len(words), dtype=np.int32)
            words = [words[i] for i in frequent]
            bucket = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) % buckets for w in words), np.int32, len(words))
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            out = {"block": [], "bucket": [], "body": [], "counts": [], "ids": []}

            def add(n: int, body: bytes, counts: list, keys: list) -> None:
                for k, v in zip(out, (block, n, body, counts, keys), strict=True):
                    out[k].append(v)

            for n in range(buckets):
                mine = order[cuts[n] : cuts[n + 1]]
                if len(mine):
                    add(n, pack("\n".join([words[i] for i in mine]).encode()), [], [])
            add(-1, pack_numbers(rank[seq]) + pack(planes(bucket, 2)), counts, ids)
            return pa.RecordBatch.from_pydict(out, schema=pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("body", pa.binary()), ("counts", pa.list_(pa.int32())), ("ids", pa.list_(pa.int64()))]))

        for batch in batches:
            for row in range(batch.num_rows):
                text = batch.column(1)[row].as_py()
                words = split_words(text) if text else []
                texts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                ids.append(batch.column(0)[row].as_py())
                chars += len(text or "")
                if chars >= block_chars:
                    yield flush()
                    block += 1
                    numbers, texts, ids, chars = Numbers(), [], [], 0
        if ids:
            yield flush()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, BLOCKS)


def encode_words(words: DataFrame, tokenizer_path: str) -> DataFrame:
    """Word lists of buckets to lists of ids: each distinct word is encoded once a bucket.
    The blocks' own rows pass unchanged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = worker_tokenizer(tokenizer_path)
        known: dict[str, np.ndarray] = {}
        now = None
        for batch in batches:
            for row in range(batch.num_rows):
                block, bucket = (batch.column(i)[row].as_py() for i in range(2))
                if bucket < 0:
                    yield batch.slice(row, 1)
                    continue
                body = batch.column(2)[row].as_py()
                if bucket != now:
                    now, known = bucket, {}
                words = unpack(body).decode().split("\n")
                new = [w for w in words if w not in known]
                for at in range(0, len(new), 4096):
                    part = new[at : at + 4096]
                    for w, e in zip(part, tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                        known[w] = np.array(e.ids, np.uint32)
                found = [known[w] for w in words]
                sizes = np.fromiter(map(len, found), np.uint32, len(found))
                body = pack(planes(sizes, 4) + planes(np.concatenate(found), 3))
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([bucket], pa.int32()), pa.array([body], pa.binary()), pa.array([[len(words)]], pa.list_(pa.int32())), pa.array([[]], pa.list_(pa.int64()))], names=["block", "bucket", "body", "counts", "ids"])

    return words.mapInArrow(run, BLOCKS)


def load_tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@cache
def worker_tokenizer(path: str):
    """The tokenizer of a Python worker, for all its tasks."""
    tokenizer = load_tokenizer(path)
    give_back()
    return tokenizer


def check_suited(path: str) -> None:
    """Raise ValueError for a tokenizer whose words cannot be encoded apart, tried with every white
    space, or whose ids do not decode to their tokens with a space between."""
    tokenizer = load_tokenizer(path)
    words = ["Ab", "c1's", "d,", "e\u0301", "-f"]

    def ids(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    apart = [i for w in words for i in ids(w)]
    spaces = [chr(c) for c in range(0x3001) if ONLY.match(chr(c))]
    if any(ids(between.join(words)) != apart for s in spaces for between in (s, s * 2)):
        raise ValueError(f"{path}: tokens reach over white space or depend on it")
    if tokenizer.decode(apart, skip_special_tokens=False) != " ".join(map(tokenizer.id_to_token, apart)):
        raise ValueError(f"{path}: ids decode to something else than their tokens and spaces")


def bucket_count(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for the bytes of ``docs`` as Spark's statistics state them, at least the session's
    shuffle partitions; these alone for rows that come from no files, whose size Spark does not know."""
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    least = max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    needed = -(-size // bucket_bytes) if size < UNKNOWN_BYTES else 0
    return min(max(least, needed), MOST_BUCKETS)


def assemble(rows: DataFrame, tokenizer_path: str, emit_chars: int = 500_000) -> DataFrame:
    """doc_id, ids and decoded text from the rows of each block, its own row last."""
    tokenizer = load_tokenizer(tokenizer_path)
    shared = rows.sparkSession.sparkContext.broadcast([tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = np.array(shared.value, dtype=object)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for row in range(batch.num_rows):
                bucket, body = (batch.column(i)[row].as_py() for i in (1, 2))
                counts = batch.column(3)[row].values.to_numpy()
                if bucket >= 0:
                    data = unpack(body)
                    n = 4 * int(counts[0])
                    parts.append((from_planes(data[:n], 4), from_planes(data[n:], 3)))
                    continue
                yield from texts_of(body, counts, batch.column(4)[row].as_py(), parts, piece, emit_chars)
                parts = []

    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def texts_of(data: bytes, counts, keys: list, parts: list, piece: np.ndarray, emit: int) -> Iterator[pa.RecordBatch]:
    """The documents of one block from its word numbers and the ids of its words, by bucket."""
    n, lengths = int(counts[0]), counts[1:].astype(np.int64)
    seq, at = unpack_numbers(data)
    bucket = from_planes(unpack(data[at:]), 2)
    order = np.argsort(bucket, kind="stable")  # the words' numbers in the order of the parts
    sizes = np.zeros(n, np.int64)
    flat = np.concatenate([f for _, f in parts]) if parts else np.zeros(0, np.uint32)
    if n:
        sizes[order] = np.concatenate([s for s, _ in parts])
    starts = np.zeros(n, np.int64)
    starts[order] = np.cumsum(sizes[order]) - sizes[order]
    spelt = np.empty(n, dtype=object)
    pieces = piece[flat]  # ids joined to pieces, once per distinct word
    for i in range(n):
        spelt[i] = " ".join(pieces[starts[i] : starts[i] + sizes[i]])
    ends = np.cumsum(lengths)
    first = 0
    while first < len(keys):
        last = first + 1
        base = int(ends[first] - lengths[first])
        while last < len(keys) and (ends[last] - base) * 6 < emit:
            last += 1
        mine = seq[base : int(ends[last - 1])]
        size = sizes[mine]
        total = np.cumsum(size)
        at = np.arange(int(total[-1]) if len(total) else 0) + np.repeat(starts[mine] - (total - size), size)
        offsets = np.concatenate([[0], np.concatenate([[0], total])[ends[first:last] - base]]).astype(np.int32)
        decoded = [" ".join(spelt[seq[int(ends[k] - lengths[k]) : int(ends[k])]]) for k in range(first, last)]
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat[at].astype(np.int32)))
        yield pa.RecordBatch.from_arrays([pa.array(keys[first:last], pa.int64()), ids, pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"])
        first = last


def encode_decode(docs: DataFrame, tokenizer_path: str, block_chars: int = BLOCK_CHARS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, ids and decoded text of every row of docs (doc_id, text)."""
    spark = docs.sparkSession
    small_batches(spark)
    check_suited(tokenizer_path)
    buckets = bucket_count(docs, bucket_bytes)
    blocks = to_blocks(docs, buckets, block_chars)
    place = F.when(F.col("bucket") >= 0, F.col("bucket")).otherwise(F.pmod(F.xxhash64("block"), F.lit(buckets)).cast("int"))
    words = blocks.withColumn("_place", place).repartition(buckets, "_place").drop("_place").sortWithinPartitions("bucket", "block")
    rows = encode_words(words, tokenizer_path)
    last = F.when(F.col("bucket") < 0, F.lit(1)).otherwise(0)
    return assemble(rows.repartition(buckets, "block").sortWithinPartitions("block", last, "bucket"), tokenizer_path)
