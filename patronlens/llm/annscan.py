"""Approximate nearest neighbours by adaptive dimension scan.

Vectors are extended by one component so that the largest inner product is the smallest distance,
and kept in lists around centroids, in chunks of bounded size. In a chunk they are rotated by a
random orthogonal matrix, and their components lie in column blocks. A query probes the lists
nearest to it, the very nearest first: the k-th score found there bounds the search of the others.
In a probed chunk distances are summed block by block; after each block a hypothesis test drops the
candidates whose partial distance, scaled up, is too far above the best found so far. What survives
all blocks is scored exactly, in double precision, on the original vectors.

The extension stays out of the blocks: the longest vector sets it for all others, and as a part
common to all candidates it would make the test one of the query. Squared lengths are known, so the
test compares the distance to the query, which is scaled to the chunk's median length, with a limit
of the candidate's own. The candidates that set the limit stay whatever the test says: a chunk
yields ``k`` rows if it has ``k`` other vectors and no bound rules them out.

Centroids are fitted on a bounded sample (about ``fit_rows`` vectors by a hash of the id); every
vector is indexed. Lists of any size are split into chunks, and queries of a list into blocks, so
no list meets in one task; a query sees every chunk of the lists it probes, and probes on until
they hold ``k`` other vectors, if there are as many.

Vectors that are null, zero, of another length than most, or hold a null or non-finite component
take no part, nor do rows without an id. Rows with the query's id are its own; an id given twice is
one query (the smaller of its vectors as bytes).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronlens.llm.common import small_batches, with_room
from patronlens.plans.tables import staged

K = 20
FIT_ROWS = 20_000
MAX_LISTS = 4096
PROBED = 0.75  # share of the lists a query probes: vectors without clusters need that many for a recall of 0.9
FIRST = 50  # vectors, times k, in the lists that are probed first
COLUMN_BLOCKS = 4
CHUNK, QUERY_BLOCK = 4096, 256
EPSILON = 1.0  # of the hypothesis test: higher drops fewer
DENSE = 0.05  # share of candidates above which a block is computed for all of them


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec, norm2) of the vectors (vec_id, embedding) that take part, as bytes of doubles."""
    sizes = vectors.where("embedding is not null and vec_id is not null").groupBy(F.size("embedding").alias("n")).count()
    most = sizes.orderBy(F.desc("count"), "n").first()
    length = most["n"] if most else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().cast(pa.float64())
            x = values.fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(batch.num_rows, length)
            norm = (x * x).sum(axis=1)
            keep = pa.array(np.isfinite(x).all(axis=1) & (x != 0).any(axis=1) & np.isfinite(norm))
            raw = pa.array([row.tobytes() for row in x], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), raw.filter(keep), pa.array(norm).filter(keep)], names=["vec_id", "vec", "norm2"])

    rows = vectors.where("vec_id is not null and embedding is not null").where(F.size("embedding") == length)
    return rows.where(F.size("embedding") > 0).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(with_room(run), "vec_id long, vec binary, norm2 double")


def matrix(column) -> np.ndarray:
    raw = column.to_pylist() if hasattr(column, "to_pylist") else column
    return np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)


class Index:
    """Centroids, rotation and the extension that turns inner products into distances."""

    def __init__(self, sample: np.ndarray, largest: float, lists: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.largest = largest
        d = sample.shape[1]
        self.rotation, _ = np.linalg.qr(rng.normal(size=(d, d)))
        x = self.extend(sample)
        self.centroids = x[rng.choice(len(x), min(lists, len(x)), replace=False)]
        for _ in range(10):
            near = self.nearest(x)
            for j in range(len(self.centroids)):
                if (near == j).any():
                    self.centroids[j] = x[near == j].mean(axis=0)
        self.blocks = np.array_split(np.arange(d), min(COLUMN_BLOCKS, d))

    def extend(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.largest - (x * x).sum(axis=1), 0.0))
        return np.concatenate([x, rest[:, None]], axis=1)

    def extend_queries(self, x: np.ndarray) -> np.ndarray:
        """Queries have no extension; scaled to the vectors' length, which keeps their order."""
        norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
        return np.concatenate([x / norm * np.sqrt(self.largest), np.zeros((len(x), 1))], axis=1)

    def turn(self, x: np.ndarray) -> np.ndarray:
        return x @ self.rotation

    def distances(self, x: np.ndarray) -> np.ndarray:
        return (self.centroids**2).sum(axis=1) - 2 * x @ self.centroids.T

    def nearest(self, x: np.ndarray) -> np.ndarray:
        return self.distances(x).argmin(axis=1)


def scan(index: Index, q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, blocks: list[np.ndarray], k: int, bounds: np.ndarray) -> list[np.ndarray]:
    """Query, id and score of the k best of a chunk for each query of a block, among those that
    reach the query's bound, a score that k others have (-inf: none known)."""
    d = sum(b.shape[1] for b in blocks)
    length = sum((b**2).sum(axis=1) for b in blocks)
    norm = np.sqrt((q * q).sum(axis=1))
    reach = np.median(length)  # squared length of the scaled queries
    rotated = index.turn(q / norm[:, None] * np.sqrt(reach))
    parts = [rotated[:, at] for at in index.blocks]
    partial = (parts[0] ** 2).sum(axis=1)[:, None] + (blocks[0] ** 2).sum(axis=1)[None] - 2 * parts[0] @ blocks[0].T
    own = q_ids[:, None] == ids[None]
    partial[own] = np.inf
    n = min(k, len(ids))
    first = np.argpartition(partial * (d / blocks[0].shape[1]) - length, n - 1, axis=1)[:, :n]
    full = np.zeros(first.shape)
    for p, b in zip(parts, blocks, strict=True):
        full += ((p[:, None, :] - b[first]) ** 2).sum(axis=2)
    full -= length[first]  # less its own squared length, a distance falls as the inner product grows
    full[np.take_along_axis(own, first, axis=1)] = np.inf
    asked = reach - 2 * bounds * np.sqrt(reach) / norm
    limit = np.minimum(full.max(axis=1), asked)  # n others are at least as near
    near = np.isfinite(full) & (full <= asked[:, None] + 1e-9 * (reach + length[first]))
    sure = np.zeros(own.shape, bool)  # known in full: no test may drop them
    np.put_along_axis(sure, first, near, axis=1)

    def passes(distance: np.ndarray, at: np.ndarray, to: np.ndarray, seen: int) -> np.ndarray:
        slack = (1 + EPSILON / np.sqrt(seen)) ** 2 if seen < d else 1 + 1e-9
        return (distance * (d / seen) <= (limit[at] + length[to]) * slack + 1e-9 * (reach + length[to])) | sure[at, to]

    # Block after block: all candidates as one product while many are left, then only those.
    seen, block, every, each = blocks[0].shape[1], 1, np.arange(len(q))[:, None], np.arange(len(ids))[None]
    left = passes(partial, every, each, seen) & ~own
    while block < len(blocks) and left.mean() > DENSE:
        p, b = parts[block], blocks[block]
        partial += (p**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None] - 2 * p @ b.T
        seen, block = seen + b.shape[1], block + 1
        left &= passes(partial, every, each, seen)
    qi, ci = np.nonzero(left)
    distance = partial[qi, ci]
    for p, b in zip(parts[block:], blocks[block:], strict=True):
        distance = distance + ((p[qi] - b[ci]) ** 2).sum(axis=1)
        seen += b.shape[1]
        keep = passes(distance, qi, ci, seen)
        qi, ci, distance = qi[keep], ci[keep], distance[keep]
    score = (q[qi] * v[ci]).sum(axis=1)
    order = np.lexsort((ids[ci], -score, qi))
    qi, ci, score = qi[order], ci[order], score[order]
    rank = np.arange(len(qi)) - np.searchsorted(qi, qi)
    keep = rank < k
    return [q_ids[qi[keep]], ids[ci[keep]], score[keep]]


def search(vectors: DataFrame, is_query, k: int = K, probed: float = PROBED, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for every vector that ``is_query``."""
    spark = vectors.sparkSession
    small_batches(spark)
    result = "query_id long, rank int, vec_id long, score double"
    rows = staged(usable(vectors), "ann-vectors")
    count, largest = rows.agg(F.count(F.lit(1)), F.max("norm2")).first()
    if not count:
        return spark.createDataFrame([], result)
    lists = int(min(max(np.sqrt(count) / 2, 1), MAX_LISTS))
    draw = F.crc32(F.concat(F.lit("fit:"), F.col("vec_id").cast("string")).cast("binary"))
    drawn = rows.where((draw * F.lit(float(count)) < F.lit(fit_rows) * F.lit(float(1 << 32))) | (F.lit(count) <= 100))
    sample = matrix(drawn.select("vec").toArrow().column(0))
    index = spark.sparkContext.broadcast(Index(sample, float(largest), lists))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = index.value.nearest(index.value.extend(matrix(batch.column(1))))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32))], names=["vec_id", "vec", "list"])

    listed = staged(rows.select("vec_id", "vec").mapInArrow(with_room(assign), "vec_id long, vec binary, list int"), "ann-listed")
    sizes = {r["list"]: r["count"] for r in listed.groupBy("list").count().collect()}  # at most MAX_LISTS
    chunks = F.broadcast(spark.createDataFrame([(i, -(-n // CHUNK)) for i, n in sizes.items()], "list int, chunks long"))
    part = F.pmod(F.xxhash64("vec_id", "vec"), "chunks")
    packed = listed.join(chunks, "list").groupBy("list", part.alias("part")).agg(F.collect_list(F.struct("vec_id", "vec")).alias("rows"))

    def columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = index.value
        for batch in batches:
            for i in range(batch.num_rows):
                rows = batch.column(2)[i].values
                vec = matrix(rows.field("vec"))
                rotated = m.turn(vec)
                ids = rows.field("vec_id").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([ids.astype("<i8").tobytes()], pa.binary()),
                    pa.array([vec.tobytes()], pa.binary()), pa.array([[np.ascontiguousarray(rotated[:, b]).tobytes() for b in m.blocks]], pa.list_(pa.binary())),
                ], names=["list", "part", "ids", "vecs", "blocks"])

    stored = staged(packed.mapInArrow(with_room(columns), "list int, part long, ids binary, vecs binary, blocks array<binary>"), "ann-index")
    size = np.array([sizes.get(i, 0) for i in range(len(index.value.centroids))])

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = index.value
        for batch in batches:
            if not batch.num_rows:
                continue
            order = np.argsort(m.distances(m.extend_queries(matrix(batch.column(1)))), axis=1, kind="stable")
            before = np.cumsum(size[order], axis=1) - size[order]
            least = max(1, int(np.ceil(probed * (size > 0).sum())))
            full = np.cumsum(size[order] > 0, axis=1)
            wanted = (full <= least) | (before <= 2 * k)
            qi, at = np.nonzero(wanted & (size[order] > 0))
            take = pa.array(qi)
            first = pa.array(before[qi, at] < FIRST * k)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(order[qi, at].astype(np.int32)), first], names=["query_id", "q", "list", "first"])

    asked = rows.where(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vec").alias("q"))
    asked = staged(asked.mapInArrow(with_room(probes), "query_id long, q binary, list int, first boolean"), "ann-probes")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = index.value
        for batch in batches:
            for i in range(batch.num_rows):
                asked = batch.column(0)[i].values
                ids = np.frombuffer(batch.column(1)[i].as_py(), "<i8")
                v = np.frombuffer(batch.column(2)[i].as_py(), "<f8").reshape(len(ids), -1)
                columns = [np.frombuffer(b, "<f8").reshape(len(ids), -1) for b in batch.column(3)[i].as_py()]
                q_ids, bounds = (asked.field(c).to_numpy(zero_copy_only=False) for c in ("query_id", "bound"))
                found = scan(m, q_ids, matrix(asked.field("q")), ids, v, columns, k, bounds)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["query_id", "vec_id", "score"])

    def probe(queries: DataFrame) -> DataFrame:
        """The best of every probed chunk, for queries (query_id, q, list, bound)."""
        loads = {r["list"]: r["count"] for r in queries.groupBy("list").count().collect()}  # at most MAX_LISTS
        shape = [(i, -(-n // QUERY_BLOCK), -(-sizes[i] // CHUNK)) for i, n in loads.items()]
        blocks = F.broadcast(spark.createDataFrame(shape, "list int, blocks long, chunks long"))
        block = F.pmod(F.xxhash64("query_id", "q"), "blocks")
        grouped = (
            queries.join(blocks, "list").groupBy("list", "chunks", block.alias("block")).agg(F.collect_list(F.struct("query_id", "q", "bound")).alias("queries"))
            .select("list", "queries", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("part"))
        )
        return grouped.join(stored, ["list", "part"]).select("queries", "ids", "vecs", "blocks").mapInArrow(with_room(find), "query_id long, vec_id long, score double")

    # The nearest lists first: their k-th score bounds what the others need to reach.
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    rank = F.row_number().over(best)
    near = probe(asked.where("first").withColumn("bound", F.lit(float("-inf"))))
    near = staged(near.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank"), "ann-first")
    bounds = near.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(float("-inf")).alias("bound"))
    rest = staged(asked.where("not first").join(bounds, "query_id", "left").na.fill({"bound": float("-inf")}), "ann-rest")
    found = near.unionByName(probe(rest))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
