"""What several of the operators need: reading, staging, distributed ranks, hashes."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.plans.tables import staged

U64 = np.uint64
WORKERS = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2", "MALLOC_TRIM_THRESHOLD_": "1048576"}
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one of the given tables; columns it has besides are not read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def small_batches(spark: SparkSession, size: str = "16m") -> None:
    """Bound the bytes, not only the rows, of the batches that Python tasks read (a smaller bound
    that the session has stays), let Python workers give memory back that they no longer use, and
    let them find this package where it lies on the driver's path only."""
    workers = spark.sparkContext.environment
    for name, value in WORKERS.items():
        workers.setdefault(name, value)
    paths = workers.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        workers["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    option = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(option, "67108864b").rstrip("b") in ("67108864", "64m", "-1"):  # as Spark ships it
        spark.conf.set(option, size)


KEPT_FREE, MAPPED = 64 << 20, 32 << 20


def _heap(free: int, mapped: int) -> bool:
    """Tell the C library how much freed memory to keep and from what size arrays are mapped apart."""
    try:
        libc = ctypes.CDLL("libc.so.6")
    except OSError:  # another C library: its own defaults
        return False
    libc.mallopt(-1, free)
    libc.mallopt(-3, mapped)
    libc.malloc_trim(0)
    return True


def give_back() -> None:
    """Give freed memory back now, and from now on as WORKERS has it."""
    _heap(int(WORKERS["MALLOC_TRIM_THRESHOLD_"]), 128 << 10)


def with_room(run: Callable) -> Callable:
    """A task function that works on large arrays: while it runs, its worker keeps the memory of one
    array for the next. Giving all of it back each time (WORKERS) makes the kernel clear every array
    anew, which takes six times as long as what is done with them."""

    @wraps(run)
    def roomy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _heap(KEPT_FREE, MAPPED)
        try:
            yield from run(batches)
        finally:
            give_back()

    return roomy


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def remainder(column: str, n: int) -> Column:
    """crc32 of the value written as text, modulo ``n``; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def numbered(df: DataFrame, group: str | None, order: list[str], sums: list[str], name: str) -> DataFrame:
    """Add ``row``, the rank from 0 within ``group``, and ``before_<c>``, the sum of ``c`` over
    the rows ahead, in the order of ``order``; the result is a staged table.

    One range shuffle on (group, order), so neither one large group nor the whole table meets in
    one task: each task counts its own sorted rows. Only the first group of a partition can have
    begun in an earlier one, so what is carried over is one number per partition. ``order`` should
    be unique within a group; rows that tie are numbered in any order. ``df`` is read twice (Spark
    samples it for the ranges) and so had better be a staged table. Null sums count as 0, null
    groups are a group of their own.
    """
    spark = df.sparkSession
    small_batches(spark)
    keys = [group] if group else []
    ordered = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    added = [T.StructField("row", T.LongType()), *(T.StructField(f"before_{c}", T.LongType()) for c in sums)]
    schema = T.StructType([*df.schema.fields, *added, T.StructField("_part", T.IntegerType()), T.StructField("_nth", T.IntegerType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, nth, carried = None, 0, [0] * (1 + len(sums))
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            fresh = np.zeros(n, bool)
            if group:
                values = batch.column(batch.schema.get_field_index(group)).dictionary_encode(null_encoding="encode")
                codes = values.indices.to_numpy(zero_copy_only=False)
                fresh[1:] = codes[1:] != codes[:-1]
                first, end = (values.dictionary[int(codes[i])].as_py() for i in (0, -1))
                fresh[0] = last is not None and last != (first,)
                last = (end,)
            starts = np.flatnonzero(fresh)
            out = []
            for k, c in enumerate([None, *sums]):
                v = np.ones(n, np.int64) if c is None else batch.column(batch.schema.get_field_index(c)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                total = np.cumsum(v)
                before = total - v + carried[k]
                if len(starts):
                    base = np.zeros(n, np.int64)
                    base[starts] = before[starts]
                    before = before - np.maximum.accumulate(base) if (v >= 0).all() else before - base[np.maximum.accumulate(np.where(fresh, np.arange(n), 0))]
                carried[k] = int(before[-1] + v[-1])
                out.append(pa.array(before))
            ranks = nth + np.cumsum(fresh)
            nth = int(ranks[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, *out, pa.array(np.full(n, part, np.int32)), pa.array(ranks.astype(np.int32))], names=schema.names)

    counted = staged(ordered.mapInArrow(count, schema), name)
    totals = [F.count(F.lit(1)).alias("n"), *(F.coalesce(F.sum(c), F.lit(0)).alias(f"s_{c}") for c in sums)]
    ends = counted.groupBy("_part").agg(F.max("_nth").alias("last"))
    # Two rows a partition at most: its first group and its last.
    per_part = (
        counted.groupBy("_part", "_nth").agg(*totals, *([F.first(group).alias("g")] if group else [F.lit(0).alias("g")]))
        .join(F.broadcast(ends), "_part").where("_nth = 0 or _nth = last")
        .orderBy("_part", "_nth").collect()
    )
    offsets, open_group, carried = [], None, [0] * (1 + len(sums))
    for r in per_part:
        mine = [r["n"], *(r[f"s_{c}"] for c in sums)]
        if open_group != (r["g"],):
            open_group, carried = (r["g"],), [0] * (1 + len(sums))
        elif r["_nth"] == 0:
            offsets.append((r["_part"], 0, *carried))
        carried = [a + int(b) for a, b in zip(carried, mine, strict=True)]
    shift = spark.createDataFrame(offsets or [(-1, 0, *carried)], "_part int, _nth int, o_row long" + "".join(f", o_{i} long" for i in range(len(sums))))
    joined = counted.join(F.broadcast(shift), ["_part", "_nth"], "left")
    fixed = {"row": F.col("row") + F.coalesce("o_row", F.lit(0))}
    fixed |= {f"before_{c}": F.col(f"before_{c}") + F.coalesce(f"o_{i}", F.lit(0)) for i, c in enumerate(sums)}
    return joined.select(*df.columns, *(v.alias(k) for k, v in fixed.items()))


def drop(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more: all that was made of them is written."""
    for df in tables:
        files = df.inputFiles()
        if files:
            spark = df.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# --- Hashes over many texts at once ---------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if len(_powers[0]) < n:
        for k, b in enumerate((BASE, INVERSE)):
            _powers[k] = np.concatenate([np.ones(1, U64), np.cumprod(np.full(max(n, 1 << 16) - 1, b, U64), dtype=U64)])
    return _powers[0][:n], _powers[1][:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for each span: a polynomial, mixed with the span's length."""
    up, down = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, U64)
    np.cumsum((values.astype(U64) + U64(1)) * up[:-1], dtype=U64, out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))
