"""Minimax contiguous partition of atomic groups into shards.

Groups are rows of equal text (all nulls are one group), kept whole and ordered by the SHA-256 of
their text. The smallest capacity is found for which a greedy walk over that order needs no more
than the given number of shards, and the order is cut there. A row's shard then follows from its
digest and the cuts alone: no join, whatever the size of a group.

A group above the mean shard size fills a shard by itself (it would otherwise set the capacity of
all others) and the rest is cut anew over the shards that are left, if no shard comes out larger than
the smallest capacity of all. Where one does, the plain walk's cuts stay. The largest runs of
several groups are then halved until all shards are in use.

The walk needs running totals at a few places only. They are Spark's (a range shuffle of one
narrow row per group); the driver holds at most ``limit`` of them at a time, evenly spaced at
first, then those between the bounds that the search has reached, until the answer is exact.

Null text: size 8, crc32 0. Empty table: no rows. Fewer groups than shards: shards stay empty.
"""

from __future__ import annotations

import bisect
from functools import reduce
from itertools import pairwise

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.llm.common import numbered, text_or_empty
from patronlens.plans.tables import staged


class Totals:
    """Running totals of an ordered list of sizes, known in places."""

    def __init__(self, total: int, rows: int, fetch, limit: int):
        self.at, self.row = [0, total], [0, rows]
        self.fetch, self.limit = fetch, limit

    def add(self, known: list[tuple[int, int]]) -> None:
        merged = sorted({*zip(self.at, self.row, strict=True), *known})
        self.at, self.row = [a for a, _ in merged], [r for _, r in merged]

    def refine(self, spans: list[tuple[int, int]]) -> None:
        """Learn more totals within the spans (positions in bytes)."""
        rows = 0
        for lo, hi in spans:
            i, j = bisect.bisect_right(self.at, lo) - 1, bisect.bisect_left(self.at, hi)
            rows += self.row[j] - self.row[i]
        stride, known = -(-rows // self.limit), len(self.at)
        while len(self.at) == known and stride >= 1:  # spans of fewer rows than the stride: all of them
            self.add(self.fetch(spans, stride))
            stride = stride // 2

    def cut(self, start: int, end: int, capacity: int, hopeful: bool) -> int:
        """The furthest cut within capacity; where totals are not known, the best or worst case."""
        goal = min(start + capacity, end)
        i = bisect.bisect_right(self.at, goal) - 1
        if hopeful and self.at[i] < goal and self.row[i + 1] - self.row[i] > 1:
            return goal
        return max(self.at[i], start)

    def walk(self, start: int, end: int, capacity: int, shards: int, hopeful: bool) -> list[int] | None:
        cuts, at = [], start
        while at < end:
            to = self.cut(at, end, capacity, hopeful)
            if to == at or len(cuts) == shards:
                return None
            cuts.append(to)
            at = to
        return cuts

    def smallest(self, start: int, end: int, shards: int, hopeful: bool) -> int:
        lo, hi = -(-(end - start) // shards), end - start
        while lo < hi:
            mid = (lo + hi) // 2
            if self.walk(start, end, mid, shards, hopeful) is None:
                lo = mid + 1
            else:
                hi = mid
        return lo

    def minimax(self, start: int, end: int, shards: int) -> list[int]:
        """The ends of at most ``shards`` runs from start to end, the largest as small as can be."""
        if start == end:
            return []
        while True:
            low, high = (self.smallest(start, end, shards, hopeful) for hopeful in (True, False))
            if low == high:
                return self.walk(start, end, high, shards, False)
            first, last = (self.walk(start, end, c, shards, h) or [] for c, h in ((low, True), (high, True)))
            worst = start
            spans = []
            for k in range(max(len(first), len(last))):
                worst = self.cut(worst, end, low, False)
                goal = min(last[k] if k < len(last) else end, end)
                i, j = bisect.bisect_right(self.at, worst) - 1, bisect.bisect_left(self.at, goal)
                if any(self.row[x + 1] - self.row[x] > 1 for x in range(i, j)):
                    spans.append((self.at[i], self.at[j]))
            self.refine(merge(spans))


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def balanced_cuts(totals: Totals, total: int, large, shards: int) -> list[int]:
    """Positions of the ends of the shards. ``large(bytes)`` lists (start, size) of groups above."""
    alone: dict[int, int] = {}
    while len(alone) < shards:
        rest, left = total - sum(alone.values()), shards - len(alone)
        more = {a: s for a, s in large(rest // left) if a not in alone}
        if not more:
            break
        room = left - 1
        for a, s in sorted(more.items(), key=lambda x: (-x[1], x[0]))[:room]:
            alone[a] = s
        if room < len(more):
            break
    totals.add([(a, r) for a, r in large.rows.items() if a in alone] + [(a + alone[a], r + 1) for a, r in large.rows.items() if a in alone])
    segments, at = [], 0
    for a, s in sorted(alone.items()):
        segments.append((at, a))
        at = a + s
    segments = [x for x in [*segments, (at, total)] if x[0] < x[1]]
    left = shards - len(alone)
    if len(segments) > left:  # as many large groups as shards: only a plain walk fits
        return totals.minimax(0, total, shards)
    given = {x: 1 for x in segments}
    for _ in range(left - len(segments)):  # the next shard goes where shards are largest
        if segments:
            given[max(segments, key=lambda x: ((x[1] - x[0]) / given[x], -x[0]))] += 1
    return sorted([a + s for a, s in alone.items()] + [c for (lo, hi), k in given.items() for c in totals.minimax(lo, hi, k)])


def largest(cuts: list[int]) -> int:
    return max(b - a for a, b in pairwise([0, *sorted(cuts)]))


def split_further(totals: Totals, cuts: list[int], shards: int) -> list[int]:
    """Halve the largest runs of several groups until there are as many runs as shards: none grows."""
    whole = set()  # runs of one group
    while len(cuts) < shards:
        runs = [(b - a, a, b) for a, b in pairwise([0, *cuts]) if (a, b) not in whole]
        if not runs:
            break
        _, a, b = max(runs)
        parts = totals.minimax(a, b, 2)
        if len(parts) < 2:
            whole.add((a, b))
        cuts = sorted({*cuts, *parts})
    return cuts


class Large:
    """(start, size) of the groups above a size: fewer than shards when the size is their mean."""

    def __init__(self, ordered: DataFrame):
        self.ordered, self.rows = ordered, {}

    def __call__(self, size: int) -> list[tuple[int, int]]:
        found = self.ordered.where(F.col("bytes") > size).select("before_bytes", "bytes", "row").collect()
        self.rows |= {r[0]: r[2] for r in found}
        return [(r[0], r[1]) for r in found]


def minimax_cuts(groups: DataFrame, shards: int, limit: int = 100_000) -> list[str]:
    """The first key of each shard but the first, for groups (key, bytes), bytes positive."""
    ordered = numbered(groups, None, ["key"], ["bytes"], "shard-groups")
    total, rows = ordered.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count(F.lit(1))).first()
    if rows == 0:
        return []

    def fetch(spans: list[tuple[int, int]], stride: int) -> list[tuple[int, int]]:
        where = reduce(lambda a, b: a | b, [F.col("before_bytes").between(lo, hi) for lo, hi in spans])
        return [tuple(r) for r in ordered.where(where & (F.col("row") % stride == 0)).select("before_bytes", "row").collect()]

    totals = Totals(int(total), rows, fetch, limit)
    totals.refine([(0, int(total))])
    cuts = balanced_cuts(totals, int(total), Large(ordered), shards)
    best = totals.minimax(0, int(total), shards)
    if largest(cuts) > largest(best):  # a group above the mean stood between groups it had better been joined with
        cuts = best
    cuts = split_further(totals, cuts, shards)
    inner = [c for c in cuts if c < total]
    keys = [r[0] for r in ordered.where(F.col("before_bytes").isin(inner)).select("key").collect()] if inner else []
    return sorted(keys)


def shard_documents(docs: DataFrame, shards: int = 24, limit: int = 100_000) -> DataFrame:
    """doc_id, size, text_crc32, text_sha256, shard and slot of every row of (doc_id, text)."""
    raw = text_or_empty().cast("binary")
    rows = staged(
        docs.select(
            "doc_id",
            (F.octet_length(raw) + 8).cast("long").alias("size"),
            F.crc32(raw).alias("text_crc32"),
            F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit("")).alias("text_sha256"),
        ),
        "shard-rows",
    )
    groups = staged(rows.groupBy(F.col("text_sha256").alias("key")).agg(F.sum("size").alias("bytes")), "shard-sizes")
    cuts = minimax_cuts(groups, shards, limit)
    shard = F.lit(0)
    for c in cuts:
        shard = shard + (F.col("text_sha256") >= c).cast("int")
    placed = numbered(rows.withColumn("shard", shard), "shard", ["text_sha256", "doc_id"], [], "shard-slots")
    return placed.withColumnRenamed("row", "slot")
