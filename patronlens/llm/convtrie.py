"""Prefix trie of conversations in tables addressed by minimal perfect hashes.

A node is a distinct beginning of rebuilt conversations, known by a 128-bit digest that grows with
every turn: the sum over the turns of a hash of (place, role, text), in four limbs. Sums are
running totals, so one range shuffle of narrow rows gives every conversation's digests, whatever the
length of one conversation; texts are read once and stay behind.

Distinct nodes are counted by digest and then placed in shards of whole subtrees. A shard lays its
nodes out by a minimal perfect hash of their digests (bit arrays by level, a rank is the slot),
checks the digest stored in a slot against the one looked up, so that no other node's slot is ever
taken, scatters the counts into flat arrays over the slots, turns parents into slots, and adds
children to parents from the deepest level up.

A subtree too large for a shard is cut. The rows below a node (what its members still have to say)
bound its subtree; tier 0 are the nodes with at most ``shard_rows`` of them, each further tier takes
``TIER`` times more. Within a tier, the topmost nodes head the shards. Tiers are summed from the
lowest; a head hands its sums to its parent in a higher tier as one row. A hot first turn thus lies
in a higher tier and what follows it in many shards. A tier is a round; their number is the logarithm
of the rows under the hottest node, and the root is always summed last, over rows of its children.

The digest over a node's ends is sequential by its nature. Ids are sorted in ranges and joined to
long strings there; the one task that hashes a node's strings streams them in order.

Order of turns: null first; ties by role, then by digest of the text. Rows without a conv_id belong
to no conversation. Null role or text: empty. Very long texts: hashed where they are read. Repeated
rows are turns. Empty table: no conversation, no root, no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.llm.common import U64, mix, numbered, small_batches
from patronlens.plans.tables import staged

SHARD_ROWS = 1 << 16
TIER = 256
LIMBS = ["l0", "l1", "l2", "l3"]
HEAD_TURNS = 6  # a conversation takes over fewer turns than this
ENDS = 4096  # ids in one string

NODE = ["k1", "k2"]
PARENT = ["p1", "p2"]


def _limbs(digest: Column) -> list[Column]:
    """The first 128 bits of a digest in hex as four numbers of 32 bits."""
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(c) for i, c in enumerate(LIMBS)]


def _key(sums: list[Column]) -> list[Column]:
    """Four limb totals, modulo 2**32 each, as two longs."""
    low = F.lit((1 << 32) - 1)
    a, b, c, d = (x.bitwiseAND(low) for x in sums)
    return [F.shiftleft(a, 32).bitwiseOR(b), F.shiftleft(c, 32).bitwiseOR(d)]


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, row, digest, chars): the turns of each conversation in order, texts as digests."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    narrow = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), role.alias("role"),
        F.unhex(F.substring(said, 1, 32)).alias("digest"), F.length(text).cast("long").alias("chars"),
    )
    return numbered(staged(narrow, "trie-said"), "conv_id", ["turn", "role", "digest"], [], "trie-turns").drop("turn", "role")


def rebuilt(ordered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of rebuilt conversations (conv_id, place from 1, length, digest, chars), and every
    conversation with its length (conv_id, length), turnless ones included."""
    convs = staged(ordered.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")), "trie-convs")
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD_TURNS
    base = F.col("conv_id") - F.col("conv_id") % 100
    lengths = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    told = convs.select("conv_id", "own", taken.alias("h"), base.alias("base")).join(lengths, "base", "left")
    first = F.least(F.col("h"), F.coalesce("base_own", F.lit(0)))
    plan = staged(
        told.select("conv_id", "base", "h", first.alias("first"), (first + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")),
        "trie-plan",
    )
    heads = ordered.where(F.col("row") < HEAD_TURNS - 1).select(F.col("conv_id").alias("base"), "row", "digest", "chars")
    taken_over = plan.where("first > 0").join(heads, "base").where("row < first")
    own = ordered.join(plan, "conv_id").where("row >= h")
    columns = ["conv_id", "length", "digest", "chars"]
    rows = taken_over.select((F.col("row") + 1).alias("place"), *columns).unionByName(
        own.select((F.col("first") + F.col("row") - F.col("h") + 1).alias("place"), *columns)
    )
    return rows, plan.select("conv_id", "length")


def paths(rows: DataFrame) -> DataFrame:
    """(conv_id, place, length, chars) with the digests of the beginning up to here and up to the
    turn before."""
    said = F.sha2(F.concat(F.col("place").cast("string").cast("binary"), F.col("digest")), 256)
    limbs = staged(rows.select("conv_id", "place", "length", "chars", *_limbs(said)), "trie-limbs")
    summed = numbered(limbs, "conv_id", ["place"], LIMBS, "trie-paths")
    before = [F.col(f"before_{c}") for c in LIMBS]
    here = _key([F.col(c) + b for c, b in zip(LIMBS, before, strict=True)])
    return summed.select(
        "conv_id", "place", "length", "chars", *(c.alias(n) for c, n in zip(here, NODE, strict=True)),
        *(c.alias(n) for c, n in zip(_key(before), PARENT, strict=True)),
    )


# --- Minimal perfect hash ------------------------------------------------------------------------


class PerfectHash:
    """Slots 0 to n-1 for n distinct keys of two longs. A key that is the only one at its place of a
    level's bit array lives there, the others go on to the next level; a slot is a bit's rank."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.marks: list[np.ndarray] = []
        self.ranks: list[np.ndarray] = []
        left, done = np.arange(len(a)), 0
        while len(left):
            at = self._places(a[left], b[left], len(self.marks), size := 2 * len(left))
            alone = np.bincount(at, minlength=size) == 1
            rank = done + np.cumsum(alone) - alone
            self.marks.append(alone)
            self.ranks.append(rank)
            done += int(alone.sum())
            left = left[~alone[at]]

    @staticmethod
    def _places(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = U64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        return (mix(mix(a.view(U64) + seed) ^ b.view(U64)) % U64(size)).astype(np.int64)

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The slot of each key; for a key that was not given, any slot or -1."""
        out, left = np.full(len(a), -1, np.int64), np.arange(len(a))
        for level, (marks, ranks) in enumerate(zip(self.marks, self.ranks, strict=True)):
            at = self._places(a[left], b[left], level, len(marks))
            hit = marks[at]
            out[left[hit]] = ranks[at[hit]]
            left = left[~hit]
        return out


class NodeTable:
    """Nodes of whole subtrees in flat arrays over the slots of a minimal perfect hash."""

    def __init__(self, columns: dict[str, np.ndarray]):
        a, b = columns["k1"], columns["k2"]
        self.hash = PerfectHash(a, b)
        slots = self.hash.slots(a, b)
        self.of: dict[str, np.ndarray] = {}
        for name, values in columns.items():
            flat = np.empty_like(values)
            flat[slots] = values
            self.of[name] = flat
        if not (np.array_equal(self.of["k1"][slots], a) and np.array_equal(self.of["k2"][slots], b)):
            raise ValueError("two nodes in one slot")
        self.parent = self.find(self.of["p1"], self.of["p2"], self.of["depth"] - 1)

    def find(self, a: np.ndarray, b: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Slots of nodes, -1 for what is not in the table: the digest in the slot decides."""
        at = self.hash.slots(a, b)
        same = (at >= 0) & (self.of["k1"][at] == a) & (self.of["k2"][at] == b) & (self.of["depth"][at] == depth)
        return np.where(same, at, -1)

    def accumulate(self) -> None:
        """Add every node's children, leaves and savings to its parent's, deepest first."""
        by_depth = np.argsort(-self.of["depth"], kind="stable")
        depths = self.of["depth"][by_depth]
        cuts = np.flatnonzero(np.diff(depths)) + 1
        children, leaves, saved = self.of["n_children"], self.of["n_leaves"], self.of["saved_tokens"]
        for level in np.split(by_depth, cuts):
            leaves[level] += children[level] == 0
            inner = level[self.parent[level] >= 0]
            above = self.parent[inner]
            np.add.at(children, above, 1)
            np.add.at(leaves, above, leaves[inner])
            np.add.at(saved, above, saved[inner])


COUNTED = ["head1", "head2", "depth", *NODE, *PARENT, "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
SUMMED = ["depth", *NODE, *PARENT, "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "parent_conv_id"]


def sum_subtrees(nodes: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Subtree sums of nodes (COUNTED), a shard per run of whole heads; parent_conv_id is null where
    the parent is in another tier."""
    ordered = nodes.select(*(F.col(c).cast("long").alias(c) for c in COUNTED)).repartition("head1", "head2").sortWithinPartitions("head1", "head2")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
        held: list[dict[str, np.ndarray]] = []
        n = 0
        for batch in batches:
            rows = {c: batch.column(i).to_numpy(zero_copy_only=False) for i, c in enumerate(COUNTED)}
            while len(rows["k1"]):
                size = len(rows["k1"])
                if n < shard_rows:  # room left: up to the next head beyond it
                    at = min(shard_rows - n, size)
                else:
                    at = 0
                last = (rows["head1"][at - 1], rows["head2"][at - 1]) if at else (held[-1]["head1"][-1], held[-1]["head2"][-1])
                other = np.flatnonzero((rows["head1"][at:] != last[0]) | (rows["head2"][at:] != last[1]))
                end = at + int(other[0]) if len(other) else size
                if end:
                    held.append({c: v[:end] for c, v in rows.items()})
                    n += end
                rows = {c: v[end:] for c, v in rows.items()}
                if len(other) and n >= shard_rows:
                    yield {c: np.concatenate([h[c] for h in held]) for c in COUNTED}
                    held, n = [], 0
        if n:
            yield {c: np.concatenate([h[c] for h in held]) for c in COUNTED}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in shards(batches):
            table = NodeTable(columns)
            table.accumulate()
            inner = table.parent >= 0
            up = pa.array(np.where(inner, table.of["conv_id"][table.parent], 0), mask=~inner)
            yield pa.RecordBatch.from_arrays([*(pa.array(table.of[c]) for c in SUMMED[:-1]), up], names=SUMMED)

    return ordered.mapInArrow(run, ", ".join(f"{c} long" for c in SUMMED))


# --- Ends ----------------------------------------------------------------------------------------


def end_digests(ends: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) of ends (k1, k2, conv_id): one hash over each node's ids in order.

    Two shuffles: ids by ranges of (node, id), which splits a node with many; then, in few long
    strings, all of a node in one task, which only feeds its hash and holds one string at a time."""
    ranged = ends.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ENDS):
                part = batch.slice(at, ENDS)
                a, b, ids = (part.column(i).to_numpy() for i in range(3))
                starts = np.concatenate([[0], np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1])
                text = [str(i) for i in ids.tolist()]
                stops = [*starts[1:].tolist(), len(ids)]
                joined = [",".join(text[i:j]) for i, j in zip(starts.tolist(), stops, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(a[starts]), pa.array(b[starts]), pa.array(ids[starts]), pa.array(joined)], names=["k1", "k2", "first", "ids"])

    strings = ranged.mapInArrow(join, "k1 long, k2 long, first long, ids string")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done: list[tuple[int, int, str]] = []
            for a, b, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if now != (a, b):
                    if now is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = (a, b), hashlib.sha256(ids.as_py().encode())
                else:
                    state.update(b"," + ids.as_py().encode())
            yield _digests(done)
        if now is not None:
            yield _digests([(*now, state.hexdigest())])

    def _digests(done: list[tuple[int, int, str]]) -> pa.RecordBatch:
        a, b, c = zip(*done, strict=True) if done else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.string())], names=["k1", "k2", "ends_sha256"])

    by_node = strings.repartition(*NODE).sortWithinPartitions(*NODE, "first").select(*NODE, "ids")
    return by_node.mapInArrow(digest, "k1 long, k2 long, ends_sha256 string")


# --- The trie ------------------------------------------------------------------------------------


def trie(conversations: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per node of the trie over the rebuilt conversations (conv_id, turn, role, text)."""
    spark = conversations.sparkSession
    small_batches(spark)
    rows, convs = rebuilt(turns(conversations))
    way = paths(rows)

    below = F.sum(F.col("length") - F.col("place") + 1)
    tier = F.when(F.col("below") <= shard_rows, 0).otherwise(1 + F.floor(F.log(float(TIER), F.col("below") / float(shard_rows)))).cast("int")
    nodes = staged(
        way.groupBy(F.col("place").alias("depth"), *NODE).agg(
            F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"),
            *(F.max(c).alias(c) for c in PARENT), below.alias("below"),
        ).withColumn("tier", tier),
        "trie-nodes",
    )
    # The head of a node: the topmost node of its tier on the way of its conversation. Higher
    # tiers are few; all other nodes are of tier 0.
    high = nodes.where("tier > 0").select(F.col("depth").alias("place"), *NODE, "tier")
    tiered = way.select("conv_id", "place", *NODE).join(high, ["place", *NODE], "left").fillna(0, ["tier"])
    tops = tiered.groupBy("conv_id", "tier").agg(F.min_by(F.struct(*NODE), "place").alias("top"))
    heads = tops.select("conv_id", "tier", F.col("top.k1").alias("head1"), F.col("top.k2").alias("head2"))
    placed = staged(
        nodes.join(heads, ["conv_id", "tier"]).select(
            "tier", "head1", "head2", "depth", *NODE, *PARENT, "conv_id", "n_convs",
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
        ),
        "trie-placed",
    )

    tiers = (placed.agg(F.max("tier")).first()[0] or 0) + 1
    given: list[DataFrame] = []  # sums of subtrees whose parents are in higher tiers
    summed: list[DataFrame] = []
    sums = ["n_children", "n_leaves", "saved_tokens"]
    for now in range(tiers):
        mine = placed.where(F.col("tier") == now)
        if given:
            more = reduce(DataFrame.unionByName, given).groupBy(F.col("depth") - 1, *PARENT).agg(
                F.count(F.lit(1)).alias("c"), F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s")
            ).toDF("depth", *NODE, "c", "l", "s")
            mine = mine.join(more, ["depth", *NODE], "left").withColumn("saved_tokens", F.col("saved_tokens") + F.coalesce("s", F.lit(0)))
        else:
            mine = mine.select("*", *(F.lit(None).cast("long").alias(c) for c in "cl"))
        ready = mine.select(*COUNTED[:9], F.coalesce("c", F.lit(0)).alias("n_children"), F.coalesce("l", F.lit(0)).alias("n_leaves"), "saved_tokens")
        done = staged(sum_subtrees(ready, shard_rows), f"trie-tier-{now}")
        summed.append(done)
        given.append(done.where(F.col("parent_conv_id").isNull() & (F.col("depth") > 1)).select("depth", *PARENT, "n_leaves", "saved_tokens"))
    every = reduce(DataFrame.unionByName, summed)

    # The root: one row of sums over its children, and its own members.
    all_convs = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("c")).first()
    under = every.where("depth = 1").agg(F.count(F.lit(1)).alias("n"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums[1:])).first()
    root = spark.createDataFrame(
        [(0, 0, 0, int(all_convs.c), int(all_convs.n), int(under.n), int(under.n_leaves) or 1, int(under.saved_tokens), None)] if all_convs.n else [],
        "depth long, k1 long, k2 long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, parent_conv_id long",
    )
    smallest = F.lit(all_convs.c).cast("long")
    tops_only = nodes.where("tier > 0").select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("up"))
    named = every.join(tops_only, ["depth", *PARENT], "left").withColumn(
        "parent_conv_id", F.when(F.col("depth") == 1, smallest).otherwise(F.coalesce("parent_conv_id", "up"))
    )
    ends = way.where("place = length").select(*NODE, "conv_id").unionByName(
        convs.where("length = 0").select(F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"), "conv_id")
    )
    nobody = hashlib.sha256(b"").hexdigest()
    found = named.select(*root.columns).unionByName(root).join(end_digests(staged(ends, "trie-ends")), NODE, "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", *sums, F.coalesce("ends_sha256", F.lit(nobody)).alias("ends_sha256")
    )
