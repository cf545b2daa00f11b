"""Audit of a chain of filters: what each removes in every order in which they may be applied.

Every document has a failure mask, one bit a filter. Masks are counted per part, with how many of
those documents are good or toxic; from there on the input is at most 2**filters rows a part.
A part's counts become a decision diagram: one level a filter, a node for every distinct function
of the filters below it, terminals the distinct count vectors, and in every node the counts of all
masks below it. Two adjacent filters change places by swapping two adjacent levels, which rebuilds
only these two; plain changes (each order one such swap from the last) visit all orders. In each
order the path on which everything passes gives the steps: the failing branch of a level holds
what the filter of that level removes, the passing branch what stays.

A filter's removals are all its failures where it comes first, and the failures of nobody else
where it comes last, so redundant and unique failures and the Shapley sum come from the same paths.

Nulls: a null text is empty; a null language is the part ''. Copies: a text is a copy if a smaller
id has the same text; rows without an id are copies of nothing and make no copies, rows that agree
in id and text are not copies of one another. Labels: several rows of one id count once (good if
any says so). Very long texts: read whole, one row at a time. Empty table: no part, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
BREAK = r"[\x20\x09-\x0D]+"
WEIGHTS = ("n", "good", "toxic")

STEPS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def text_failures(text: Column) -> list[Column]:
    """Conditions A to D on a text that is not null: short, repetitive, shouting, marked up."""
    words = F.filter(F.split(text, BREAK), lambda w: w != "")
    return [
        F.size(words) < 100,
        F.lit(100) * F.size(F.array_distinct(words)) < F.lit(80) * F.size(words),
        F.lit(100) * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > F.lit(10) * F.length(text),
        text.rlike("[#$%&*|]"),
    ]


def bits(conditions: Sequence[Column]) -> Column:
    """Condition i as bit i."""
    total = F.lit(0)
    for i, failed in enumerate(conditions):
        total = total + F.when(failed, 1 << i).otherwise(0)
    return total


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic) of docs (doc_id, text, lang) and labels (doc_id, quality, toxic).

    Texts are read once, into a digest and four bits. Equal rows are counted first, so neither a
    much repeated text nor a much repeated row is ever gathered: per (text, part) only sums and the
    counts of the smallest id remain, and the smallest id of a text is a minimum over its parts.
    """
    text = F.coalesce("text", F.lit(""))
    read = docs.select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), bits(text_failures(text)).alias("mask"),
    )
    rows = read.groupBy("digest", "part", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.first("mask").alias("mask"))
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    marked = rows.join(marks, "doc_id", "left").select(
        "digest", "part", "mask", "doc_id", "n", *((F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in WEIGHTS[1:])
    )
    counts = F.struct(*WEIGHTS)
    no_id = F.col("doc_id").isNull()
    per_part = marked.groupBy("digest", "part").agg(
        F.first("mask").alias("mask"), F.min("doc_id").alias("least"), F.min_by(F.when(~no_id, counts), "doc_id").alias("first"),
        *(F.sum(c).alias(c) for c in WEIGHTS), *(F.sum(F.when(no_id, F.col(c)).otherwise(0)).alias(f"free_{c}") for c in WEIGHTS),
    )
    least = per_part.groupBy("digest").agg(F.min("least").alias("smallest"))
    joined = per_part.join(least, "digest")
    original = [
        F.col(f"free_{c}") + F.when(F.col("least") == F.col("smallest"), F.col(f"first.{c}")).otherwise(0) for c in WEIGHTS
    ]
    here = [F.struct("mask", *(o.alias(c) for o, c in zip(original, WEIGHTS, strict=True)))]
    here += [F.struct((F.col("mask") + 16).alias("mask"), *((F.col(c) - o).alias(c) for o, c in zip(original, WEIGHTS, strict=True)))]
    split = joined.select("part", F.explode(F.array(*here)).alias("r")).select("part", "r.*").where("n > 0")
    return split.groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in WEIGHTS))


class Diagram:
    """A count-weighted decision diagram over ``order``; nodes of one level share what is equal.

    ``levels[i]`` maps a node's number to (passing, failing) numbers of the level below; the last
    level's children are terminals. ``weights`` holds the counts below every node and terminal.
    """

    def __init__(self, counts: dict[int, tuple[int, ...]], width: int, size: int):
        self.order = list(range(width))
        self.weights: list[tuple[int, ...]] = []
        self.levels: list[dict[int, tuple[int, int]]] = [{} for _ in range(width)]
        self.unique: list[dict] = [{} for _ in range(width)]
        self.terminals: dict[tuple[int, ...], int] = {}
        self.zero = (0,) * size
        self.counts = counts
        self.root = self._build(0, 0)

    def _terminal(self, value: tuple[int, ...]) -> int:
        if value not in self.terminals:
            self.terminals[value] = len(self.weights)
            self.weights.append(value)
        return self.terminals[value]

    def _node(self, level: int, passing: int, failing: int) -> int:
        key = (passing, failing)
        found = self.unique[level].get(key)
        if found is None:
            found = self.unique[level][key] = len(self.weights)
            self.levels[level][found] = key
            self.weights.append(tuple(a + b for a, b in zip(self.weights[passing], self.weights[failing], strict=True)))
        return found

    def _build(self, level: int, mask: int) -> int:
        if level == len(self.order):
            return self._terminal(self.counts.get(mask, self.zero))
        return self._node(level, self._build(level + 1, mask), self._build(level + 1, mask | 1 << self.order[level]))

    def swap(self, level: int) -> None:
        """Exchange the filters of a level and the one below. Nodes of the level keep their number:
        what they stand for is the same, so nothing above changes, and nothing below is touched."""
        upper, lower = self.levels[level], self.levels[level + 1]
        self.levels[level + 1], self.unique[level + 1], self.unique[level] = {}, {}, {}
        for node, (passing, failing) in upper.items():
            (pp, pf), (fp, ff) = lower[passing], lower[failing]
            upper[node] = key = (self._node(level + 1, pp, fp), self._node(level + 1, pf, ff))
            self.unique[level][key] = node
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def all_pass(self) -> Iterator[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """Along the path on which everything passes: filter, counts that stay, counts removed."""
        node = self.root
        for level, which in enumerate(self.order):
            passing, failing = self.levels[level][node]
            yield which, self.weights[passing], self.weights[failing]
            node = passing


def plain_changes(n: int) -> Iterator[int]:
    """Places whose exchange with the next, one after the other, visits all orders of n things."""
    if n < 2:
        return
    inner, down = plain_changes(n - 1), True
    while True:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        step = next(inner, None)
        if step is None:
            return
        yield step + 1 if down else step  # the largest has come to the front, or is at the end
        down = not down


def steps(part: str, counts: dict[int, tuple[int, ...]], letters: str) -> pd.DataFrame:
    """All orders of one part, a row per order and step."""
    width = len(letters)
    diagram = Diagram(counts, width, len(WEIGHTS))
    walks = {}
    changes = plain_changes(width)
    while True:
        walks["".join(letters[i] for i in diagram.order)] = list(diagram.all_pass())
        change = next(changes, None)
        if change is None:
            break
        diagram.swap(change)
    shapley, fails, unique = [0] * width, [0] * width, [0] * width
    for walk in walks.values():
        for which, _, removed in walk:
            shapley[which] += removed[0]
        fails[walk[0][0]], unique[walk[-1][0]] = walk[0][2][0], walk[-1][2][0]
    rows = [
        (part, order, step, kept[0], gone[0], fails[which] - gone[0], unique[which], gone[1], gone[2], shapley[which])
        for order, walk in sorted(walks.items())
        for step, (which, kept, gone) in enumerate(walk, 1)
    ]
    return pd.DataFrame(rows, columns=[c.split()[0] for c in STEPS.split(", ")])


def audit(counts: DataFrame, letters: str = FILTERS) -> DataFrame:
    """Every order and step per part, of (part, mask, n, good, toxic); bit i is ``letters[i]``.

    A group is one part with at most a row per mask, whatever the documents."""

    def of_part(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        masks = {int(r[0]): tuple(int(x) for x in r[1:]) for r in rows[["mask", *WEIGHTS]].itertuples(index=False)}
        return steps(key[0], masks, letters)

    return counts.groupBy("part").applyInPandas(of_part, STEPS)
