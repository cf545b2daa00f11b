"""Toxicity of noisy text: undo the writer's disguise, then score what was meant.

A token is seen as the output of a noisy channel: letters replaced by look-alikes (leetspeak),
repeated, or set apart by spaces and marks. Its lattice holds, for every place, the letters that
may have been meant with the cost of that disguise; Viterbi decoding finds the cheapest reading
under a letter trigram model counted over all documents. Decoded are tokens with a doubled letter,
with a look-alike beside a letter or another look-alike, or with marks between letters, and single
letters or look-alikes set apart, with at least one letter among them. Any other token has one path only.

Restored words (and their beginnings, which inflected and compounded words share) are the features
of a logistic regression, fitted on a bounded sample of labelled rows: about ``fit_rows`` whole
texts drawn by a hash of the id, of which the ``features`` with the highest likelihood ratio are
kept, of those in at least MIN_SUPPORT of these texts. All other passes cover every document. Letters
beyond the first 65,536 code points count as breaks in the letter model. Rows that repeat are scored
alike, and count as often as they come.

Null and empty texts get the score of a text without features. No labelled rows of both kinds:
score 0.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.llm.common import small_batches
from patronlens.plans.tables import staged

FIT_ROWS = 20_000
FEATURES = 4096
MIN_SUPPORT = 5
CACHE = 200_000  # tokens whose features a task remembers, and as many that it met before those
LONG = 64  # letters of a word that is told by its digest; longer tokens are not remembered
LETTERS = 62  # letters with a place of their own in the letter model

# Look-alikes and what they may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¥": "y",
}
COST_LOOKALIKE, COST_KEPT, COST_RUN, COST_GAP, COST_BREAK = 1.0, 10.0, 1.0, 0.5, 3.0
COST_DOUBLED = 2.5  # of reading two equal letters as one: more than a run, as words have doubled letters

_LOOK = "".join(map(re.escape, LOOKALIKES))
_ONE = rf"[^\W_{_LOOK}]|[{_LOOK}]"
_END = rf"[^\w{_LOOK}]"  # what may stand before and after letters set apart
APART = re.compile(rf"(?:(?<={_END})|^)(?:{_ONE})(?:[ \t._*~-]{{1,4}}(?:{_ONE})){{2,}}(?![\w{_LOOK}])")
LETTER = re.compile(r"[^\W\d_]")
WORD = re.compile(r"[^\W\d_]+")
RUN = re.compile(r"([^\W\d_])\1")
TWICE = re.compile(r"(.)\1")
THRICE = re.compile(r"(.)\1\1")
MIXED = re.compile(rf"[^\W\d_](?:[{_LOOK}]|[*~.\-_']+(?:[^\W\d_]|[{_LOOK}]))|[{_LOOK}](?:[^\W\d_{_LOOK}]|[*~.\-_']+[^\W\d_])|[{_LOOK}]{{2}}")
TRIM = "\"'.,;:?)]}[{<>#%&*-_~`\\/"


class Letters:
    """Letter trigram costs in nats, smoothed by bigrams and single letters."""

    def __init__(self, alphabet: str, counts: np.ndarray):
        self.alphabet = alphabet
        self.code = {c: i + 2 for i, c in enumerate(alphabet)}  # 0: break, 1: any other letter
        k = LETTERS + 2
        tri = counts.reshape(k, k, k).astype(float)
        bi, uni = tri.sum(axis=0), tri.sum(axis=(0, 1))
        p1 = (uni + 1) / (uni.sum() + k)
        p2 = (bi + 4 * p1) / (bi.sum(axis=1, keepdims=True) + 4)
        p3 = (tri + 4 * p2[None]) / (tri.sum(axis=2, keepdims=True) + 4)
        self.cost = (-np.log(p3)).astype(np.float32)
        self.memo: dict[tuple[int, int, int], float] = {}

    def step(self, a: int, b: int, c: int) -> float:
        key = (a, b, c)
        got = self.memo.get(key)
        if got is None:
            got = self.memo[key] = float(self.cost[key])
        return got

    def cheapest(self, lattice: list[list[tuple[str, float]]]) -> str:
        """The cheapest reading: one option of each place, by channel cost plus letter model."""
        states = {(0, 0): (0.0, None)}
        for options in [*lattice, [(" ", 0.0)]]:
            then: dict[tuple[int, int], tuple[float, tuple]] = {}
            for (a, b), (cost, path) in states.items():
                for text, extra in options:
                    x, y, total = a, b, cost + extra
                    for c in text:
                        z = 0 if c == " " else self.code.get(c, 1)
                        if not (z == 0 and y == 0):
                            total += self.step(x, y, z)
                            x, y = (0, 0) if z == 0 else (y, z)
                    if (x, y) not in then or total < then[x, y][0]:
                        then[x, y] = (total, (path, text))
            states = then
        _, path = min(states.values(), key=lambda s: s[0])
        out = []
        while path is not None:
            path, text = path
            out.append(text)
        return "".join(reversed(out)).strip()


def lattice(token: str, apart: bool = False, doubled: bool = False) -> list[list[tuple[str, float]]]:
    """What each place of a token may stand for, with the cost of the disguise; with
    ``doubled``, what is written twice is meant twice."""
    places: list[list[tuple[str, float]]] = []
    i = 0
    while i < len(token):
        c = token[i]
        j = i
        while j < len(token) and token[j] == c:
            j += 1
        if apart and not (c.isalnum() or c in LOOKALIKES):
            while j < len(token) and not (token[j].isalnum() or token[j] in LOOKALIKES):
                j += 1  # several separators are one gap
            places.append([("", COST_GAP), (" ", COST_BREAK)])
        elif c in LOOKALIKES:
            n = j - i
            read = [(x, COST_LOOKALIKE) for x in LOOKALIKES[c]]
            if n == 1:
                places.append([*read, (" ", COST_KEPT)])
            else:  # one or two letters, which need not be the same ("11" is "il" as well)
                pairs = [(x + y, 2 * COST_LOOKALIKE) for x in LOOKALIKES[c] for y in LOOKALIKES[c]]
                less, more = (COST_RUN, COST_RUN + 0.5) if n > 2 else (COST_DOUBLED, 0.0)
                places.append([*((x, cost + less) for x, cost in read if not (doubled and n == 2)), *((x, cost + more) for x, cost in pairs), (" ", COST_KEPT * n)])
        elif c.isalpha():
            n = j - i
            places.append([(c, 0.0)] if n == 1 else [(c, COST_DOUBLED), (c + c, 0.0)][doubled:] if n == 2 else [(c, COST_RUN), (c + c, COST_RUN + 0.5)])
        elif c in "*.-_~'":  # marks inside a word
            places.append([("", COST_LOOKALIKE), (" ", COST_GAP)])
        else:
            places.append([(" ", 0.0)])
        i = j
    return places


def undoubled(word: str, model: Letters) -> str:
    """The cheapest reading of a word of letters whose only disguise may be letters written twice.

    The letters beside a pair stay what they are however it is read, and so do all costs but those of
    the three places that touch it: each pair is decided by itself, as in the lattice."""
    code = [model.code.get(c, 1) for c in word]
    out, i = [], 0
    while i < len(word):
        if i + 1 < len(word) and word[i + 1] == word[i]:
            before, k, after = code[i - 1] if i else 0, code[i], code[i + 2] if i + 2 < len(word) else 0
            one = COST_DOUBLED + model.step(before, k, after)
            out.append(word[i] if one <= model.step(before, k, k) + model.step(k, k, after) else word[i : i + 2])
            i += 2
        else:
            out.append(word[i])
            i += 1
    return "".join(out)


def restore_token(token: str, model: Letters) -> str:
    """A lower-case token as meant; the token itself where nothing is disguised."""
    inner = token.strip(TRIM)
    if inner.isalpha() and not THRICE.search(inner):
        if not RUN.search(inner):
            return token
        return " ".join(dict.fromkeys([undoubled(inner, model), inner]))
    if RUN.search(inner) or MIXED.search(inner):
        tail = inner.rstrip("!?+(")  # closing marks are punctuation, unless they finish the word
        found = [model.cheapest(lattice(tail))]
        if tail != inner and tail and not tail.isalpha():
            found.append(model.cheapest(lattice(inner)))
        if TWICE.search(inner):  # doubled letters are spelling as well: both readings count
            found.append(model.cheapest(lattice(inner, doubled=True)))
        if not LETTER.search(inner):  # look-alikes alone may be a number
            found.append(inner)
        return " ".join(dict.fromkeys(found))
    return token


def set_apart(low: str) -> list[str]:
    """Stretches of single letters and look-alikes with separators between, at least one a letter."""
    return [m.group() for m in APART.finditer(low) if LETTER.search(m.group())]


def restore(text: str, model: Letters) -> str:
    """A whole text, lower case, with disguised tokens restored."""
    low = text.lower()
    meant = " ".join(restore_token(t, model) for t in low.split())
    joined = [model.cheapest(lattice(t, apart=True)) for t in set_apart(low)]
    return " ".join([meant, *joined])


def word_features(restored: str) -> list[str]:
    """Words as ``w:``, beginnings of 4, 5 and 6 letters as ``p:``."""
    found = []
    for w in WORD.findall(restored):
        if len(w) > 2:
            found.append(f"w:{w}" if len(w) <= LONG else f"w:{hashlib.sha256(w.encode()).hexdigest()}")
        found.extend(f"p:{w[:n]}" for n in (4, 5, 6) if len(w) >= n)
    return found


class Reader:
    """Features of whole texts; distinct tokens are restored once, within a bounded memory: tokens
    not met again are forgotten, long ones are not remembered."""

    def __init__(self, model: Letters, index: dict[str, int] | None = None):
        self.model, self.index, self.seen, self.older = model, index, {}, {}

    def of_token(self, token: str) -> tuple:
        out = self.older.get(token)
        if out is None:
            found = word_features(restore_token(token, self.model))
            if self.index is not None:
                found = [self.index[f] for f in found if f in self.index]
            out = tuple(found)
        if len(token) <= LONG:
            self.seen[token] = out
        return out

    def features(self, text: str | None) -> set:
        if not text:
            return set()
        low = text.lower()
        if len(self.seen) > CACHE:
            self.seen, self.older = {}, self.seen
        seen, out = self.seen, set()
        for t in set(low.split()):
            f = seen.get(t)
            if f is None:
                f = self.of_token(t)
            if f:
                out.update(f)
        for t in set_apart(low):
            found = word_features(self.model.cheapest(lattice(t, apart=True)))
            out.update(found if self.index is None else (self.index[f] for f in found if f in self.index))
        return out


def code_points(texts: list[str]) -> np.ndarray:
    return np.frombuffer(" ".join(texts).lower().encode("utf-32-le", "replace"), np.uint32)


def fit_letters(docs: DataFrame) -> Letters:
    """Letter trigrams of all documents; the alphabet is that of their most frequent letters."""
    def letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                points = code_points([t for t in batch.column(0).slice(at, 512).to_pylist() if t])
                total += np.bincount(points[points < 1 << 16], minlength=1 << 16)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"c": at.astype(np.int32), "n": total[at]}, schema=pa.schema([("c", pa.int32()), ("n", pa.int64())]))

    counts = docs.select("text").mapInArrow(letters, "c int, n long").groupBy("c").agg(F.sum("n").alias("n")).collect()  # 65,536 at most
    common = sorted(((r["n"], chr(r["c"])) for r in counts if not 0xD800 <= r["c"] < 0xE000 and chr(r["c"]).isalpha()), reverse=True)
    alphabet = "".join(c for _, c in common[:LETTERS])
    k = LETTERS + 2

    def trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = np.zeros(1 << 16, np.int32)
        for c in range(1 << 16):
            if not 0xD800 <= c < 0xE000 and chr(c).isalpha():
                code[c] = 1
        for i, c in enumerate(alphabet):
            code[ord(c)] = i + 2
        total = np.zeros(k**3, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                points = code_points([t for t in batch.column(0).slice(at, 512).to_pylist() if t])
                x = np.concatenate([[0, 0], code[np.minimum(points, (1 << 16) - 1)], [0]]).astype(np.int32)
                a, b, c = x[:-2].copy(), x[1:-1], x[2:]
                a[b == 0] = 0  # nothing is remembered across a break
                total += np.bincount((a * k + b) * k + c, minlength=k**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"c": at.astype(np.int32), "n": total[at]}, schema=pa.schema([("c", pa.int32()), ("n", pa.int64())]))

    found = docs.select("text").mapInArrow(trigrams, "c int, n long").groupBy("c").agg(F.sum("n").alias("n")).toArrow()  # 262,144 at most
    table = np.zeros(k**3, np.int64)
    table[found.column("c").to_numpy()] = found.column("n").to_numpy()
    return Letters(alphabet, table)


class Model:
    """Letter model, features and their weights."""

    def __init__(self, letters: Letters, index: dict[str, int], weights: np.ndarray, bias: float):
        self.letters, self.index, self.weights, self.bias = letters, index, weights, bias

    def score(self, found: set) -> float:
        z = self.bias + float(sum(self.weights[i] for i in sorted(found)))
        return 1.0 / (1.0 + math.exp(-max(min(z, 500.0), -500.0)))


def fit(docs: DataFrame, labelled: DataFrame, fit_rows: int = FIT_ROWS, features: int = FEATURES) -> Model:
    """Letter model from all docs (text); classifier from labelled rows (doc_id, text, toxic)."""
    spark = docs.sparkSession
    small_batches(spark)
    letters = fit_letters(docs)
    labelled = labelled.where("toxic is not null")
    rows = labelled.count()
    draw = F.crc32(F.concat(F.lit("fit:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    sample = staged(labelled.where(draw * F.lit(float(rows)) < F.lit(fit_rows) * F.lit(float(1 << 32))).select("text", F.col("toxic").cast("int").alias("toxic")).repartition(max(1, min(64, fit_rows // 500))), "toxic-sample")
    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(totals) != {0, 1}:
        return Model(letters, {}, np.zeros(0), -500.0)
    shared = spark.sparkContext.broadcast(letters)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for batch in batches:
            n = {0: Counter(), 1: Counter()}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n[toxic].update(reader.features(text))
            for toxic, found in n.items():
                yield pa.RecordBatch.from_pydict({"f": list(found), "toxic": [toxic] * len(found), "n": list(found.values())}, schema=pa.schema([("f", pa.string()), ("toxic", pa.int32()), ("n", pa.int64())]))

    counted = sample.mapInArrow(count, "f string, toxic int, n long").groupBy("f").agg(
        F.coalesce(F.sum(F.when(F.col("toxic") == 1, F.col("n"))), F.lit(0)).alias("a"),
        F.coalesce(F.sum(F.when(F.col("toxic") == 0, F.col("n"))), F.lit(0)).alias("b"),
    )
    n1, n0 = float(totals[1]), float(totals[0])

    def part(x, expected):
        return F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)

    both = F.col("a") + F.col("b")
    a, b, e1, e0 = F.col("a"), F.col("b"), both * (n1 / (n0 + n1)), both * (n0 / (n0 + n1))
    ratio = part(a, e1) + part(b, e0) + part(n1 - a, n1 - e1) + part(n0 - b, n0 - e0)
    best = counted.where(both >= MIN_SUPPORT).orderBy(ratio.desc(), "f").limit(features).collect()
    index = {r["f"]: i for i, r in enumerate(best)}
    if not index:
        return Model(letters, {}, np.zeros(0), math.log(n1 / n0))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value, index)
        for batch in batches:
            found = [sorted(reader.features(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"i": found, "label": batch.column(1).cast(pa.float64())}, schema=pa.schema([("i", pa.list_(pa.int32())), ("label", pa.float64())]))

    size = len(index)
    to_vector = F.udf(lambda i: SparseVector(size, i, [1.0] * len(i)), VectorUDT())
    rows = staged(sample.mapInArrow(vectors, "i array<int>, label double"), "toxic-vectors")
    fitted = LogisticRegression(regParam=0.0003, elasticNetParam=0.0, maxIter=60, standardization=False).fit(rows.select(to_vector("i").alias("features"), "label"))
    return Model(letters, index, fitted.coefficients.toArray(), float(fitted.intercept))


def predict(docs: DataFrame, model: Model, keep: list[str], names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """Columns ``keep`` of docs with the score of the whole text and whether it is at least 0.5.
    ``names`` are those of the two new columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())])
    read = keep if "text" in keep else [*keep, "text"]
    at = read.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        reader = Reader(m.letters, m.index)
        for whole in batches:
            for first in range(0, whole.num_rows, 512):
                batch = whole.slice(first, 512)
                score = np.array([m.score(reader.features(t)) for t in batch.column(at).to_pylist()], float)
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=schema.names)

    return docs.select(*read).mapInArrow(run, schema)
