"""The filter audit and the prefix trie against brute force and on odd rows."""

import hashlib
import random
import re
import zlib
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronlens.llm import convtrie, filteraudit

# --- filter audit ----------------------------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_masks(docs, labels):
    good, toxic = ({d for d, *marks in labels if d is not None and marks[i] == 1} for i in (0, 1))
    smallest = {}
    for d, text, _ in docs:
        if d is not None:
            smallest[text or ""] = min(d, smallest.get(text or "", d))
    for d, text, lang in docs:
        text = text or ""
        words = WORD.findall(text)
        failed = [
            len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            bool(re.search(r"[#$%&*|]", text)), d is not None and smallest[text] < d,
        ]
        yield lang or "", {c for c, f in zip("ABCDE", failed, strict=True) if f}, d in good, d in toxic


def brute_audit(docs, labels):
    rows = list(brute_masks(docs, labels))
    out = {}
    for part in {p for p, *_ in rows}:
        mine = [r for r in rows if r[0] == part]
        removals = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                fails = [r for r in mine if f in r[1]]
                removals[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(fails) - len(gone), sum(r[1] == {f} for r in mine),
                    sum(r[2] for r in gone), sum(r[3] for r in gone),
                ]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(removals[order[step - 1]])
    return out


def some_documents(rng):
    words = ["alpha", "Beta", "GAMMA", "d#lta", "eps|lon", "été", "x y"] + [f"w{i}" for i in range(150)]
    texts = [None, "", " ", "A", "A\tB\n", "\v\f#", "😀" * 3]
    texts += [" ".join(rng.choices(words[: rng.choice([3, 7, 157])], k=rng.choice([5, 99, 100, 130]))) for _ in range(40)]
    docs = [(rng.choice([None, *range(60)]), rng.choice(texts), rng.choice([None, "", "de", "fr"])) for _ in range(200)]
    docs += docs[:20] + [(7, "copy", "de"), (7, "copy", "de"), (7, "copy", "fr"), (3, "copy", None)]
    labels = [(i % 40, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(60)] + [(None, 1, 1)]
    return docs, labels


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_against_brute_force(spark, seed):
    docs, labels = some_documents(random.Random(seed))
    docs_df = spark.createDataFrame([(*r, 0, "x") for r in docs], "doc_id long, text string, lang string, mask int, part string")
    labels_df = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filteraudit.audit(filteraudit.mask_counts(docs_df.repartition(5), labels_df)).collect()
    want = brute_audit(docs, labels)
    assert {(r.part, r.filter_order, r.step): list(r[3:]) for r in got} == want
    assert len(got) == len(want) == 600 * 3


def test_audit_of_nothing_and_of_other_letters(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filteraudit.audit(filteraudit.mask_counts(docs, labels)).count() == 0
    one = spark.createDataFrame([("p", 0, 5, 1, 0), ("p", 3, 2, 0, 1)], "part string, mask int, n long, good long, toxic long")
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.shapley) for r in filteraudit.audit(one, "XY").collect()}
    assert got == {("XY", 1): (5, 2, 0, 2), ("XY", 2): (5, 0, 2, 2), ("YX", 1): (5, 2, 0, 2), ("YX", 2): (5, 0, 2, 2)}


def test_swaps_share_equal_nodes():
    rng = random.Random(5)
    counts = {m: (rng.randrange(3), 0, 0) for m in range(32)}
    diagram = filteraudit.Diagram(counts, 5, 3)
    for level in [0, 1, 2, 3, 2, 1, 0, 1, 3]:
        diagram.swap(level)
        for nodes in diagram.levels:
            assert len(set(nodes.values())) == len(nodes)
        fresh = filteraudit.Diagram({sum((m >> f & 1) << i for i, f in enumerate(diagram.order)): c for m, c in counts.items()}, 5, 3)
        assert [len(x) for x in fresh.levels] == [len(x) for x in diagram.levels]
        assert [x[1:] for x in fresh.all_pass()] == [x[1:] for x in diagram.all_pass()]


@pytest.mark.parametrize("n", range(1, 7))
def test_plain_changes_visit_every_order(n):
    order, seen = list(range(n)), {tuple(range(n))}
    for i in filteraudit.plain_changes(n):
        order[i], order[i + 1] = order[i + 1], order[i]
        seen.add(tuple(order))
    assert seen == set(permutations(range(n)))


# --- prefix trie -----------------------------------------------------------------------------------


def brute_trie(rows):
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    built = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = said.get(c - int(np.fmod(c, 100)), [])
        built[c] = base[:h] + own[h:]
    nodes = {}
    for c, way in built.items():
        for d in range(len(way) + 1):
            nodes.setdefault(tuple(way[:d]), []).append(c)
    out = {}
    children = {}
    for key in nodes:
        if key:
            children.setdefault(key[:-1], []).append(key)
    sums = {}
    for key in sorted(nodes, key=len, reverse=True):
        below = [sums[k] for k in children.get(key, [])]
        mine = (len(nodes[key]) - 1) * len(key[-1][1]) if key else 0
        sums[key] = (sum(b[0] for b in below) or 1, mine + sum(b[1] for b in below))
        ends = ",".join(str(c) for c in sorted(c for c in nodes[key] if len(built[c]) == len(key)))
        out[key] = (
            min(nodes[key]), len(key), min(nodes[key[:-1]]) if key else None, len(nodes[key]), len(below), *sums[key],
            hashlib.sha256(ends.encode()).hexdigest(),
        )
    return sorted(out.values(), key=str)


def some_conversations(rng):
    rows = []
    for c in [*range(0, 12), *range(95, 130), *range(301, 320), -3, -250, 10**12]:
        for turn in range(rng.choice([1, 2, 4, 7, 9])):
            rows.append((c, turn, rng.choice(["user", None, ""]), rng.choice(["hi", "hi", None, "", "😀 oh", "tell me"])))
    rows += [(5, None, "user", "first"), (None, 1, "user", "nobody's"), (130, 0, None, None), (101, 3, "user", "again" * 2000)]
    rows += [(700, t, "user", f"turn {t % 3}") for t in range(60)] + [(701, t, "user", f"turn {t % 3}") for t in range(50)]
    return rows


@pytest.mark.parametrize(("seed", "shard_rows", "tier"), [(1, 1 << 16, 256), (2, 8, 4), (3, 1, 2)])
def test_trie_against_brute_force(spark, monkeypatch, seed, shard_rows, tier):
    """One tier; several, with the nodes of one long conversation cut across them."""
    monkeypatch.setattr(convtrie, "TIER", tier)
    rows = some_conversations(random.Random(seed))
    schema = "conv_id long, turn long, role string, text string, depth int, k1 string, row int"
    df = spark.createDataFrame([(*r, 1, "k", 2) for r in rows], schema).repartition(6)
    got = sorted((tuple(r) for r in convtrie.trie(df, shard_rows).collect()), key=str)
    assert got == brute_trie(rows)


def test_trie_of_turnless_and_no_conversations(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert convtrie.trie(spark.createDataFrame([(None, 1, "a", "b")], schema)).count() == 0
    short = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 0)  # its one turn goes, its base is absent
    got = convtrie.trie(spark.createDataFrame([(short, 1, "a", "b")], schema)).collect()
    assert [tuple(r) for r in got] == [(short, 0, None, 1, 0, 1, 0, hashlib.sha256(str(short).encode()).hexdigest())]


def test_ends_of_one_node_in_many_strings(spark, monkeypatch):
    monkeypatch.setattr(convtrie, "ENDS", 3)
    ids = spark.range(0, 100, 1, 7).select(F.lit(5).cast("long").alias("k1"), (F.col("id") % 2).alias("k2"), "id")
    got = {r.k2: r.ends_sha256 for r in convtrie.end_digests(ids.toDF("k1", "k2", "conv_id")).collect()}
    assert got == {k: hashlib.sha256(",".join(str(i) for i in range(k, 100, 2)).encode()).hexdigest() for k in (0, 1)}


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_perfect_hash_is_minimal_and_knows_strangers(n):
    rng = np.random.default_rng(n)
    a, b = rng.integers(-(1 << 62), 1 << 62, (2, n))
    hashed = convtrie.PerfectHash(a, b)
    assert sorted(hashed.slots(a, b).tolist()) == list(range(n))
    if n:
        zero, one = np.zeros(n, np.int64), np.ones(n, np.int64)
        names = ["depth", "k1", "k2", "p1", "p2", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
        table = convtrie.NodeTable(dict(zip(names, [one, a, b, b, a, one, one, zero, zero, zero], strict=True)))
        assert (table.find(a, b, one) >= 0).all() and (table.find(a + 1, b, one) == -1).all() and (table.find(a, b, zero) == -1).all()
        assert (table.parent == -1).all()
