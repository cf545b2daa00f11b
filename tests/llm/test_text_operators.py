"""Fingerprints, languages, shards of tokens, BPE, toxicity and near-duplicates against brute force."""

import hashlib
import math
import os
import random
import uuid
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronlens.llm import bpe, langid, lzprint, neardup, queries, toxicity, wavelet

DOCS = "doc_id long, text string"
SMALL = "/root/testdata/sf0.001"
ODD = [
    None, "", "   ", "one", "one", "a\x1cb c\x1d", "İstanbul ΣΑΣ x²½ Ⅷ", "é å̧ x́", "<|endoftext|>",
    "abc<|endoftext|>d <|startoftext|> <|EndOfText|>", "don't I'LL '''s !'s we''ve", "a b c　d​e f\x85g",
    "😀👍🏽 日本語 テキスト", "x" * 5000, "1234 56.78,9", " lead", "trail ", "x\n\n y z", "x \ny", "a  b   c", "nul\0in it", "long word " * 4000,
]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame([(i, t, "x", 1.0) for i, t in enumerate(ODD)] + [(1, "", "y", 2.0)] * 2, DOCS + ", score string, shard double")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- fingerprints ----------------------------------------------------------------------------------


def phrases(text: str) -> set[str]:
    seen, w = set(), ""
    for c in text:
        w += c
        if w not in seen:
            seen.add(w)
            w = ""
    return seen | ({w} if w else set())


def expected_prints(rows):
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    out = []
    for i, (d, t) in enumerate(rows):
        following, half = rows[(i + 1) % len(rows)][1], len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        f, e, n = map(lzprint.fingerprint, (t, edited, following))
        out.append((d, len(t), sha(edited), lzprint.as_text(f), lzprint.as_text(e), lzprint.likeness(f, e), lzprint.likeness(f, n)))
    return out


def test_prints_over_runs_of_documents(odd):
    docs = odd.union(odd.sparkSession.createDataFrame([(None, "no id", "", 0.0)], odd.schema))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for partitions in (1, 5):
        got = [tuple(r) for r in lzprint.compare_with_next(docs, partitions).collect()]
        assert sorted(got, key=str) == sorted(expected_prints(rows), key=str)


def test_prints_of_one_and_no_document(spark):
    one = lzprint.compare_with_next(spark.createDataFrame([(7, "abcdef")], DOCS)).collect()
    assert [tuple(r) for r in one] == expected_prints([(7, "abcdef")])
    assert lzprint.compare_with_next(spark.createDataFrame([], DOCS)).count() == 0


def test_likeness_follows_the_phrase_sets(spark):
    rng = random.Random(1)
    a = "".join(rng.choice("abcdefgh ") for _ in range(6000))
    b = a[:4500] + "".join(rng.choice("klmnopqr ") for _ in range(1500))
    true = len(phrases(a) & phrases(b)) / len(phrases(a) | phrases(b))
    assert abs(lzprint.likeness(lzprint.fingerprint(a), lzprint.fingerprint(b)) - true) < 0.15
    assert lzprint.likeness(lzprint.fingerprint(a), lzprint.fingerprint("0123456789" * 300)) < 0.1
    docs = spark.createDataFrame([(1, a, "old"), (2, a, "old")], DOCS + ", fingerprint string")
    assert len({r.fingerprint for r in lzprint.fingerprints(docs).collect()}) == 1


# --- languages -------------------------------------------------------------------------------------


def brute_bits(texts: list[bytes], text: bytes) -> float:
    """Code length by walking the contexts of one language, longest first."""
    counts: dict[bytes, dict[int, int]] = {}
    for t in texts:
        padded = b"\0\0\0" + t
        for i in range(3, len(padded)):
            for k in range(4):
                after = counts.setdefault(padded[i - k : i], {})
                after[padded[i]] = after.get(padded[i], 0) + 1
    total, padded = 0.0, b"\0\0\0" + text
    for i in range(3, len(padded)):
        for k in (3, 2, 1, 0):
            after = counts.get(padded[i - k : i])
            if after is None:
                continue
            n, d = sum(after.values()), len(after)
            if padded[i] in after:
                total -= math.log2(after[padded[i]] / (n + d))
                break
            total -= math.log2(d / (n + d))
        else:
            total += 8.0
    return total


def test_code_lengths_equal_a_walk_of_the_trees(spark):
    texts = {"en": ["the cat and the dog", "this and that"], "fr": ["le chat et le chien", "ça été là"]}
    rows = [(i, t, lang) for i, (lang, t) in enumerate((x, t) for x, ts in texts.items() for t in ts)]
    trees = langid.fit(spark.createDataFrame([*rows, (9, None, "en"), (10, "dropped", None)], DOCS + ", lang string"))
    assert trees.langs == ["en", "fr"]
    asked = ["the chat", "été", "zzz 日本", "", "the cat and the dog", "x" * 700_000]
    import pyarrow as pa

    got = trees.score(pa.array([*asked, None]))
    for text, bits in zip(asked[:-1], got, strict=False):
        for lang, b in zip(trees.langs, bits, strict=True):
            assert b == pytest.approx(brute_bits([t.encode() for t in texts[lang]], text.encode()), rel=1e-5)
    assert (got[-1] == 0).all() and np.isfinite(got[-2]).all()


def test_undetermined_and_clashing_columns(spark, odd):
    trees = langid.fit(spark.createDataFrame([(1, "the cat", "en"), (2, "le chat", "fr")], DOCS + ", lang string"))
    got = {r.doc_id: r for r in langid.predict(odd, trees, odd.columns, names=("_lang", "_score")).collect()}
    assert got[0]._lang == "und" and got[2]._lang == "und" and got[14]._lang == "und" and got[0]._score == 0.0
    assert got[3]._lang in ("en", "fr") and 0 <= got[3]._score <= 1 and got[3].score == "x"
    none = langid.fit(spark.createDataFrame([], DOCS + ", lang string"))
    assert {r.lang_pred for r in langid.predict(odd, none, ["doc_id"]).collect()} == {"und"}


def test_excess_tells_junk_from_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    trees = langid.fit(docs)
    known = trees.score(docs.where("lang = 'en'").select("text").toArrow().column(0).combine_chunks())
    size = docs.where("lang = 'en'").agg(F.sum(F.octet_length("text"))).first()[0]
    assert known[:, trees.langs.index("en")].sum() / size == pytest.approx(trees.usual[trees.langs.index("en")], rel=1e-4)
    rng = random.Random(4)
    junk = [(i, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.choice([30, 3000]))), None) for i in range(20)]
    names = ("_l", "_s", "_x")
    assert langid.predict(docs, trees, ["doc_id"], names).where("_x > 4").count() == 0
    assert langid.predict(spark.createDataFrame([*junk, (90, None, None), (91, "1 2", None)], docs.schema), trees, ["doc_id"], names).where("_x < 5").count() == 0
    none = langid.predict(docs, langid.fit(docs.limit(0)), ["doc_id"], names).select(*names).distinct().collect()
    assert [tuple(r) for r in none] == [("und", 0.0, None)]


def test_languages_of_held_out_documents(spark):
    got = queries.op4_language(spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    right = got.join(docs, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert got.count() == docs.count() and right > 0.95


# --- token shards ----------------------------------------------------------------------------------


def test_wavelet_rank_select_access():
    rng = np.random.default_rng(0)
    for n in (0, 1, 511, 512, 513, 2500):
        ids = rng.integers(0, 50257, n).astype(np.uint32)
        ids[::7] = 13
        m, keys, lengths = wavelet.from_file(wavelet.to_file(ids, [1, 2], [n // 2, n - n // 2], 16))
        assert (m.decode() == ids).all() and keys.tolist() == [1, 2] and lengths.sum() == n
        assert all(m.access(i) == ids[i] for i in range(0, n, 29))
        for v in {13, 50000, *ids[:3].tolist()}:
            at = np.flatnonzero(ids == v)
            assert m.rank(v, n) == len(at) and m.rank(v, n // 3) == (at < n // 3).sum()
            assert [m.select(v, k) for k in range(len(at))] == at.tolist() and m.select(v, len(at)) == -1
    with pytest.raises(ValueError):
        wavelet.from_file(b"something else")


def test_shards_round_trip(odd, tmp_path):
    path = queries.tokenizer_path("byte_bpe_50k.json")
    tokenizer = bpe.load_tokenizer(path)
    docs = odd.union(odd.sparkSession.createDataFrame([(None, "no id", "", 0.0)], odd.schema))
    wavelet.write_shards(docs, str(tmp_path / "shards"), path, end=2, shard_tokens=300)
    got = [tuple(r) for r in wavelet.read_shards(odd.sparkSession, str(tmp_path / "shards")).orderBy("start").collect()]
    assert [d for d, *_ in got] == sorted((r.doc_id for r in docs.collect()), key=lambda d: -1 if d is None else d)
    at, texts = 0, dict(enumerate(ODD)) | {None: "no id"}
    for doc, start, n, crc in got:
        ids = np.array([*tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids, 2], "<u4")
        assert (start, n, crc) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += n
    wavelet.write_shards(docs.limit(0), str(tmp_path / "none"), path)
    assert wavelet.read_shards(odd.sparkSession, str(tmp_path / "none")).count() == 0


def test_parts_as_the_library_cuts_them():
    path = queries.tokenizer_path("byte_bpe_50k.json")
    encoder, kinds = wavelet.Encoder(path, parts=500), wavelet.kinds()
    rng = np.random.default_rng(1)
    sure = [chr(c) for c in np.flatnonzero(kinds != wavelet.UNSURE)]
    texts = [f"{a}{c}{b}" for c in sure for a, b in (("x", " 1"), (" ", "'s"))]
    texts += ["".join(rng.choice(list(alphabet), n)) for alphabet in ("a 's\ntvrel1-", "b \t\r\x1c\xa0\u3000\u0301é²日😀") for n in rng.integers(0, 15, 3000)]
    texts += ODD[1:] + ["y" * 700 + " z" * 700, "x'", "'re", "a 'll", "b''ve"]
    given = [e.ids for e in encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert encoder.plain
    for at in range(0, len(texts), 5000):
        for t, ids, wanted in zip(texts[at : at + 5000], encoder.encode(texts[at : at + 5000], 2), given[at : at + 5000]):
            assert ids.tolist() == [*wanted, 2], t
    assert len(encoder.known) + len(encoder.older) < 30_000 and max(map(len, encoder.known)) <= wavelet.LONG


def test_few_parts_reach_the_library():
    texts = [f"{a}{b}. {b}, {a}!\n" for a in ("alpha", "beta", "gamma", "delta") for b in ("one", "two", "three", "four")] * 50
    encoder, given = wavelet.Encoder(queries.tokenizer_path("byte_bpe_50k.json")), []

    class Counted:
        def __init__(self, inner):
            self.inner = inner

        def encode_batch_fast(self, some, **options):
            given.extend(some)
            return self.inner.encode_batch_fast(some, **options)

    encoder.apart, encoder.tokenizer = Counted(encoder.apart), None  # no text goes whole
    encoder.encode(texts, 2)
    assert 0 < sum(map(len, given)) < 400


# --- BPE -------------------------------------------------------------------------------------------


@pytest.mark.parametrize("block_chars", [40, 24_000_000])
def test_bpe_as_the_library(odd, block_chars):
    path = queries.tokenizer_path("word_bpe_49k.json")
    tokenizer = bpe.load_tokenizer(path)
    got = bpe.encode_decode(odd, path, block_chars).collect()
    assert len(got) == odd.count()
    for r in got:
        ids = tokenizer.encode(ODD[r.doc_id] or "", add_special_tokens=False).ids
        assert list(r.ids) == ids and r.decoded == tokenizer.decode(ids, skip_special_tokens=False)
    assert bpe.encode_decode(odd.limit(0), path).count() == 0


def test_a_worker_reads_the_tokenizer_once(odd, tmp_path, monkeypatch):
    path, read = queries.tokenizer_path("word_bpe_49k.json"), tmp_path / "read"
    read.mkdir()
    plain = bpe.load_tokenizer

    def noted(path):
        (read / f"{os.getpid()}-{uuid.uuid4().hex}").touch()
        return plain(path)

    def run(batches):  # the module's tasks, in a worker: three times what one task reads
        bpe.load_tokenizer = noted
        bpe.worker_tokenizer.cache_clear()
        made = []

        class Rows:
            def mapInArrow(self, f, schema):
                made.append(f)

        bpe.encode_words(Rows(), path)
        for _ in range(3):
            assert list(made[0](iter([]))) == []
        bpe.load_tokenizer = plain
        yield from batches

    odd.select("doc_id").coalesce(1).mapInArrow(run, "doc_id long").count()
    files = list(read.iterdir())
    assert len(files) == 1 and not files[0].name.startswith(f"{os.getpid()}-")


def test_only_tokenizers_whose_words_stand_alone(odd):
    bpe.check_suited(queries.tokenizer_path("word_bpe_49k.json"))
    with pytest.raises(ValueError, match="white space"):
        bpe.encode_decode(odd, queries.tokenizer_path("byte_bpe_50k.json"))


def test_buckets_grow_with_the_input(spark, odd):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    least = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    size = bpe.bucket_count(docs, bucket_bytes=1000) * 1000
    assert bpe.bucket_count(docs) == least == bpe.bucket_count(odd) and size > 100_000
    assert bpe.bucket_count(docs, bucket_bytes=1) <= bpe.MOST_BUCKETS
    path = queries.tokenizer_path("word_bpe_49k.json")
    found = [sorted((r.doc_id, tuple(r.ids), r.decoded) for r in bpe.encode_decode(docs, path, bucket_bytes=b).collect()) for b in (size, size // 40)]
    assert bpe.bucket_count(docs, size // 40) >= 40 and found[0] == found[1] and len(found[0]) == docs.count()


# --- toxicity --------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def letters(spark):
    return toxicity.fit_letters(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


@pytest.mark.parametrize(
    "given, meant",
    [("1d10t", "idiot"), ("m0r0n", "moron"), ("tr4$h", "trash"), ("w0rthl3ss", "worthless"), ("stuuuupid", "stupid"), ("$tup!d!!", "stupid"),
     ("you i d i o t", "idiot"), ("l-o-s-e-r", "loser"), ("st*upid", "stupid"), ("scum", "scum"), ("100", "100")],
)
def test_restored(letters, given, meant):
    assert meant in toxicity.restore(given, letters).split()


@pytest.mark.parametrize(
    "given, meant",
    [("iddioott", "idiot"), ("tra$$$$h", "trash"), ("$$$tup!d", "stupid"), ("@$$", "ass"), ("455", "ass"), ("id.iot", "idiot"), ("id-iot", "idiot"),
     ("you i  d  i  o  t", "idiot"), ("i - d - i - o - t", "idiot"), ("t r @ $ h", "trash"), ("l 0 $ e r", "loser"), ("letter", "letter"), ("100", "100")],
)
def test_restored_from_more_disguises(letters, given, meant):
    assert meant in toxicity.restore(given, letters).split()


def test_cheapest_path_is_the_best_of_all(letters):
    import itertools

    def cost(options):
        text, total, a, b = "".join(o[0] for o in options) + " ", sum(o[1] for o in options), 0, 0
        for c in text:
            z = 0 if c == " " else letters.code.get(c, 1)
            if not (z == 0 and b == 0):
                total += letters.step(a, b, z)
                a, b = (0, 0) if z == 0 else (b, z)
        return total

    for token in ("1d10t", "h3ll0", "a|b1", "sooo0n"):
        places = toxicity.lattice(token)
        best = min(cost(p) for p in itertools.product(*places))
        found = letters.cheapest(places)
        assert any("".join(o[0] for o in p).strip() == found and cost(p) == pytest.approx(best) for p in itertools.product(*places))


def test_pairs_of_letters_are_read_as_in_the_lattice(letters):
    """The local decision against the walk over all readings, on real and on made-up words."""
    rng = random.Random(4)
    words = ["all", "will", "iddioott", "aabb", "ssee", "xx", "eennd", "ßß", "жжu"]
    words += ["".join(c * rng.choice([1, 1, 2]) for c in rng.choices("aeiorstnlzq", k=rng.randrange(1, 12))) for _ in range(3000)]
    for w in (w for w in words if toxicity.RUN.search(w) and not toxicity.THRICE.search(w)):
        assert toxicity.undoubled(w, letters) == letters.cheapest(toxicity.lattice(w)), w
        assert letters.cheapest(toxicity.lattice(w, doubled=True)) == w


def test_toxicity_learns_and_scores_odd_rows(spark, odd):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["tion", "ander", "thesh", "blend", "ering"], k=30) + (["m0ron" if i % 8 else "moron"] if i % 4 == 0 else [])), int(i % 4 == 0)) for i in range(200)]
    labelled = spark.createDataFrame(rows, DOCS + ", toxic int")
    model = toxicity.fit(labelled.select("text"), labelled)
    got = {r.doc_id: r for r in toxicity.predict(labelled, model, ["doc_id"]).collect()}
    assert all(got[i].predicted == toxic for i, _, toxic in rows)
    scored = toxicity.predict(odd, model, odd.columns, names=("_p", "_y")).collect()
    assert len(scored) == odd.count() and all(0 <= r._p <= 1 for r in scored) and {r.score for r in scored} == {"x", "y"}
    nothing = toxicity.fit(labelled.select("text"), labelled.limit(0))
    assert {r.predicted for r in toxicity.predict(odd, nothing, ["doc_id"]).collect()} == {0}


def test_toxicity_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op9_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    both = {(r.toxic, r.predicted): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    assert both[1, 1] / (both[1, 1] + both.get((1, 0), 0)) > 0.7
    assert both.get((0, 1), 0) / both[0, 0] < 0.02


# --- near-duplicates -------------------------------------------------------------------------------


def expected_classes(rows, df, documents):
    """Classes by comparing all pairs of texts."""
    s = neardup.Sampler(df, documents, neardup.WORDS, neardup.BANDS, neardup.ROWS)
    bags = [s.weighted([t])[1:] for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            equal = rows[i][1] is not None and rows[i][1] == rows[j][1]
            if equal or (len(bags[i][0]) and len(bags[j][0]) and s.similarity(bags[i], bags[j]) >= neardup.THRESHOLD):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    groups: dict[int, list] = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    return sorted((d, min(g)) for g in groups.values() for d in g)


def drifting(rng, base, n, edits):
    """A chain of texts, each an edit of one before it: neighbours are near, ends are not."""
    out = [base]
    for _ in range(n - 1):
        w = list(rng.choice(out))
        for _ in range(edits):
            w[rng.randrange(len(w))] = f"z{rng.randrange(10**6)}"
        out.append(w)
    return [" ".join(w) for w in out]


def test_near_duplicates_as_all_pairs(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    texts = [*ODD, *drifting(rng, rng.choices(words, k=150), 60, 2)]
    for _ in range(20):
        base = rng.choices(words, k=rng.randrange(6, 200))
        texts += drifting(rng, base, 3, 1)
    passage = rng.choices(words, k=60)
    texts += [" ".join(passage + rng.choices(words, k=40)) for _ in range(60)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], DOCS + ", links int")
    df = neardup.document_frequencies(docs, neardup.WORDS, neardup.DF_BITS)
    got = sorted((r.doc_id, r.class_id) for r in neardup.near_duplicates(docs).collect())
    assert got == expected_classes(rows, df, sum(t is not None for t in texts))


def test_document_frequencies_are_those_of_each_shingle(spark, monkeypatch):
    monkeypatch.setattr(neardup, "PACK", 3000)
    monkeypatch.setattr(neardup, "CHUNK", 1000)
    rng = random.Random(6)
    # Texts of rare shingles, so many that their hashes crowd any table of a fixed size, and pairs around the threshold.
    many = [" ".join(f"r{i}x{j}" for j in range(4000)) for i in range(60)]
    base = [f"p{i}" for i in range(92)]
    common = [[f"c{k}{i}" for i in range(14)] for k in range(2)]
    pair = [" ".join(base + c) for c in common]
    fill = [" ".join(c + [f"f{n}"]) for n in range(20) for c in common]
    rows = list(enumerate([*many, *pair, *fill, *ODD, *(" ".join(rng.choices("abcde", k=40)) for _ in range(20))]))
    docs = spark.createDataFrame(rows, DOCS)
    exact: dict[int, int] = {}
    for _, t in rows:
        for h in neardup.shingles([t], neardup.WORDS)[1].tolist():
            exact[h] = exact.get(h, 0) + 1
    documents = sum(t is not None for _, t in rows)
    packed = neardup.staged(neardup.packed_texts(docs), "packed")
    dfs = neardup.staged(neardup.counted(packed, neardup.WORDS, 7), "frequencies")
    sampler = spark.sparkContext.broadcast(neardup.Sampler(None, documents, neardup.WORDS, neardup.BANDS, neardup.ROWS))
    got = {r.doc_id: r for r in neardup.signed_texts(packed, dfs, sampler).collect()}
    assert packed.count() > 10 and len(got) == documents
    bags = {}
    for d, t in rows:
        if t is not None:
            _, h, n = neardup.shingles([t], neardup.WORDS)
            df = neardup.frequencies(got[d].df)
            assert df.tolist() == [exact[x] for x in h.tolist()]
            bags[d] = {x: c * (1 + math.log((documents + 1) / (exact[x] + 1)) / math.log(documents + 1)) for x, c in zip(h.tolist(), n.tolist(), strict=True)}
    a, b = bags[60], bags[61]
    both = sum(min(w, b[x]) for x, w in a.items() if x in b)
    true = both / (sum(a.values()) + sum(b.values()) - both)
    x, y = (sampler.value.weighted([rows[i][1]], neardup.frequencies(got[i].df))[1:] for i in (60, 61))
    assert sampler.value.similarity(x, y) == pytest.approx(true)
    cells = neardup.Sampler(neardup.document_frequencies(docs, neardup.WORDS, neardup.DF_BITS), documents, neardup.WORDS, neardup.BANDS, neardup.ROWS)
    by_cells = cells.similarity(*(cells.weighted([rows[i][1]])[1:] for i in (60, 61)))
    assert by_cells != pytest.approx(true)  # as it was


def test_blocks_link_what_all_pairs_link(spark, monkeypatch):
    """One bucket of many pieces, in one block and in many: the same classes as all pairs give."""
    rng = random.Random(23)
    words = [f"w{i}" for i in range(300)]
    base = rng.choices(words, k=60)
    texts = sorted({*drifting(rng, base, 70, 3), *drifting(rng, base[:40] + rng.choices(words, k=20), 30, 1), " ".join(base * 40)})
    s = neardup.Sampler(np.full(1 << 10, 3, np.int64), 1000, neardup.WORDS, neardup.BANDS, neardup.ROWS)
    signatures, count = s.sign(texts)
    df = [zlib.compress(np.full(c, 3, "<u4").tobytes()) for c in count]
    keys = [f"k{i:03d}" for i in range(len(texts))]
    # Bands 5 and 9 are shared by all, so every pair belongs to band 5 and band 9 finds nothing.
    bands = [[1000 * b + (0 if b in (5, 9) else i) for b in range(14)] for i in range(len(texts))]
    rows = [(k, x.astype("<u4").tobytes(), b, t, d) for k, x, b, t, d in zip(keys, signatures, bands, texts, df, strict=True)]
    table = spark.createDataFrame(rows, "key string, signature binary, bands array<long>, text string, df binary")
    roots = {k: keys[i - i % 3] for i, k in enumerate(keys)}
    members = [(b, k, roots[k]) for b in (5000, 9000) for k in keys]
    sampler = spark.sparkContext.broadcast(s)
    bags = [s.weighted([t])[1:] for t in texts]
    near = {(a, b) for i, a in enumerate(keys) for j, b in enumerate(keys) if i < j and s.similarity(bags[i], bags[j]) >= neardup.THRESHOLD}
    assert len(near) > 30

    def classes(links):
        of = dict(roots)
        for a, b in links:
            x, y = of[a], of[b]
            of = {k: min(x, y) if v in (x, y) else v for k, v in of.items()}
        return of

    for block, chars in ((4096, 1 << 22), (7, 1 << 22), (4096, 3000)):
        monkeypatch.setattr(neardup, "BLOCK", block)
        monkeypatch.setattr(neardup, "BLOCK_CHARS", chars)
        found = neardup.block_links(spark.createDataFrame(members, "band long, key string, root string"), table, sampler, 0, neardup.THRESHOLD)
        found = [(r.a, r.b) for r in found.collect()]
        assert set(found) <= near
        assert classes(found) == classes(sorted(near))
        if block == 4096 and chars > 3000:
            assert len(found) < len(set(roots.values()))  # no link between what is one already


def test_no_documents_and_no_ids(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
    text = "one two three four five six"
    got = neardup.near_duplicates(spark.createDataFrame([(None, text), (4, text), (4, text), (3, None), (None, None)], DOCS)).collect()
    assert sorted(str(r.class_id) for r in got) == ["3", "4", "4", "4", "None"]


def test_samples_agree_as_often_as_bags_are_alike():
    rng = random.Random(2)
    a = [f"w{rng.randrange(10**6)}" for _ in range(800)]
    b = [w if i % 40 else "other" for i, w in enumerate(a)]
    s = neardup.Sampler(np.ones(1 << 10, np.int64), 100, 5, 100, 5)
    texts = [" ".join(a), " ".join(b)]
    signatures, _ = s.sign(texts)
    x, y = (s.weighted([t])[1:] for t in texts)
    assert abs((signatures[0] == signatures[1]).mean() - s.similarity(x, y)) < 0.08
