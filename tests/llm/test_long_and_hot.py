"""Very long texts, large groups and repeated rows, against plain implementations."""

import hashlib
import itertools
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from spindle.llm import bpe, flac, licenses, media, packing, pii, quality, similar, simhash, token_counts, topk, toxicity
from spindle.llm.components import components

PATH = public_tokenizers.path("byte_bpe_50k.json")
RAW = open(PATH, "rb").read()


@pytest.fixture(scope="module")
def long_text():
    """About 400,000 words, with values and phrases at the very end."""
    rng = random.Random(2)
    words = [f"{rng.choice('abcdefgh')}{rng.randrange(3000)}" for _ in range(400_000)]
    return " ".join(words) + " mail ann@x.org under the mit license <|endoftext|> zz%%"


@pytest.fixture(scope="module")
def long_docs(spark, long_text):
    return spark.createDataFrame([(1, long_text, "x"), (2, "short", "y"), (3, "a" * 100_000, "z")], "doc_id long, text string, row string")


def one(df, doc_id=1):
    return next(r for r in df.collect() if r["doc_id"] == doc_id)


def test_tokens_of_long_texts(long_docs, long_text):
    ids = Tokenizer.from_file(PATH).encode(long_text, add_special_tokens=False).ids
    r = one(bpe.round_trip(long_docs, PATH))
    assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert r["decoded_sha256"] == hashlib.sha256(long_text.encode()).hexdigest()
    rows = [p for p in packing.pack(long_docs, PATH).collect() if p["doc_id"] == 1]
    assert sum(p["length"] for p in rows) == len(ids) + 1 and len(rows) == -(-(len(ids) + 1) // 2048)
    counts = token_counts.token_counts(long_docs, PATH)
    assert one(counts)["n_pretokens"] > 400_000 and one(counts, 3)["n_pretokens"] == 1


def test_licenses_of_a_long_text(spark):
    texts = [" ".join(["word"] * n) + " under the mit license" for n in (1_000_000, 10)]
    df = spark.createDataFrame([(i, t, "a", "b", "c") for i, t in enumerate(texts)], "doc_id long, text string, words string, row string, grams string")
    licenses.scan(df.where("doc_id = 1")).collect()
    began = time.perf_counter()
    got = {r["doc_id"]: r for r in licenses.scan(df).collect()}
    assert got[0]["first_word"] == got[0]["last_word"] == 1_000_000 and got[0]["n_words"] == 1_000_004 and got[0]["base_labels"] == "mit"
    assert time.perf_counter() - began < 60  # minutes when every word copied the text


def test_other_operators_on_long_texts(spark, long_docs, long_text):
    fps = {r["doc_id"]: r["fp"] for r in simhash.fingerprints(long_docs).collect()}
    assert fps[1] == simhash.fingerprint(long_text, piece=1 << 30)
    assert {r["doc_id"] for r in simhash.deduplicated(long_docs).collect()} == {1, 2, 3}
    p = media.payload(long_text)
    r = one(media.stored_and_read(long_docs))
    assert r["payload_sha256"] == hashlib.sha256(p).hexdigest() and r["tail_crc32"] == zlib.crc32(p[-64:])
    assert r["n_blocks"] == -(-len(p) // flac.BLOCK) and r["last_offset"] == (r["n_blocks"] - 1) * flac.BLOCK
    hidden = one(pii.pseudonymized(long_docs, b"k", counts=True))
    assert hidden["n_email"] == 1 and "ann@x.org" not in hidden["text"] and hidden["text"][:1000] == long_text[:1000]
    net = quality.train([(long_text, 1), ("short", 0)], steps=2)
    for module, model in ((toxicity, toxicity.train([(long_text, 1), ("short", 0)])), (quality, net)):
        assert all(0 <= x["score"] <= 1 for x in module.scored(long_docs, model).collect())
    model = toxicity.ToxicityModel({"^zz$": 9.0}, -5.0)
    assert model.score(long_text) > 0.9 and toxicity.kept(long_docs, model, 0.7).count() == 2  # the last word counts


def test_many_values_in_a_text():
    own, texts = pii.Pseudonymizer(b"key"), [" ".join(f"user{i}@mail{i % 9}.example.com" for i in range(n)) for n in (10_000, 100_000)]
    took = []
    for text, n in zip(texts, (10_000, 100_000)):
        began = time.perf_counter()
        assert own.text(text)[1] == {"email": n}
        took.append(time.perf_counter() - began)
    assert took[1] < 40 * took[0]


def test_wide_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(1500).round(1).tolist()) for i in range(40)] + [(100 + i, [0.5] * 1500) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    v = {i: np.floor(64 * np.array(x, dtype=np.float32).astype(float)).astype(np.int64) for i, x in rows}
    want = [(q, n + 1, i, -s) for q in v if q % 20 == 0 for n, (s, i) in enumerate(sorted((-int(v[q] @ v[i]), i) for i in v if i != q)[:5])]
    assert sorted(tuple(r) for r in topk.top_k(df, k=5).collect()) == sorted(want)


def test_one_piece_repeated_very_often(spark):
    df = spark.range(3000).selectExpr("cast(null as long) as doc_id", "'same text' as text")
    rows = packing.pack(df, PATH, size=16).collect()
    assert len(rows) == 3000 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 3000


# --- similar texts: every pair, whatever its shape


def plain_similar(sets, similarity):
    near = lambda a, b: len(a & b) >= similarity * len(a | b) - 1e-9
    return [(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if sets[i] and sets[j] and near(sets[i], sets[j])]


def corpus(seed):
    """Texts that share passages, with edits that leave their similarity on both sides of 0.8."""
    rng = random.Random(seed)
    word = lambda: f"w{int(rng.paretovariate(0.5)) % 5000}"
    passages = [[word() for _ in range(40)] for _ in range(4)]
    texts = []
    for _ in range(45):
        base = [word() for _ in range(rng.randint(3, 160))]
        for p in rng.sample(passages, rng.randint(0, 3)):
            at = rng.randrange(len(base) + 1)
            base[at:at] = p
        for _ in range(rng.randint(1, 5)):
            own = list(base)
            for _ in range(rng.randint(0, 7)):
                own[rng.randrange(len(own))] = word()
            if rng.random() < 0.3:
                own += [word() for _ in range(len(own) // 5)]
            texts.append(" ".join(own))
    return texts + texts[:7]


@pytest.mark.parametrize("seed, keys, most, parts", [(1, 1_000_000, 20_000, 2), (2, 60, 6, 5), (3, 400, 4, 3)])
def test_similar_components_are_those_of_all_pairs(spark, seed, keys, most, parts, monkeypatch):
    monkeypatch.setattr(similar.keyed, "__defaults__", (keys,))
    texts = corpus(seed)
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(parts)
    found = simhash.named(df, 3, 5, "id", "text")
    known = found.where("chunk is null").select("id", "fp", "node", "sign")
    often = similar.frequencies(found.where("chunk is not null"))
    none = spark.createDataFrame([], "a long, b long")
    root = {r["node"]: r["root"] for r in similar.similar_components(df, known, often, none, 5, 0.8, most).collect()}
    names = {r["id"]: r["node"] for r in known.collect()}
    sets = [set(similar.shingles(t).tolist()) for t in texts]
    pairs = plain_similar(sets, 0.8)
    assert len(pairs) > 10
    want = spark.createDataFrame([(names[i], names[j]) for i, j in pairs if names[i] != names[j]], "a long, b long")
    assert root == {r["node"]: r["root"] for r in components(want).collect()}


def test_members_of_different_components_meet(spark):
    rng = random.Random(3)
    rows = [(k, n, 10, 0, rng.choice([1, 1, 1, 1, 2, 3, 4]) if k else n) for k in range(3) for n in rng.sample(range(10, 400), 60)]
    df = spark.createDataFrame(rows, "key long, node long, n int, pos int, root long")
    met = {}
    for r in similar.cells(df, 10).collect():
        met.setdefault(r["cell"], []).append((r["node"], r["root"]))
    got = {tuple(sorted((a, b))) for own in met.values() for (a, x), (b, y) in itertools.combinations(own, 2) if x != y}
    want = {tuple(sorted((a[1], b[1]))) for a, b in itertools.combinations(rows, 2) if a[0] == b[0] and a[4] != b[4]}
    assert want <= got
