"""The pipeline's stages on the smallest tables, each on its own input."""

import itertools
import re

import duckdb
import pytest

import corpus_pipeline
from spindle.llm import pii, quality, simhash, toxicity
from spindle.llm.queries import PSEUDONYM_KEY, oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def shingled(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_stages(spark, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "simhash_near_dedup", "pii", "packing"]
    labels, own = spark.read.parquet(f"{SF}/labels.parquet"), docs
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    model, net = toxicity.fit(docs, labels), None
    kept = corpus_pipeline.drop_toxic(spark, own, SF).persist()
    assert {r["doc_id"] for r in kept.collect()} == {i for i, t in texts.items() if model.score(t) < corpus_pipeline.TOXIC}
    own, net = kept, quality.fit(kept, labels)
    good = corpus_pipeline.drop_poor(spark, own, SF).persist()
    assert {r["doc_id"] for r in good.collect()} == {r["doc_id"] for r in own.collect() if net.score(r["text"]) >= corpus_pipeline.GOOD}
    single = corpus_pipeline.drop_copies(spark, good, SF).persist()
    groups = {}
    for r in simhash.near_duplicates(good).collect():
        groups.setdefault(r["component_id"], []).append(r["doc_id"])
    left = {r["doc_id"] for r in single.collect()}
    first = {min(g) for g in groups.values()}
    assert left <= first
    shingles = {i: shingled(texts[i]) for i in first}
    similar = lambda a, b: len(shingles[a] & shingles[b]) / len(shingles[a] | shingles[b])
    assert not [(a, b) for a, b in itertools.combinations(sorted(left), 2) if similar(a, b) >= 0.9]
    assert all(any(similar(i, j) > 0.6 for j in first - {i}) for i in first - left)
    hidden = corpus_pipeline.hide_personal_data(spark, single, SF).persist()
    maker = pii.Pseudonymizer(PSEUDONYM_KEY)
    assert {r["doc_id"]: r["text"] for r in hidden.collect()} == {r["doc_id"]: maker.text(r["text"])[0] for r in single.collect()}
    for df in (kept, good, single, hidden):
        assert df.columns == docs.columns
    packed = corpus_pipeline.pack(spark, hidden, SF).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in hidden.collect()}


def test_personal_data_goes(spark, docs):
    out = corpus_pipeline.hide_personal_data(spark, docs, SF)
    mail = re.compile(r"[\w.]+@mail\d+\.example\.com")
    before = {m for r in docs.collect() for m in mail.findall(r["text"])}
    after = {m for r in out.collect() for m in mail.findall(r["text"])}
    assert before and not before & after


def test_registered_names():
    names = set(queries())
    assert {f"op{n}_" for n in range(1, 11)} == {re.match(r"op\d+_", n)[0] for n in names if n != "pipeline"} and "pipeline" in names


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_sql_says_the_same(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries()[name](spark, SF)
    columns = sorted(df.columns)
    out = con.sql(oracle_sql()[name])
    assert sorted(out.columns) == columns
    at = [out.columns.index(c) for c in columns]
    want = sorted((tuple(r[i] for i in at) for r in out.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == want and want
