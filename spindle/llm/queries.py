"""The registered queries of this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.llm import bpe, licenses, media, packing, pii, quality, simhash, token_counts, topk, toxicity
from spindle.llm._common import importable, small_batches

#: Stands for a key that a deployment keeps secret.
PSEUDONYM_KEY = b"example key, to be replaced"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as their files are split; where the setting ``spindle.partitions`` names
    a number, dealt to as many partitions (a small table in one file, as in the benchmark)."""
    docs, parts = table(spark, sf_dir, "documents"), spark.conf.get("spindle.partitions", None)
    return docs.repartition(int(parts)) if parts else docs


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), TOKENIZER, size=2048, end_id=1)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), TOKENIZER)


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), TOKENIZER)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir), words=3, distance=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=20, every=20, scale=64)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), table(spark, sf_dir, "labels")
    return toxicity.predictions(docs, labels, folds=3, held_out=1, threshold=0.7)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), table(spark, sf_dir, "labels")
    return quality.predictions(docs, labels, folds=5, held_out=0, threshold=0.3)


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.stored_and_read(documents(spark, sf_dir))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return pii.pseudonymized(docs, PSEUDONYM_KEY, counts=True)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_packing": op1_packing, "op2_bpe": op2_bpe, "op3_licenses": op3_licenses,
        "op4_token_counts": op4_token_counts,
        "op5_simhash": op5_simhash, "op6_topk": op6_topk, "op7_toxicity": op7_toxicity, "op8_quality": op8_quality, "op9_media": op9_media,
        "op10_pii": op10_pii, "pipeline": pipeline}


def _licenses_sql(least: float = 0.8, slack: int = 2) -> str:
    k, grams = licenses.K, []
    for i, (text, label) in enumerate([*licenses.PHRASES, *licenses.TEMPLATES]):
        words = text.split()
        size = len(words) - k + 1
        exact = str(i < len(licenses.PHRASES)).lower()
        grams += [f"({i}, {t}, {size}, {exact}, '{label}', '{' '.join(words[t : t + k])}')" for t in range(size)]
    return rf"""
WITH t(template, tpos, size, exact, label, gram) AS (VALUES {", ".join(grams)}),
d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'),
    '{licenses.SEPARATORS}'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT rid, i - 1 AS pos, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram FROM d, unnest(range(1, len(w) - {k - 2})) AS u(i)),
v AS (SELECT rid, template, pos - tpos AS diagonal, any_value(size) AS size, any_value(exact) AS exact, any_value(label) AS label, COUNT(*) AS votes
    FROM g JOIN t USING (gram) GROUP BY ALL),
r AS (SELECT *, SUM(gap) OVER (PARTITION BY rid, template ORDER BY diagonal) AS run FROM (SELECT *, CASE WHEN diagonal - lag(diagonal)
    OVER (PARTITION BY rid, template ORDER BY diagonal) <= CASE WHEN exact THEN 0 ELSE {slack} END THEN 0 ELSE 1 END AS gap FROM v)),
s AS (SELECT rid, template, any_value(exact) AS exact, any_value(label) AS label, MIN(diagonal) AS place,
    LEAST(1.0::DOUBLE, SUM(votes)::DOUBLE / any_value(size)) AS share FROM r GROUP BY rid, template, run),
b AS (SELECT *, exact AND share = 1 AS base, MAX(share) FILTER (WHERE NOT exact) OVER (PARTITION BY rid, place) AS best FROM s),
l AS (SELECT *, base OR (NOT exact AND share >= {least} AND share = best) AS labelled FROM b),
f AS (SELECT rid, COUNT(*) FILTER (WHERE base) AS n_base, MIN(place) FILTER (WHERE base) AS first_word, MAX(place) FILTER (WHERE base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE labelled) AS labels,
    MAX(share) FILTER (WHERE labelled OR NOT exact) AS score FROM l GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score FROM d LEFT JOIN f USING (rid)"""


_TOPK_SQL = """
WITH u AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score FROM u q JOIN u c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s) WHERE n <= 20"""


def oracle_sql() -> dict[str, str]:
    """SQL where it can say the same; fingerprints, tokenizers, models, streams and keyed
    permutations are tested by brute force instead."""
    return {"op3_licenses": _licenses_sql(), "op6_topk": _TOPK_SQL}
