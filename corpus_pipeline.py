"""A training-data pipeline over ``documents``: toxicity, quality, near-duplicates,
personal data, packing.  Each stage gets all rows that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.llm import packing, pii, quality, simhash, toxicity
from spindle.llm._common import materialize
from spindle.llm.queries import PSEUDONYM_KEY, TOKENIZER, documents, table

TOXIC, GOOD = 0.7, 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``TOXIC``.  The model learns from the labelled rows of
    ``docs``; without usable labels every document stays."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), folds=3, held_out=1)
    return toxicity.kept(docs, model, TOXIC)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least ``GOOD`` for quality."""
    net = quality.fit(docs, table(spark, sf_dir, "labels"), folds=5, held_out=0)
    return quality.kept(docs, net, GOOD)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, the one with the smallest id; of
    rows that repeat that id, one stays."""
    return simhash.deduplicated(docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data; ``n_chars`` is that of the new text."""
    done = pii.pseudonymized(docs, PSEUDONYM_KEY)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents."""
    return packing.pack(docs, TOKENIZER, size=2048, end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("simhash_near_dedup", drop_copies),
    ("pii", hide_personal_data),
    ("packing", pack),
]

#: A trained network and a tokenizer are beyond SQL; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
